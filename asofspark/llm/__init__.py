"""Training-data operators: one module per operator, their driver queries in :mod:`.queries`.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its queries when present.
"""
