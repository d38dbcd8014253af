"""Point-in-time (bitemporal) tables on Spark.

Every row describes an interval (``interval_start``), was published at ``posted_at`` and landed
at ``ingested_at``. A read asks what was known at a moment: rows posted by then, the latest one
per business key. Everything here takes and returns DataFrames; the driver holds only
configuration.

Time convention: UTC instants are ``TIMESTAMP_NTZ`` values holding the UTC wall clock, and local
(Central) wall clocks are ``TIMESTAMP_NTZ`` too. Every zone conversion is microsecond
arithmetic plus ``to_utc_timestamp`` / ``from_utc_timestamp`` with a literal zone, so no result
depends on the session time zone.
"""

__version__ = "0.1.0"
