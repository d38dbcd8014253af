"""Drift-strict cell parsers. Each returns ``(value, problem)``: the value or NULL, and NULL or
the reason the cell was refused. Errors are data; nothing raises inside a task."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted boolean spellings (compared after trim + upper).
TRUE_WORDS = ("Y", "TRUE", "1")
FALSE_WORDS = ("N", "FALSE", "0", "")

_WHOLE = r"^[+-]?[0-9]+$"
# Type suffixes Spark's cast accepts and the source's number parser does not.
TYPE_SUFFIXES = ("d", "D", "f", "F")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_flag(cell) -> tuple[Column, Column]:
    """FN04: Y/TRUE/1 -> true, N/FALSE/0/blank -> false (trimmed, any case); booleans pass; a
    NULL cell or any other text is drift."""
    c = _c(cell)
    t = F.upper(F.trim(c.cast("string")))
    value = F.when(t.isin(*TRUE_WORDS), F.lit(True)).when(t.isin(*FALSE_WORDS), F.lit(False))
    problem = F.when(c.isNull(), F.lit("flag is null")).when(
        value.isNull(), F.concat(F.lit("unrecognised flag "), c.cast("string"))
    )
    return value, problem


def to_number(cell, required: bool = True) -> tuple[Column, Column]:
    """FN05: trimmed text -> DOUBLE. Blank or NULL is NULL (a problem when required). Type
    suffixes (``1.0d``, ``2f``) that Spark's cast would accept are refused."""
    c = _c(cell)
    t = F.trim(c.cast("string"))
    blank = c.isNull() | (t == "")
    parsed = F.when(~F.right(t, F.lit(1)).isin(*TYPE_SUFFIXES), t.try_cast("double"))
    value = F.when(~blank, parsed)
    problem = F.when(blank, F.lit("missing number") if required else F.lit(None).cast("string")).when(
        parsed.isNull(), F.concat(F.lit("not a number "), c.cast("string"))
    )
    return value, problem


def to_whole(cell) -> tuple[Column, Column]:
    """FN06: trimmed text of digits -> INT; ``1.0``, blanks and overflow are refused."""
    c = _c(cell)
    t = F.trim(c.cast("string"))
    value = F.when(t.rlike(_WHOLE), t.try_cast("int"))
    problem = F.when(value.isNull(), F.concat(F.lit("not an integer "), F.coalesce(c.cast("string"), F.lit("NULL"))))
    return value, problem


def iso_timestamp(text) -> Column:
    """FN23: ISO text (``T`` or space, optional fraction, optional offset or ``Z``) -> the UTC wall
    clock (NTZ) of the instant; a text without an offset is taken as UTC, invalid -> NULL."""
    t = F.trim(_c(text))
    zone = F.regexp_extract(t, r"([+-]\d{2}:?\d{2})$", 1)
    sign = F.when(zone.startswith("-"), -1).otherwise(1)
    minutes = F.substring(zone, 2, 2).try_cast("int") * 60 + F.regexp_extract(zone, r"(\d{2})$", 1).try_cast("int")
    ahead = F.coalesce(sign * minutes, F.lit(0))
    t = F.regexp_replace(t, r"(Z|[+-]\d{2}:?\d{2})$", "")
    t = F.regexp_replace(t, r"(\.\d{6})\d+$", "$1")
    t = F.when(t.contains("."), F.rpad(t, 26, "0")).otherwise(t)
    fmts = ("yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSSSSS",
            "yyyy-MM-dd HH:mm:ss")
    wall = F.coalesce(*[F.try_to_timestamp(t, F.lit(f)).cast("timestamp_ntz") for f in fmts])
    return F.timestamp_add("MINUTE", -ahead, wall)
