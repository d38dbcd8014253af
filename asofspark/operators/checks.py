"""Grouped checks over whole tables (AGG01-AGG05, SET03, SET04).

All are aggregates with partial (map-side) combining; a hot key or file is pre-aggregated in
every task before the shuffle. Nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def key_text(key: Sequence[str]) -> Column:
    """A readable example of a business key: parts joined by '|', NULL shown as 'NULL'."""
    return F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in key])


def repeated_keys(df: DataFrame, key, by) -> DataFrame:
    """AGG01: per ``by`` (a posting), how many business keys repeat and the smallest example.
    NULL key parts compare equal (grouping semantics)."""
    key, by = _cols(key), _cols(by)
    dup = df.groupBy(*by, *key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return dup.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_repeated_keys"),
        F.min(key_text(key)).alias("example"),
        F.max("n").alias("max_copies"),
    )


def duplicate_keys(df: DataFrame, key, posted: str, limit: int = 5) -> DataFrame:
    """AGG02: (key, posted) pairs stored more than once over the whole table; the ``limit``
    most repeated are reported (a top-k: ordered by count desc, then key)."""
    key = _cols(key)
    g = df.groupBy(*key, posted).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return g.orderBy(F.col("n").desc(), *[F.col(k).asc_nulls_last() for k in key], F.col(posted)).limit(limit)


def sum_findings(df: DataFrame, *, by, part: Column, total: Column, value: str,
                 expected_parts: int, tolerance: float = 1.0) -> DataFrame:
    """AGG03: per ``by``, the sum of part rows against the total row; a finding when they differ
    by more than ``tolerance`` or the number of parts is not ``expected_parts``. Where there is no
    total there is nothing to compare and no finding."""
    by = _cols(by)
    g = df.groupBy(*by).agg(
        F.sum(F.when(part, F.col(value))).alias("parts_sum"),
        F.max(F.when(total, F.col(value))).alias("total"),
        F.count(F.when(part, F.lit(1))).alias("n_parts"),
    )
    wrong = (F.abs(F.col("parts_sum") - F.col("total")) > tolerance) | (F.col("n_parts") != expected_parts)
    return g.filter(F.col("total").isNotNull() & wrong)


def null_audit(df: DataFrame, required: Sequence[str], by: str = "file") -> DataFrame:
    """AGG04: NULL count of every required column per ``by``, all columns in one pass, returned
    long as (by, column, n_null) for the columns that have NULLs."""
    wide = df.groupBy(by).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    long = wide.unpivot([by], list(required), "column", "n_null")
    return long.filter(F.col("n_null") > 0)


def version_audit(df: DataFrame, supported=(1,), by: str = "file", col: str = "schema_version") -> DataFrame:
    """AGG05: distinct schema versions per ``by`` and whether any is unsupported."""
    g = df.groupBy(by).agg(F.array_sort(F.collect_set(F.col(col))).alias("__v"))
    return g.select(by, F.array_join(F.transform("__v", lambda x: x.cast("string")), ",").alias("versions"),
                    F.exists("__v", lambda x: ~x.isin(list(supported))).alias("unsupported"))


def schema_diff(actual: DataFrame, contract: Sequence[tuple[str, str]], by: str = "file") -> DataFrame:
    """SET03: per ``by``, (column, type) pairs in ``actual`` but not in the contract and the
    reverse; when both sets agree but the order differs, report 'column order'.

    ``actual`` holds (by, position, column, type) rows; ``contract`` is the declared
    ``[(column, type), ...]`` in order (configuration, so it enters the plan as literals).
    Only the per-``by`` column lists are shuffled: one row per column of each file.
    """
    a = actual.groupBy(by).agg(F.array_sort(F.collect_list(F.struct("position", "column", "type"))).alias("a"))
    pairs_a = F.transform("a", lambda s: F.concat_ws(" ", s["column"], s["type"]))
    pairs_e = F.array(*[F.lit(f"{c} {t}") for c, t in contract]).cast("array<string>")
    extra = F.array_join(F.array_sort(F.array_except(pairs_a, pairs_e)), ",")
    missing = F.array_join(F.array_sort(F.array_except(pairs_e, pairs_a)), ",")
    order = (extra == "") & (missing == "") & (pairs_a != pairs_e)
    return a.select(by, extra.alias("unexpected"), missing.alias("missing"), order.alias("column_order")).filter(
        (F.col("unexpected") != "") | (F.col("missing") != "") | F.col("column_order"))


def calendar_gaps(days: DataFrame, day: str = "day", by=()) -> DataFrame:
    """SET04: days between the first and last present day (per ``by``) that have no rows.

    The present-day set is a distinct over the data (partial aggregation); the calendar is
    generated per group from its min/max and anti-joined against it. Both sides are bounded by
    the number of calendar days, not by rows.
    """
    by = _cols(by)
    present = days.select(*by, F.col(day).alias("day")).distinct()
    bounds = present.groupBy(*by).agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    cal = bounds.select(*by, F.explode(F.sequence("lo", "hi")).alias("day"))
    return cal.join(present, on=[*by, "day"], how="left_anti")


def first_per_group(df: DataFrame, by, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows per group by ``order`` (``row_number() <= n``; partial top-n per task)."""
    w = Window.partitionBy(*[F.col(b) for b in _cols(by)]).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")
