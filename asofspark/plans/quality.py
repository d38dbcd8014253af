"""Row-level quality rules (JOB17): each rule is one aggregate ``(rule, n_checked, n_failed)``
over the whole input, partially aggregated per task; rules union into one small report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rule(df: DataFrame, name: str, failed: Column) -> DataFrame:
    """Rows checked and rows failing ``failed``, as one row named ``name``."""
    return df.agg(F.count(F.lit(1)).alias("n_checked"), F.count_if(failed).alias("n_failed")).select(
        F.lit(name).alias("rule"), "n_checked", "n_failed")


def on_grid(df: DataFrame, minutes: int, col: str = "interval_start") -> DataFrame:
    """Interval starts fall on the product's grid (whole minutes, a multiple of ``minutes``)."""
    c = F.col(col)
    return rule(df, "on_grid", (F.minute(c) % minutes != 0) | (F.second(c) != 0))


def delivery_after_posting(df: DataFrame, delivery: str, posted: str) -> DataFrame:
    """Delivery time is plausible for the posting time: not before it."""
    return rule(df, "delivery_after_posting", F.col(delivery) < F.col(posted))


def total_within_tolerance(df: DataFrame, parts_sum: str, total: str) -> DataFrame:
    """Parts sum to the total within max(1, 1e-4 * |total|)."""
    gap = F.abs(F.col(parts_sum) - F.col(total))
    return rule(df, "total_within_tolerance", gap > F.greatest(F.lit(1.0), F.abs(F.col(total)) * 1e-4))


def same_names(formats: dict[str, DataFrame], name: str, prefixes: tuple[str, ...] = ()) -> DataFrame:
    """All source formats of a product cover the same names: of the names in any format (those with
    one of ``prefixes`` where given), how many are absent from another one. Each format is reduced
    to its distinct names first."""
    seen = None
    for label, df in formats.items():
        names = df.select(F.col(name).alias("name"), F.lit(label).alias("format")).distinct()
        seen = names if seen is None else seen.unionByName(names)
    if prefixes:
        seen = seen.filter(F.greatest(*[F.col("name").startswith(p) for p in prefixes], F.lit(False)))
    per = seen.filter(F.col("name").isNotNull()).groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    return rule(per, "same_names", F.col("n") < len(formats))
