"""JOB15/WIN04: the sample rule. Per file: rows of the first ``intervals`` distinct intervals
in source order; of those, every hub/zone row and the first ``others`` other points per
interval; source order kept. A file is complete when it reaches past the kept intervals.

The interval ranking runs on one row per (file, interval) (its first line), not on the rows;
hub and zone rows pass as they are, and the per-interval top-``others`` of the other rows is a
``row_number`` filter (partial top-n before the shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sample(df: DataFrame, *, file: str, order: str, interval, point: str | None,
           prefixes=("HB_", "LZ_"), intervals: int = 2, others: int = 5) -> DataFrame:
    interval = [interval] if isinstance(interval, str) else list(interval)
    first = df.groupBy(file, *interval).agg(F.min(order).alias("__first"))
    ranked = first.withColumn("__rank", F.dense_rank().over(Window.partitionBy(file).orderBy("__first")))
    wanted = ranked.filter(F.col("__rank") <= intervals).select(file, *interval)
    kept = df.join(wanted, on=[file, *interval], how="left_semi")
    if point is None:
        return kept
    hub = F.greatest(*[F.trim(F.col(point)).startswith(p) for p in prefixes], F.lit(False))
    # only the other points are ranked: their top-n is cut before the shuffle, hubs never sort
    w = Window.partitionBy(file, *interval).orderBy(order)
    rest = kept.filter(~hub | F.col(point).isNull()).withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= others)
    return kept.filter(hub).unionByName(rest.drop("__n"))


def sample_job(df: DataFrame, *, file: str, order: str, interval, point: str | None, prefixes=("HB_", "LZ_"),
               intervals: int = 2, others: int = 5) -> DataFrame:
    """JOB15: the sample of every file with ``complete``: whether the file reaches past the kept intervals,
    so that the last of them is known to be whole. Files that are not complete keep their rows, and
    are told apart by the flag."""
    rows = sample(df, file=file, order=order, interval=interval, point=point, prefixes=prefixes, intervals=intervals, others=others)
    return rows.join(complete_files(df, file=file, interval=interval, intervals=intervals).select(file, "complete"), on=file)


def complete_files(df: DataFrame, *, file: str, interval, intervals: int = 2) -> DataFrame:
    interval = [interval] if isinstance(interval, str) else list(interval)
    g = df.select(file, *interval).distinct().groupBy(file).agg(F.count(F.lit(1)).alias("n_intervals"))
    return g.withColumn("complete", F.col("n_intervals") > intervals)
