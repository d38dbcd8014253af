"""Rows dealt to tasks by ascending ranges of (id, text hash), and the ranges' edges.

Edges are approximate quantiles of the ids. An id that holds several ranges' worth of rows, and the rows
without an id, which come first, are cut by the hash of their texts as well, so that no task gets all
rows of one id. Only rows alike in id and text stay together.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asofspark.llm.common import shuffle_width

ACCURACY = 10_000
_LEAST = -(1 << 63)

Cut = tuple[int, int, int]  # (0 without an id, else 1; id; text hash)


def _by_hash(flag: int, value: int, parts: int) -> list[Cut]:
    """Cuts of one id's rows into ``parts`` even ranges of hashes, without the first."""
    return [(flag, value, _LEAST + k * (1 << 64) // parts) for k in range(1, parts)]


def bounds(rows: DataFrame, column: str, parts: int) -> list[Cut]:
    """At most ``parts`` ascending cut points."""
    if parts < 2:
        return []
    marks = [k / parts for k in range(1, parts)]
    r = rows.agg(F.percentile_approx(column, marks, ACCURACY).alias("cuts"), F.count("*").alias("n"), F.count(column).alias("known"),
                 F.min(column).alias("least")).first()
    if not r.n:
        return []
    without = round(parts * (r.n - r.known) / r.n)
    cuts = _by_hash(0, 0, without)
    if r.known < r.n and r.known:
        cuts.append((1, r.least, _LEAST))
    for value, times in sorted(Counter(r.cuts or []).items()):
        cuts += [(1, value, _LEAST), *_by_hash(1, value, times)]
    cuts = sorted(set(cuts))
    if len(cuts) > parts:  # rows without an id take ranges from the others
        step = len(cuts) / parts
        cuts = [cuts[int(k * step)] for k in range(parts)]
    return cuts


def bucket_of(value: Column, key: Column, cuts: list[Cut]) -> Column:
    """Number of cut points at or below (value, key); null values come first. Searched in two steps."""
    if not cuts:
        return F.lit(0)
    def place(flag, v, k):
        return F.struct(flag.cast("int").alias("f"), v.cast("long").alias("v"), k.cast("long").alias("k"))

    here = place(value.isNotNull(), F.coalesce(value, F.lit(0)), key)
    lit = lambda c: place(F.lit(c[0]), F.lit(c[1]), F.lit(c[2]))
    step = max(1, math.isqrt(len(cuts)))
    groups = [cuts[s:s + step] for s in range(0, len(cuts), step)]
    below = lambda a: F.size(F.filter(a, lambda c: c <= here))
    group = below(F.array(*[lit(g[0]) for g in groups]))
    inner = F.element_at(F.array(*[F.array(*map(lit, g)) for g in groups]), F.greatest(group, F.lit(1)))
    return F.when(group == 0, 0).otherwise((group - 1) * step + below(inner)).cast("int")


def by_range(spark: SparkSession, rows: DataFrame, column: str, key: str, parts: int | None = None) -> DataFrame:
    """``rows`` with ``bucket``: buckets ascend with (column, key), one task each, sorted by both."""
    parts = parts or shuffle_width(spark)
    cuts = bounds(rows, column, parts)
    dealt = rows.withColumn("bucket", bucket_of(F.col(column), F.col(key), cuts).cast("int"))
    return dealt.repartitionById(len(cuts) + 1, F.col("bucket")).sortWithinPartitions("bucket", column, key)
