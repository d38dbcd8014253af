"""Segmented prefix carry: ordered state over a group of any size, in tasks of equal rows.

A running window (:mod:`.pit`'s as-of join, :mod:`.repeated`'s hour) puts a whole group into one task.
Here a group with more than ``rows`` rows is cut into segments that hold about ``rows`` rows each:

1. one grouped count finds the groups that are too large; usually there are none, and nothing else runs;
2. the rows of those groups, reduced to group and order, are range-partitioned by them, so the
   partitions are equal in rows whatever the distribution of keys and times, and the least row of every
   partition becomes a cut. Cuts are kept as a small table, so that every later pass agrees on them;
3. each row finds its segment among its group's cuts, in two steps over their square roots;
4. one aggregate per segment gives what it carries, an exclusive scan over these few rows (one per
   segment) what comes into it, and the running window then works inside segments.

There are as many cuts as the large groups hold multiples of ``rows``. The order must be total enough to
be cut: rows equal in all order columns stay in one segment.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asofspark.session import scratch_path

ROWS = 2_000_000
SEGMENT = "__segment"
HOT = "__hot"


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _same(a: DataFrame, b: DataFrame, names: Sequence[str], prefix: str) -> Column:
    out = F.lit(True)
    for n in names:
        out = out & a[n].eqNullSafe(b[prefix + n])
    return out


def _named(df: DataFrame, names: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({n: prefix + n for n in names})


def large_groups(df: DataFrame, group: Sequence[str], rows: int) -> DataFrame | None:
    """``(*group, n)`` of the groups with more than ``rows`` rows, as a table; None where there are none."""
    found = _kept(df.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > rows), "large-groups")
    return None if found.isEmpty() else found


def _cuts(df: DataFrame, group: Sequence[str], order: Sequence[str], large: DataFrame, rows: int) -> DataFrame:
    """``(*group, cuts)``: ascending cuts of every large group, in blocks of the square root of their number."""
    parts = max(2, math.ceil(large.agg(F.sum("n")).first()[0] / rows))
    g = _named(large.drop("n"), group, "g_")
    only = df.select(*group, *order).join(g, _same(df, g, group, "g_"), "left_semi")
    dealt = only.repartitionByRange(parts, *[F.col(c).asc_nulls_first() for c in (*group, *order)])
    least = dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct(*group, *order)).alias("c"))
    per = least.groupBy(*[F.col("c").getField(n).alias(n) for n in group]).agg(
        F.array_sort(F.collect_list(F.struct(*[F.col("c").getField(o).alias(o) for o in order]))).alias("cuts"))
    step = F.ceil(F.sqrt(F.size("cuts"))).cast("int")
    blocks = F.transform(F.sequence(F.lit(1), F.size("cuts"), step), lambda i: F.slice("cuts", i, step))
    return _kept(per.select(*group, blocks.alias("cuts")), "cuts")


def segmented(df: DataFrame, *, group: Sequence[str], order: Sequence[str], rows: int = ROWS) -> tuple[DataFrame, bool]:
    """``df`` with ``__segment`` (ascending with the order inside a group; 0 in groups that are not cut) and
    ``__hot``, and whether any group was cut. Order columns must not be NULL."""
    large = large_groups(df, group, rows)
    if large is None:
        return df.withColumns({SEGMENT: F.lit(0), HOT: F.lit(False)}), False
    cuts = _named(_cuts(df, group, order, large, rows), group, "c_")
    here = F.struct(*[F.col(o).alias(o) for o in order])
    below = lambda a: F.size(F.filter(a, lambda c: c <= here))
    block = F.size(F.filter("cuts", lambda b: b[0] <= here))
    width = F.size(F.col("cuts")[0])
    segment = F.when(F.col("cuts").isNull() | (block == 0), 0).otherwise(
        (block - 1) * width + below(F.element_at("cuts", F.greatest(block, F.lit(1)))))
    j = df.join(cuts, _same(df, cuts, group, "c_"), "left")
    return j.select(*df.columns, segment.alias(SEGMENT), F.col("cuts").isNotNull().alias(HOT)), True


def carried(seg: DataFrame, *, group: Sequence[str], own: Column, scan) -> DataFrame:
    """``(*group, __segment, carry)`` of the segments of cut groups: ``own`` aggregated over each segment, and
    ``scan(Column)`` of that (an aggregate such as ``F.max``) over the group's earlier segments."""
    per = seg.filter(HOT).groupBy(*group, SEGMENT).agg(own.alias("__own"))
    before = Window.partitionBy(*group).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    return per.select(*group, SEGMENT, scan(F.col("__own")).over(before).alias("carry"))
