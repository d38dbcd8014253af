"""Point-in-time operators: knowledge-time cuts, the latest-per-key dedupe and the as-of join.

The core rule (FLT01 + WIN01): keep rows with ``posted <= as_of`` and, per business key, the row
with the latest ``posted`` (ties: latest ``ingested``). NULL key parts group together.

Plan shape: the cut is a plain filter, so it reaches the Parquet scan as a pushed filter; the
dedupe is ``row_number() = 1`` over the business key, which Spark plans as a partial
``WindowGroupLimit`` before the shuffle (each task keeps one row per key) and a final one after.
A key that holds a third of all rows therefore sends at most one row per map task across the
network, and the reduce side sorts only those.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asofspark.functions import time as T
from asofspark.operators import carry as CA

_RN = "__pit_rn"


def _cols(names) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def _ts(value) -> Column:
    """A cut moment: a Column, or a literal cast to TIMESTAMP_NTZ (UTC wall clock)."""
    if isinstance(value, Column):
        return value
    return F.lit(value).cast("timestamp_ntz")


def known_by(df: DataFrame, as_of, *, posted: str = "posted_at", ingested: str | None = None,
             system_as_of=None) -> DataFrame:
    """FLT01 (``posted <= as_of``, inclusive) and optionally FLT02 (``ingested <= system_as_of``)."""
    out = df.filter(F.col(posted) <= _ts(as_of))
    if system_as_of is not None:
        if ingested is None:
            raise ValueError("system_as_of needs the ingested column")
        out = out.filter(F.col(ingested) <= _ts(system_as_of))
    return out


def latest(df: DataFrame, *, key: Sequence[str] | str, posted: str = "posted_at",
           tie: Sequence[str] | str = ()) -> DataFrame:
    """WIN01: the latest row per business key (latest ``posted``, then latest ``tie`` columns)."""
    order = [F.col(posted).desc()] + [F.col(t).desc() for t in _cols(tie)]
    w = Window.partitionBy(*[F.col(k) for k in _cols(key)]).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def latest_as_of(df: DataFrame, *, key, as_of, posted: str = "posted_at", tie=(),
                 ingested: str | None = None, system_as_of=None) -> DataFrame:
    """FLT01 + FLT02 + WIN01: what was known at ``as_of``, one row per business key.

    Filters on anything but the clocks and the key must come *before* this call only when they
    are on the key (name filters); a filter on a value column belongs after it.
    """
    cut = known_by(df, as_of, posted=posted, ingested=ingested, system_as_of=system_as_of)
    return latest(cut, key=key, posted=posted, tie=tie)


def order_by_key(df: DataFrame, key) -> DataFrame:
    """SRT01: ordered by business key, NULLs last (the reference's engine sorts NULL last)."""
    return df.orderBy(*[F.col(k).asc_nulls_last() for k in _cols(key)])


def postings(df: DataFrame, *, key, as_of, posted: str = "posted_at") -> DataFrame:
    """JOB03/SRT02: every version known at ``as_of``, ordered by key then ``posted``; no dedupe."""
    cut = known_by(df, as_of, posted=posted)
    return cut.orderBy(*[F.col(k).asc_nulls_last() for k in _cols(key)], F.col(posted))


def between_intervals(df: DataFrame, start, end, col: str = "interval_start") -> DataFrame:
    """FLT03: half-open ``[start, end)``; an empty range is an error."""
    if not isinstance(start, Column) and not isinstance(end, Column) and end <= start:
        raise ValueError(f"empty interval range {start} .. {end}")
    return df.filter((F.col(col) >= _ts(start)) & (F.col(col) < _ts(end)))


def named(df: DataFrame, col: str, names: Sequence[str] | None) -> DataFrame:
    """FLT04: ``col IN names``; ``None`` or an empty list means no filter."""
    if not names:
        return df
    return df.filter(F.col(col).isin(list(names)))


def delivery_between(df: DataFrame, d_from, d_to, col: str = "date") -> DataFrame:
    """FLT07: inclusive delivery-day range."""
    return df.filter(F.col(col).between(F.lit(d_from).cast("date"), F.lit(d_to).cast("date")))


def require_versions(df: DataFrame, supported=(1,), col: str = "schema_version") -> DataFrame:
    """FLT09: refuse rows at an unsupported schema version.

    The check is one small job (``limit(1)`` over a pushed filter) and raises on the driver;
    it looks at the input rows, before any dedupe (stricter than checking only results).
    """
    bad = df.filter(~F.col(col).isin(list(supported)) | F.col(col).isNull()).select(col).limit(1).collect()
    if bad:
        raise ValueError(f"rows at schema_version {bad[0][0]}; supported: {sorted(supported)}")
    return df


def version_counts(df: DataFrame, supported=(1,), col: str = "schema_version") -> DataFrame:
    """FLT09 as data: rows per schema version with a ``supported`` flag (no driver raise)."""
    return (df.groupBy(F.col(col).alias("schema_version"))
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .withColumn("supported", F.col("schema_version").isin(list(supported))))


def _bucket_start(time: Column, width: str) -> Column:
    """Number of the ``width`` (such as ``1 day``) that a wall clock falls in; NULL for NULL."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    span = T.ntz_micros(epoch + F.expr(f"INTERVAL {width}"))
    return F.floor(T.ntz_micros(time) / span)


def point_in_time_join(decisions: DataFrame, facts: DataFrame, *, on: Sequence[str] | str,
                       decision_time: str, posted: str, value_cols: Sequence[str],
                       rows: int | None = CA.ROWS, bucket: str | None = None) -> DataFrame:
    """JN06: for every decision row, the fact values known at its ``decision_time``.

    A fact counts as known when ``posted <= decision_time`` (equality included). Decisions with
    nothing known get NULL values (left semantics). ``facts`` must hold one row per
    (key, posted) (already deduplicated per business key if it is a revision log).

    Plan: decisions and facts are unioned and a running ``last(struct, ignorenulls)`` over the key
    ordered by time carries the newest known fact forward: one shuffle of the rows, no pairs. A key
    with more than ``rows`` rows is cut into segments of equal rows (:mod:`.carry`), also where all its
    rows share one time, and the fact that comes into a segment from earlier ones is an exclusive scan
    over one row per segment: no width to choose, and a hot key keeps every task busy. With
    ``bucket`` (such as ``1 day``) every key is cut at fixed times instead, without a count of the keys
    before; with ``rows=None`` no key is cut and none is counted, for keys known to be small. The answer depends on none of these: keys match null-safely, a decision
    without a time knows nothing and is kept, a fact without a time is never known.
    """
    keys = _cols(on)
    vals = list(value_cols)
    fact_struct = F.struct(F.col(posted).alias("__t"), *[F.col(v).alias(v) for v in vals])
    f = facts.select(*[F.col(k) for k in keys], F.col(posted).alias("__time"),
                     F.lit(0).alias("__side"), fact_struct.alias("__fact"))
    d_cols = [c for c in decisions.columns]
    d = decisions.select(*[F.col(k) for k in keys], F.col(decision_time).alias("__time"),
                         F.lit(1).alias("__side"), F.lit(None).cast(f.schema["__fact"].dataType).alias("__fact"),
                         F.struct(*[F.col(c) for c in d_cols]).alias("__dec"))
    f = f.filter(F.col("__time").isNotNull()).withColumn("__dec", F.lit(None).cast(d.schema["__dec"].dataType))
    both = f.unionByName(d)
    part = [F.col(k) for k in keys]
    if bucket is None and rows is not None:
        # facts before decisions of the same time; decisions of one time may be cut anywhere
        both = both.withColumns({"__at": F.coalesce(T.ntz_micros("__time"), F.lit(-(1 << 63))),
                                 "__tie": F.when(F.col("__side") == 1, F.rand(0)).otherwise(F.lit(0.0))})
        both, cut = CA.segmented(both, group=keys, order=["__at", "__side", "__tie"], rows=rows)
        both = both.drop("__at", "__tie")
        if cut:
            newest = F.max_by("__fact", F.when(F.col("__side") == 0, F.col("__time")))
            seeds = CA.carried(both, group=keys, own=newest, scan=lambda c: F.last(c, ignorenulls=True))
            seeds = seeds.filter(F.col("carry").isNotNull()).select(
                *keys, CA.SEGMENT, F.lit(None).cast("timestamp_ntz").alias("__time"), F.lit(-1).alias("__side"),
                F.col("carry").alias("__fact"), F.lit(None).cast(d.schema["__dec"].dataType).alias("__dec"))
            both = both.drop(CA.HOT).unionByName(seeds)
            part = part + [F.col(CA.SEGMENT)]
    elif bucket is not None:
        both = both.withColumn("__bucket", _bucket_start(F.col("__time"), bucket))
        # every bucket of a key with its newest fact, if any (grouping is null-safe)
        fact = F.col("__side") == 0
        buckets = both.groupBy(*keys, "__bucket").agg(
            F.max_by(F.when(fact, F.col("__fact")), F.when(fact, F.col("__time"))).alias("__own"))
        # the fact carried into a bucket is the newest fact of any earlier bucket of the key;
        # this window runs over one small summary row per (key, bucket)
        wall = Window.partitionBy(*part).orderBy(F.col("__bucket").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
        seeded = (buckets.withColumn("__seed", F.last("__own", ignorenulls=True).over(wall))
                  .filter(F.col("__seed").isNotNull() & F.col("__bucket").isNotNull())
                  .select(*keys, "__bucket", F.lit(None).cast("timestamp_ntz").alias("__time"),
                          F.lit(-1).alias("__side"), F.col("__seed").alias("__fact"),
                          F.lit(None).cast(d.schema["__dec"].dataType).alias("__dec")))
        both = both.unionByName(seeded)
        part = part + [F.col("__bucket")]
    w = (Window.partitionBy(*part)
         .orderBy(F.col("__time").asc_nulls_first(), F.col("__side"))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    known = F.last(F.col("__fact"), ignorenulls=True).over(w)
    out = both.withColumn("__known", known).filter(F.col("__side") == 1)
    return out.select(*[F.col("__dec").getField(c).alias(c) for c in d_cols],
                      F.col("__known").getField("__t").alias("known_posted"),
                      *[F.col("__known").getField(v).alias(v) for v in vals])
