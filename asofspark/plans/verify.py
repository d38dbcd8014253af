"""Lake verification (JOB09): whole-product checks unioned into findings rows.

Checks: business keys stored twice for the same posting time (AGG02, the five most repeated per product,
and the number of all where there are more),
NULLs in required columns per batch directory (AGG04), schema versions per batch directory
(AGG05), missing delivery days between the first and last present day (SET04), and optionally
zone sums against totals for series tables (AGG03). Each check is one grouped aggregate over
the product (partial aggregation before the shuffle); the findings are data, and the caller
decides whether any finding is a failure.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asofspark.operators import checks as CK
from asofspark.plans.compact import REQUIRED
from asofspark.plans.declare import SUPPORTED_VERSIONS

FINDING_SCHEMA = "product string, check string, detail string"


def _ts_text(c):
    return F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss")


def verify(lake: DataFrame, key: list[str], *, supported=SUPPORTED_VERSIONS, zone_sums: dict | None = None) -> DataFrame:
    """``lake``: curated rows with ``product``, ``date`` and ``batch`` (a read of the curated
    root). ``key``: the business key without ``product``. ``zone_sums``: product -> (names of the
    zone series, name of their total)."""
    found = []
    # AGG02 + SRT07: repeated (key, posted_at) per product, the five most repeated
    g = lake.groupBy("product", *key, "posted_at").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    found.append(g.groupBy("product").agg(F.count(F.lit(1)).alias("n")).filter("n > 5").select(
        "product", F.lit("keys").alias("check"), F.concat(F.col("n").cast("string"), F.lit(" repeated keys in all")).alias("detail")))
    g = CK.first_per_group(g, "product", [F.col("n").desc(), *[F.col(k).asc_nulls_last() for k in key], F.col("posted_at")], 5)
    parts = [(_ts_text(k) if dict(lake.dtypes)[k].startswith("timestamp") else F.coalesce(F.col(k).cast("string"), F.lit("NULL")))
             for k in key]
    found.append(g.select("product", F.lit("keys").alias("check"),
                          F.concat(F.concat_ws("|", *parts), F.lit(" posted "), _ts_text("posted_at"),
                                   F.lit(" x"), F.col("n").cast("string")).alias("detail")))
    # AGG04: NULLs in required columns per batch directory
    required = [c for c in REQUIRED if c in lake.columns]
    batch = F.concat(F.lit("date="), F.col("date").cast("string"), F.lit(" batch="), F.col("batch"))
    nulls = CK.null_audit(lake.withColumn("file", batch).withColumn("file", F.concat_ws("#", "product", "file")),
                          required, by="file")
    found.append(nulls.select(F.split_part("file", F.lit("#"), F.lit(1)).alias("product"), F.lit("nulls").alias("check"),
                              F.concat(F.split_part("file", F.lit("#"), F.lit(2)), F.lit(": "), F.col("column"),
                                       F.lit(" has "), F.col("n_null").cast("string"), F.lit(" NULL")).alias("detail")))
    # AGG05: unsupported schema versions per batch directory
    ver = CK.version_audit(lake.withColumn("file", F.concat_ws("#", F.col("product"), batch)), supported, by="file")
    found.append(ver.filter("unsupported").select(
        F.split_part("file", F.lit("#"), F.lit(1)).alias("product"), F.lit("versions").alias("check"),
        F.concat(F.split_part("file", F.lit("#"), F.lit(2)), F.lit(": versions "), F.col("versions")).alias("detail")))
    # SET04: delivery days missing between the first and last present day
    gaps = CK.calendar_gaps(lake.select("product", F.col("date").alias("day")), day="day", by="product")
    found.append(gaps.select("product", F.lit("calendar").alias("check"),
                             F.concat(F.lit("missing day "), F.col("day").cast("string")).alias("detail")))
    # AGG03: zone series against their total, per (interval, posting)
    for product, (zones, total) in (zone_sums or {}).items():
        p = lake.filter(F.col("product") == product)
        f = CK.sum_findings(p, by=["interval_start", "posted_at"], part=F.col("series").isin(list(zones)),
                            total=F.col("series") == total, value="value", expected_parts=len(zones))
        found.append(f.select(F.lit(product).alias("product"), F.lit("zone_sum").alias("check"),
                              F.concat(_ts_text("interval_start"), F.lit(": zones "), F.format_number("parts_sum", 1),
                                       F.lit(" total "), F.coalesce(F.format_number("total", 1), F.lit("missing"))).alias("detail")))
    return reduce(DataFrame.unionByName, found)
