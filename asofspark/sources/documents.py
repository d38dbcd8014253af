"""API pages, JSON objects, archive listings, source planning and workbook rows
(SRC03, SRC04, SRC06, SRC07, SRC08, SRC11, SRT04).

All of them are DataFrame transformations of files read by Spark (``text`` with
``wholetext``) or of listing tables; the repeated-hour rule of a listing is WIN02.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asofspark.functions import time as T
from asofspark.operators.repeated import resolve_repeated_hour

PAGE_SCHEMA = "struct<fields:array<struct<name:string>>, data:array<array<string>>>"


def read_api_pages(spark: SparkSession, root: str, glob: str = "*.json") -> DataFrame:
    """SRC03: every page file ``{"fields": [{"name"}], "data": [[...]]}`` -> one row per data
    row with the page's header; numbers and booleans arrive as their JSON text; pages union."""
    pages = (spark.read.option("wholetext", "true").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "true").text(root)
             .select(F.col("_metadata.file_path").alias("path"), "value"))
    return parse_api_pages(pages, "value")


def parse_api_pages(pages: DataFrame, value: str) -> DataFrame:
    """SRC03 on a text column: the other columns of ``pages`` with header, row_no and cells of every
    data row, ready for the declared transform of the product's API format."""
    rest = [c for c in pages.columns if c != value]
    p = pages.select(*rest, F.from_json(value, PAGE_SCHEMA).alias("p"))
    # the header is a column before the explode: a row carries the header, never the whole page
    p = p.select(*rest, F.transform("p.fields", lambda f: f["name"]).alias("header"), F.col("p.data").alias("data"))
    return p.select(*rest, "header", F.posexplode("data").alias("row_no", "cells"))


def parse_json_objects(df: DataFrame, value: str, schema: str) -> DataFrame:
    """SRC11 on a text column: the object parsed with an explicit schema plus ``status``
    'ok' or 'unreadable' (malformed JSON, via the corrupt-record column)."""
    full = f"{schema}, _corrupt string"
    obj = F.from_json(F.col(value), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    out = df.withColumn("obj", obj)
    status = F.when(F.col(value).isNull(), F.lit("missing")).when(
        F.col("obj").isNull() | F.col("obj._corrupt").isNotNull(), F.lit("unreadable")).otherwise(F.lit("ok"))
    return out.withColumn("status", status)


def read_json_objects(spark: SparkSession, root: str, schema: str, expected: DataFrame | None = None,
                      glob: str = "*.json") -> DataFrame:
    """SRC11 on files: JSON objects (manifests, heartbeats, report sections) under ``root``;
    with an ``expected`` list of paths, absent ones get status 'missing'."""
    files = (spark.read.option("wholetext", "true").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "true").text(root)
             .select(F.col("_metadata.file_path").alias("path"), "value"))
    if expected is not None:
        plain = lambda c: F.regexp_replace(c, "^file:/+", "/")  # noqa: E731  (one file, written three ways)
        found = files.select(plain("path").alias("found"), "value")
        files = expected.select("path").join(found, plain("path") == F.col("found"), how="left").drop("found")
    return parse_json_objects(files, "value", schema)


def listing_docs(listing: DataFrame, post_from, post_to, *, by=(), tz: str = T.CT) -> DataFrame:
    """SRC06 + FLT08 + SRT04: a listing ``(doc_id, post_local_text, friendly_name)`` ->
    ``(doc_id, posted_at, name)`` with the repeated hour resolved by doc order, kept when
    ``post_from < posted_at <= post_to``, oldest first (ties by doc id); the name falls back to
    the doc id. A document whose stamp cannot be read is in every window, first, without a time and
    with a ``problem``: where it belongs is not known, and it is never passed over."""
    df = listing.withColumn("__local", T.parse_post_local(F.col("post_local_text")))
    r = resolve_repeated_hour(df, order="doc_id", local="__local", by=list(by), tz=tz, out="posted_at")
    lo, hi = F.lit(post_from).cast("timestamp_ntz"), F.lit(post_to).cast("timestamp_ntz")
    bad = F.when(F.col("__local").isNull(), F.concat(F.lit("unreadable posting time: "), F.coalesce("post_local_text", F.lit("none"))))
    r = r.withColumn("problem", bad).filter(((F.col("posted_at") > lo) & (F.col("posted_at") <= hi)) | F.col("problem").isNotNull())
    name = F.coalesce(F.col("friendly_name"), F.col("doc_id").cast("string"))
    return r.select(*by, "doc_id", "posted_at", name.alias("name"), "problem").orderBy("posted_at", "doc_id")


def history_docs(listing: DataFrame, products: DataFrame, product: str, post_from, post_to) -> DataFrame:
    """SRC08: the product's declared history archive, sliced like SRC06; no declared archive
    is an error."""
    arch = products.filter(F.col("product") == product).select("history_archive").collect()
    if not arch or arch[0][0] is None:
        raise ValueError(f"{product}: no history archive declared")
    return listing_docs(listing.filter(F.col("archive_id") == arch[0][0]), post_from, post_to)


def plan_sources(window_lo, window_hi, bundles: DataFrame, listing: DataFrame, tz: str = T.CT) -> DataFrame:
    """SRC07 + JN03: the local months a posting window ``(lo, hi]`` touches; a month with a
    bundle reads its last listed bundle (one row), a month without falls back to the listing
    docs of that month inside the window. ``bundles``: (month DATE, bundle_id, listed_at);
    ``listing``: (doc_id, posted_at)."""
    lo, hi = F.lit(window_lo).cast("timestamp_ntz"), F.lit(window_hi).cast("timestamp_ntz")
    spark = bundles.sparkSession
    first = F.trunc(T.delivery_date(lo, tz), "month")
    last = F.trunc(T.delivery_date(hi, tz), "month")
    months = spark.range(1).select(F.explode(F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))).alias("month"))
    newest = bundles.groupBy("month").agg(F.max_by("bundle_id", F.struct("listed_at", "bundle_id")).alias("bundle_id"))
    with_bundle = months.join(newest, on="month", how="inner").select(
        "month", F.lit("bundle").alias("source"), F.col("bundle_id").alias("id"), F.lit(None).cast("timestamp_ntz").alias("posted_at"))
    bare = months.join(newest, on="month", how="left_anti")
    docs = listing.filter((F.col("posted_at") > lo) & (F.col("posted_at") <= hi)).withColumn(
        "month", F.trunc(T.delivery_date("posted_at", tz), "month"))
    from_listing = docs.join(bare, on="month", how="left_semi").select(
        "month", F.lit("listing").alias("source"), F.col("doc_id").cast("string").alias("id"), "posted_at")
    return with_bundle.unionByName(from_listing)


def workbook_rows(cells: DataFrame, header_first: str = "Delivery Date", order=(0, 1, 2, 3, 4, 5)) -> DataFrame:
    """SRC04: sheet rows ``(file, sheet, row_no, c0..c5)`` -> archive-shaped rows: per sheet the
    first row whose first cell is the header marker, then later rows whose first cell is a date
    (``M/d/yyyy`` or ISO), columns reordered, date written ``MM/dd/yyyy``. Sheets without a
    header or rows yield nothing."""
    # the header position is one aggregate row per sheet, joined back (no sheet-wide window)
    hdr = (cells.filter(F.trim(F.col("c0")) == header_first).groupBy("file", "sheet")
           .agg(F.min("row_no").alias("__hdr")))
    df = cells.join(hdr, on=["file", "sheet"], how="inner").filter(F.col("row_no") > F.col("__hdr"))
    day = T.parse_delivery_date(F.col("c0"))
    df = df.withColumn("__day", day).filter(F.col("__day").isNotNull())
    out = [F.date_format("__day", "MM/dd/yyyy").alias("c0")] + [F.col(f"c{i}").alias(f"c{j}") for j, i in enumerate(order) if j > 0]
    return df.select("file", "sheet", "row_no", *out)
