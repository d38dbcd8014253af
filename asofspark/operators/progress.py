"""Ingest progress as data: safe watermark (WIN05), run summary (AGG08), watermark upsert
(SNK05), manifest carry-over (SNK03) and the catalog of products (SNK04, JN04, SET05).

State tables hold one row per product, so the joins here are between small tables; the one
large input (postings) is reduced by a grouped aggregate with partial combining first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def safe_progress(postings: DataFrame, *, product: str = "product", posted: str = "posted_at",
                  doc: str = "doc_id", bad: str = "bad") -> DataFrame:
    """WIN05: per product, the first failed or deferred posting (by posted, then doc id) and
    the newest posting before it, which is how far the watermark may advance; later postings
    are held back. One aggregate for the stop point, a broadcast-size join, one aggregate."""
    stop = (postings.filter(F.col(bad))
            .groupBy(product).agg(F.min(F.struct(posted, doc)).alias("__stop")))
    # one row per product: broadcast, so a product holding most postings does not skew a join
    j = postings.join(F.broadcast(stop), on=product, how="left")
    before = F.col("__stop").isNull() | (F.struct(posted, doc) < F.col("__stop"))
    return j.groupBy(product).agg(
        F.max(F.when(before, F.col(posted))).alias("watermark"),
        F.first(F.col("__stop").getField(posted), ignorenulls=True).alias("stopped_at"),
        F.count(F.when(before, F.lit(1))).alias("taken"),
        F.count(F.when(~before, F.lit(1))).alias("held"),
    )


def run_summary(rows: DataFrame, *, product: str = "product", doc: str = "doc_id",
                posted: str = "posted_at", date: str = "date", interval: str = "interval_start",
                n_rows: str | None = None) -> DataFrame:
    """AGG08: per product docs, rows, distinct partitions touched, newest posting and interval."""
    nrows = F.sum(n_rows).cast("bigint") if n_rows else F.count(F.lit(1))
    return rows.groupBy(product).agg(
        F.count_distinct(doc).alias("docs"), nrows.alias("rows"),
        F.count_distinct(date).alias("partitions"),
        F.max(posted).alias("last_posted_at"), F.max(interval).alias("latest_interval_start"),
    )


def merge_watermarks(previous: DataFrame, run: DataFrame) -> DataFrame:
    """SNK05: upsert per product. ``run``: (product, last_posted_at, run_at, status, error);
    a run's NULL last_posted_at keeps the previous one; ok clears the error."""
    p = previous.select("product", *[F.col(c).alias("p_" + c) for c in ("last_posted_at", "last_run_at", "status", "error")])
    r = run.select("product", *[F.col(c).alias("r_" + c) for c in ("last_posted_at", "run_at", "status", "error")])
    j = p.join(r, on="product", how="full")
    return j.select(
        "product",
        F.coalesce("r_last_posted_at", "p_last_posted_at").alias("last_posted_at"),
        F.coalesce("r_run_at", "p_last_run_at").alias("last_run_at"),
        F.coalesce("r_status", "p_status").alias("status"),
        F.when(F.col("r_status") == "ok", F.lit(None).cast("string"))
        .when(F.col("r_status").isNotNull(), F.col("r_error")).otherwise(F.col("p_error")).alias("error"),
    )


def carry_manifest(previous: DataFrame, run: DataFrame) -> DataFrame:
    """SNK03: a run's manifest; when it took no documents, last_posted_at,
    latest_interval_start and partitions carry over from the previous manifest."""
    p = previous.select("product", *[F.col(c).alias("p_" + c) for c in ("last_posted_at", "latest_interval_start", "partitions")])
    j = run.join(p, on="product", how="left")
    empty = F.col("docs") == 0
    return j.select(
        "product", "run_at", "docs", "rows",
        F.when(empty, F.col("p_last_posted_at")).otherwise(F.col("last_posted_at")).alias("last_posted_at"),
        F.when(empty, F.col("p_latest_interval_start")).otherwise(F.col("latest_interval_start")).alias("latest_interval_start"),
        F.when(empty, F.col("p_partitions")).otherwise(F.col("partitions")).alias("partitions"),
        F.lit(1).alias("schema_version"),
    )


def build_catalog(config: DataFrame, manifests: DataFrame, previous: DataFrame) -> DataFrame:
    """SNK04: configured products are live; a product no longer configured but with a manifest
    stays with live=false (from the previous catalog's table if known); products with a
    manifest but neither config nor history are reported with live=NULL and status 'orphan'."""
    live = config.select("product", "table", F.lit(True).alias("live"), F.lit("configured").alias("status"))
    gone = (manifests.select("product").join(config.select("product"), on="product", how="left_anti")
            .join(previous.select("product", "table"), on="product", how="inner")
            .select("product", "table", F.lit(False).alias("live"), F.lit("retired").alias("status")))
    orphan = (manifests.select("product").join(config.select("product"), on="product", how="left_anti")
              .join(previous.select("product"), on="product", how="left_anti")
              .select("product", F.lit(None).cast("string").alias("table"), F.lit(None).cast("boolean").alias("live"),
                      F.lit("orphan").alias("status")))
    return live.unionByName(gone).unionByName(orphan)


def catalog_changed(new: DataFrame, previous: DataFrame) -> DataFrame:
    """Whether the catalog content (without generated_at) differs: ``exceptAll`` both ways."""
    cols = ["product", "table", "live"]
    a, b = new.select(*cols), previous.select(*cols)
    diff = a.exceptAll(b).unionByName(b.exceptAll(a))
    return diff.agg((F.count(F.lit(1)) > 0).alias("changed"))
