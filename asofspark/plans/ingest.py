"""Ingestion (JOB06), backfill (JOB07) and rebuild (JOB16) as one DataFrame job.

raw postings -> landed raw (SNK01) -> CSV records on executors (SRC01/SRC02) -> declared
transform per product (JOB05) -> posting status: drift, row problems, business keys repeated
within a posting (AGG01) -> safe progress per product (WIN05): a failed or deferred posting
stops the product, later postings wait -> curated write (SNK02) of accepted postings, optionally
clipped to a delivery range (FLT07) -> watermarks (SNK05) and manifests (SNK03) unless it is a
backfill -> summary (AGG08).

Every posting of every product is processed in parallel; the sequential guarantee of a
posting-by-posting loop is recovered by the WIN05 cut. Products are isolated: one product's
failure only stops that product: an archive that cannot be read, a header without its columns
and a product that is not declared are problems of their posting. The records are persisted
once (they feed the status aggregate and the write), and released in any case.
"""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from asofspark.functions import time as T
from asofspark.operators import checks as CK
from asofspark.operators import digest as DG
from asofspark.operators import progress as PG
from asofspark.operators import slots as SL
from asofspark.plans import transform as TR
from asofspark.plans.declare import Declaration
from asofspark.plans.read import read_curated
from asofspark.session import scratch_path
from asofspark.sources import archive as AR
from asofspark.sources import fileindex as FI
from asofspark.sources import lake as LK
from asofspark.sources import snapshots as SN

STATUS_SCHEMA = "product string, posting string, posted_at timestamp_ntz, doc_id bigint, status string, problem string"


def _posting_key() -> F.Column:
    """A posting's name: product, document (its file name where it has no id) and stamp; never NULL."""
    doc = F.coalesce(F.col("doc_id").cast("string"), F.col("name"), F.lit("-"))
    return F.concat_ws("|", F.coalesce(F.col("product"), F.lit("?")), doc, F.coalesce(T.stamp("posted_at"), F.lit("?")))


def resolve_windows(raw: DataFrame, watermarks: DataFrame | None, now, lookback_hours: int = 24,
                    explicit: tuple | None = None) -> DataFrame:
    """FLT08: keep postings in ``post_from < posted_at <= post_to``; ``post_from`` is the
    product's watermark, else ``now - lookback``; an explicit window overrides both."""
    now_c = F.lit(now).cast("timestamp_ntz")
    if explicit is not None:
        lo, hi = (F.lit(x).cast("timestamp_ntz") for x in explicit)
        return raw.filter((F.col("posted_at") > lo) & (F.col("posted_at") <= hi))
    default = now_c - F.make_dt_interval(F.lit(0), F.lit(lookback_hours))
    if watermarks is None:
        return raw.filter((F.col("posted_at") > default) & (F.col("posted_at") <= now_c))
    wm = watermarks.select("product", F.col("last_posted_at").alias("__wm"))
    j = raw.join(F.broadcast(wm), on="product", how="left")  # one row per product
    return j.filter((F.col("posted_at") > F.coalesce("__wm", default)) & (F.col("posted_at") <= now_c)).drop("__wm")


def newest_copy(raw: DataFrame) -> DataFrame:
    """One row per posting (product, doc_id, posted_at) when a posting arrives more than once:
    a copy with content beats a listed placeholder (NULL content), then the newest received
    copy wins, so a redelivered correction replaces a failed copy. ``row_number() = 1`` is
    planned with a partial top-1 per task before the shuffle."""
    order = [F.col("content").isNull().asc()]
    if "received_at" in raw.columns:
        order.append(F.col("received_at").desc_nulls_last())
    w = Window.partitionBy("product", "doc_id", "posted_at").orderBy(*order, F.col("name").desc())
    return raw.withColumn("__copy", F.row_number().over(w)).filter(F.col("__copy") == 1).drop("__copy")


def transform_postings(raw: DataFrame, decls: dict[str, Declaration], *, ingested_at) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(curated rows of every posting, status per posting, the persisted records, for the caller to
    release). ``raw``: (product, posted_at, doc_id, name, content); a NULL content is a listed
    posting not yet available (deferred)."""
    keyed = raw.withColumn("posting", _posting_key())
    avail = keyed.filter(F.col("content").isNotNull())
    deferred = keyed.filter(F.col("content").isNull()).select(
        "product", "posting", "posted_at", "doc_id", F.lit("deferred").alias("status"),
        F.lit("not yet available").alias("problem"))
    meta = avail.select("posting", "product", "posted_at", "doc_id")
    # what names a posting comes with its records through the unpacking: they are not joined or shuffled
    rec = AR.unpack(avail, "posting", "content", carry=["product", "posted_at", "doc_id"]).withColumnRenamed("path", "posting")
    rec = rec.withColumn("ingested_at", F.lit(ingested_at).cast("timestamp_ntz"))
    # unpacked once: every product's transform, drift check and key check read these records
    rec = rec.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return *_transformed(rec, meta, deferred, decls), rec
    except BaseException:
        rec.unpersist()
        raise


def _transformed(rec: DataFrame, meta: DataFrame, deferred: DataFrame, decls: dict[str, Declaration]) -> tuple[DataFrame, DataFrame]:
    """Curated rows and status of the postings whose records are ``rec``."""
    lines = rec.filter(F.col("cells").isNotNull())
    broken = rec.groupBy("posting").agg(F.min("problem").alias("broken")).filter(F.col("broken").isNotNull())
    # per product only the declared expressions differ; the checks run once over all products
    rows_all = []
    for product, decl in decls.items():
        r = lines.filter(F.col("product") == product).drop("problem")
        rows = TR.transform(r, decl, carry=["product", "doc_id"])
        key_text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in decl.key])
        rows_all.append(rows.withColumn("__key", key_text))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows_all)
    # headers count even where no data line follows them
    drift = TR.check_columns(rec.filter(F.col("header").isNotNull() & F.col("product").isin(list(decls))), decls)
    dup = CK.repeated_keys(rows, key=["__key"], by="posting").select(
        "posting", F.concat(F.lit("business key repeated in posting: "), F.col("n_repeated_keys").cast("string"),
                            F.lit(" keys, e.g. "), F.col("example")).alias("dup_problem"))
    st = TR.posting_status(rows, drift).join(dup, on="posting", how="left")
    st = st.select("posting", F.coalesce(F.col("problem"), F.col("dup_problem")).alias("found"))
    undeclared = F.when(~F.coalesce(F.col("product").isin(list(decls)), F.lit(False)), F.lit("product is not declared"))
    problem = F.coalesce(undeclared, F.col("broken"), F.col("found"))
    status = meta.join(st, on="posting", how="left").join(broken, on="posting", how="left").select(
        "product", "posting", "posted_at", "doc_id",
        F.when(problem.isNull(), F.lit("ok")).otherwise(F.lit("failed")).alias("status"), problem.alias("problem"))
    status = status.unionByName(deferred)
    return rows.drop("__key"), status


def ingest(spark: SparkSession, raw: DataFrame, decls: dict[str, Declaration], root: str, *,
           ingested_at, run_at=None, update_progress: bool = True, delivery_range=None,
           land: bool = True, pending: tuple[str, int] | None = None, window: dict | None = None) -> DataFrame:
    """JOB06 (JOB07 with ``update_progress=False``): returns the per-product run summary.

    ``land=True`` writes the postings to ``raw/`` first; pass ``land=False`` when ``raw`` is
    itself read from that landing (a re-landing would replace the files being read). ``window``
    (arguments of :func:`resolve_windows`) limits the postings by the products' watermarks.

    With ``pending=(path, version)`` the names of the postings that were not taken (failed,
    deferred, or held back behind one) are written there as that version, after the curated
    rows: an incremental caller offers them again (STR02), and a crash before that point leaves
    the version before, from which a replay gives the same rows."""
    run_at = run_at or ingested_at
    if window is not None:
        raw = resolve_windows(raw, read_state(spark, root, "watermarks"), **window)
    if land:
        LK.land_raw(raw.filter(F.col("content").isNotNull()), root)
    held = []
    try:
        rows, status, records = transform_postings(raw, decls, ingested_at=ingested_at)
        held.append(records)
        status = status.persist(StorageLevel.MEMORY_AND_DISK)
        held.append(status)
        progress = PG.safe_progress(status.withColumn("bad", F.col("status") != "ok"), doc="doc_id")
        stops = (status.filter(F.col("status") != "ok").groupBy("product")
                 .agg(F.min(F.struct("posted_at", "doc_id")).alias("__stop")))
        taken = (status.filter(F.col("status") == "ok").withColumnRenamed("product", "p")
                 .join(F.broadcast(stops), on=F.col("p").eqNullSafe(F.col("product")), how="left")  # one row per product
                 .filter(F.col("__stop").isNull() | (F.struct("posted_at", "doc_id") < F.col("__stop")))
                 .select("posting"))
        accepted = rows.join(taken, on="posting", how="left_semi").drop("problem")
        out = LK.with_batch(accepted, doc="doc_id")
        if delivery_range is not None:
            out = out.filter(F.col("date").between(F.lit(delivery_range[0]).cast("date"), F.lit(delivery_range[1]).cast("date")))
        out = out.persist(StorageLevel.MEMORY_AND_DISK)  # written, then summarised
        held.append(out)
        keep = [c for c in out.columns if c not in ("posting", "doc_id")]
        LK.write_curated(out.select(*keep), root)
        if SN.newest(spark, root) is not None:  # a lake with a snapshot log: visible from here on
            SN.commit(spark, root, out.select("product", "date", "batch"))
            if FI.indexed(spark, root):
                FI.update(spark, root)
        if read_state(spark, root, "slots") is not None:
            record_slots(spark, root, out)
        if pending is not None:
            left = raw.withColumn("posting", _posting_key()).join(taken, on="posting", how="left_anti")
            path, version = pending
            LK.write_version(spark, left.drop("posting", "content"), path, version)
        summary = (PG.run_summary(out, doc="posting", posted="posted_at").drop("docs", "last_posted_at")
                   .join(status.groupBy("product").agg(
                       F.count_if(F.col("status") == "failed").alias("failed"),
                       F.count_if(F.col("status") == "deferred").alias("deferred"),
                       F.min(F.when(F.col("status") == "failed", F.col("problem"))).alias("error")), on="product", how="full")
                   # documents and watermark are those of the postings taken, with or without rows
                   .join(progress.select("product", F.col("taken").alias("docs"), F.col("watermark").alias("last_posted_at"),
                                         "stopped_at"), on="product", how="left"))
        summary = summary.withColumn("rows", F.coalesce("rows", F.lit(0))).withColumn("partitions", F.coalesce("partitions", F.lit(0)))
        summary = spark.createDataFrame(summary.collect(), summary.schema)  # one row per product
        if update_progress:
            _advance(spark, root, summary, run_at)
        return summary
    finally:
        for df in held:
            df.unpersist()


def _advance(spark: SparkSession, root: str, summary: DataFrame, run_at) -> None:
    """SNK05 + SNK03: watermarks and manifests after a run."""
    at = F.lit(run_at).cast("timestamp_ntz")
    run = summary.select(
        "product", F.col("last_posted_at"), at.alias("run_at"),
        F.when(F.coalesce(F.col("failed"), F.lit(0)) > 0, F.lit("error")).otherwise(F.lit("ok")).alias("status"), "error")
    prev = read_state(spark, root, "watermarks")
    if prev is None:
        prev = spark.createDataFrame([], "product string, last_posted_at timestamp_ntz, last_run_at timestamp_ntz, "
                                         "status string, error string")
    write_state(spark, PG.merge_watermarks(prev, run), root, "watermarks")
    now = summary.select("product", at.alias("run_at"), "docs", "rows", "last_posted_at", "latest_interval_start", "partitions")
    before = read_state(spark, root, "manifests")
    if before is None:
        before = spark.createDataFrame([], "product string, last_posted_at timestamp_ntz, latest_interval_start timestamp_ntz, "
                                           "partitions bigint")
    manifests = PG.carry_manifest(before, now)
    if "run_at" in before.columns:  # products this run did not meet keep their manifest
        manifests = manifests.unionByName(before.join(now.select("product"), on="product", how="left_anti"))
    write_state(spark, manifests, root, "manifests")


def publish_catalog(spark: SparkSession, root: str, config: DataFrame, *, generated_at) -> bool:
    """SNK04: the catalog of ``config(product, table)`` and of products that only have a manifest, as
    a new version of ``state/catalog``. A catalog with the same content is not written again;
    returns whether one was."""
    empty = "product string, table string, live boolean, status string, generated_at timestamp_ntz"
    previous = read_state(spark, root, "catalog")
    before = spark.createDataFrame([], empty) if previous is None else previous
    manifests = read_state(spark, root, "manifests")
    if manifests is None:
        manifests = spark.createDataFrame([], "product string")
    # a product that was never configured stays an orphan, however often it was listed
    now = PG.build_catalog(config, manifests, before.filter(F.col("live").isNotNull()))
    if previous is not None and not PG.catalog_changed(now, before).first()["changed"]:
        return False
    write_state(spark, now.withColumn("generated_at", F.lit(generated_at).cast("timestamp_ntz")), root, "catalog")
    return True


def read_state(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    return LK.read_version(spark, f"{root}/state/{name}")


def write_state(spark: SparkSession, df: DataFrame, root: str, name: str) -> None:
    """Small state tables (one row per product) get a new version beside the one being read."""
    LK.write_version(spark, df, f"{root}/state/{name}")


def record_slots(spark: SparkSession, root: str, rows: DataFrame) -> None:
    """Merge the calendar bitmaps of ``rows`` into ``state/slots``; recording rows again changes nothing. A lake
    that has this state keeps it up to date on every ingest."""
    now, before = SL.bitmaps(rows), read_state(spark, root, "slots")
    write_state(spark, now if before is None else SL.merged(before, now), root, "slots")


def start_slots(spark: SparkSession, root: str) -> None:
    """Record the slots of all live rows of a lake: the one read of its data that coverage ever needs."""
    rows = read_curated(spark, root)
    live = SN.live(spark, root)
    record_slots(spark, root, rows if live is None else rows.join(live, SN.DIRECTORY, "left_semi"))


def slot_coverage(spark: SparkSession, root: str, expected: DataFrame) -> DataFrame:
    """Coverage of the expected slots from ``state/slots`` alone."""
    found = read_state(spark, root, "slots")
    if found is None:
        raise ValueError(f"{root} has no calendar bitmaps: call start_slots first")
    return SL.coverage(expected, found)


def rebuild(spark: SparkSession, root: str, decls: dict[str, Declaration], target: str, *, ingested_at) -> DataFrame:
    """JOB16: regenerate a curated lake from the raw postings kept under ``root``."""
    raw = LK.read_raw(spark, root).select("product", "posted_at", "doc_id", "name", "content")
    return ingest(spark, raw, decls, target, ingested_at=ingested_at, update_progress=False, land=False)


def lake_digests(spark: SparkSession, root: str) -> DataFrame:
    """The digest of every live batch of a lake: ``(product, date, batch, n, s1, s2)``. The time of ingestion is left out,
    so a rebuilt lake has the digests of the lake it was rebuilt from."""
    rows = read_curated(spark, root)
    live = SN.live(spark, root)
    if live is not None:
        rows = rows.join(live, SN.DIRECTORY, "left_semi")
    return DG.digests(rows.drop("ingested_at"), SN.DIRECTORY)


def lake_difference(spark: SparkSession, root: str, other: str) -> DataFrame:
    """The batches in which two lakes differ, found from product to day to batch: ``(product, date, batch, n, o_n)``
    with the rows in each; none where the lakes are the same."""
    a, b = lake_digests(spark, root), lake_digests(spark, other)
    kept = []
    for df, name in ((a, "digests"), (b, "digests-other")):
        path = scratch_path(spark, name)
        df.write.parquet(path)  # rows are read once; the descent works on digests
        kept.append(spark.read.schema(df.schema).parquet(path))
    return DG.differing(*kept, [["product"], ["product", "date"], SN.DIRECTORY])
