"""Structured Streaming forms of the batch jobs (STR01-STR07).

* :func:`stream_ingest` discovers posting zips with a ``binaryFile`` stream and runs the batch
  :func:`asofspark.plans.ingest.ingest` in ``foreachBatch``: one code path for live runs and
  backfills (STR01). The checkpoint records which files were seen; the names of postings that
  were not taken (failed, deferred, held behind one) go to a ``pending`` table, written after
  the curated rows as a version of the micro-batch's own, and are offered again with the
  next one, so progress never skips a posting (STR02, STR03). A posting seen
  twice (a redelivered correction of a failed copy, or the file behind a ``.listed`` marker)
  is taken once: a copy with content beats a marker, then the newest copy. A replayed
  micro-batch rewrites the same batch directories (dynamic overwrite), so replays are
  idempotent (STR04); a repost is a newer posting and is never dropped as late (STR05): the
  curated path has no event-time watermark.
* :func:`stream_latest` keeps the current value per business key as postings arrive
  (STR06): a keyed ``max_by`` aggregate in the state store.
* :func:`stream_posting_hours` counts postings per product and hour with a watermark, so
  closed hours are emitted once and their state dropped (STR07).

Sinks are ``foreachBatch`` writers into tables in the shared folder; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asofspark.functions import time as T
from asofspark.plans import ingest as IN
from asofspark.sources import lake as LK

BINARY_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
# the default landing layout: product folder, local posting stamp, document id; a ``.listed``
# marker is a posting the listing names but whose file is not available yet
LANDING_PATH = r"/([a-z0-9]+)/date=[^/]+/posted=(\d{8}T\d{6})-(\d+)\.(zip|listed)$"
LANDING_GLOB = "*.{zip,listed}"


def raw_from_paths(df: DataFrame, pattern: str = LANDING_PATH, product: Callable[[Column], Column] | None = None) -> DataFrame:
    """Landing file rows -> raw postings. ``pattern`` captures product folder, local stamp,
    document id and kind from a path; ``product`` names the product of a folder. A ``.listed``
    marker is a listed posting that is not yet available: its content is NULL (deferred). A path
    that the pattern does not match keeps its folderless name as product, so it is reported."""
    hit = F.regexp_like("path", F.lit(pattern))
    folder = F.when(hit, F.regexp_extract("path", pattern, 1)).otherwise(F.regexp_extract("path", r"([^/]+)$", 1))
    local = F.try_to_timestamp(F.when(hit, F.regexp_extract("path", pattern, 2)), F.lit("yyyyMMdd'T'HHmmss")).cast("timestamp_ntz")
    content = [F.when(~hit | (F.regexp_extract("path", pattern, 4) == "zip"), F.col("content")).alias("content")] \
        if "content" in df.columns else []
    return df.select((product(folder) if product else folder).alias("product"),
                     T.local_to_utc(local).alias("posted_at"),
                     F.when(hit, F.regexp_extract("path", pattern, 3)).cast("bigint").alias("doc_id"),
                     F.col("path").alias("name"), *content, F.col("modificationTime").alias("received_at"))


def stream_ingest(spark: SparkSession, landing: str, decls, root: str, checkpoint: str, *, ingested_at,
                  available_now: bool = True, pattern: str = LANDING_PATH,
                  product: Callable[[Column], Column] | None = None):
    """STR01-STR05: returns the started StreamingQuery."""
    pending = f"{root}/state/pending"

    def run(batch: DataFrame, batch_id: int) -> None:
        raw = raw_from_paths(batch, pattern, product)
        # versions continue over streams: a fresh checkpoint counts its batches from 0 again
        version = next_version(spark, pending, checkpoint, batch_id)
        prev = LK.read_version(spark, pending, before=version)
        if prev is not None:  # names only; the bytes are read again where a file was there
            listed = F.col("name").endswith(".listed")
            there = LK.read_bytes(prev.filter(~listed), "name")
            waiting = prev.filter(listed).withColumn("content", F.lit(None).cast("binary"))
            raw = raw.unionByName(there).unionByName(waiting)
        # a posting offered twice (pending and redelivered, or marker and file): one copy
        IN.ingest(spark, IN.newest_copy(raw), decls, root, ingested_at=ingested_at, pending=(pending, version))

    src = (spark.readStream.format("binaryFile").schema(BINARY_SCHEMA).option("pathGlobFilter", LANDING_GLOB)
           .option("recursiveFileLookup", "true").load(landing))
    w = src.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def next_version(spark: SparkSession, path: str, checkpoint: str, batch_id: int) -> int:
    """The version that a micro-batch writes: the same one when it is replayed. The first batch of
    a checkpoint notes the version that it starts from."""
    start = f"{checkpoint}/first-pending-version"
    known = LK.read_version(spark, start)
    if known is None:
        last = LK.newest_version(spark, path)
        first = int(last.rsplit("=", 1)[1]) + 1 if last else 0
        LK.write_version(spark, spark.createDataFrame([(first - batch_id,)], "first bigint"), start)
        known = LK.read_version(spark, start)
    return known.first()["first"] + batch_id


def _versions_of(path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        LK.write_version(batch.sparkSession, batch, path, batch_id)
    return write


def _parts_of(path: str):
    """Every micro-batch owns one directory: a replay replaces it."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write


def stream_latest(sdf: DataFrame, *, key, posted: str, tie: str | None = None, values=()) -> DataFrame:
    """STR06: the latest row per business key as a streaming aggregate (update/complete mode)."""
    order = F.struct(F.col(posted), *([F.col(tie)] if tie else []))
    row = F.struct(F.col(posted).alias(posted), *[F.col(v).alias(v) for v in values])
    agg = sdf.groupBy(*key).agg(F.max_by(row, order).alias("__latest"))
    return agg.select(*key, *[F.col("__latest").getField(c).alias(c) for c in (posted, *values)])


def stream_posting_hours(sdf: DataFrame, *, at: str, by: str, lateness: str = "1 hour") -> DataFrame:
    """STR07: postings per ``by`` and hour; an hour is final once the watermark passes it.
    ``at`` is a UTC wall clock (NTZ); event time runs on the equivalent instant."""
    return (sdf.withColumn("__t", T.ntz_to_instant(at)).withWatermark("__t", lateness)
            .groupBy(F.window("__t", "1 hour").alias("w"), by)
            .agg(F.count(F.lit(1)).alias("n"))
            .select(T.instant_to_ntz(F.col("w.start")).alias("hour_start"),
                    T.instant_to_ntz(F.col("w.end")).alias("hour_end"), by, "n"))


def run_to_table(sdf: DataFrame, path: str, checkpoint: str, mode: str) -> None:
    """Run a streaming DataFrame with ``availableNow`` into Parquet and wait for it. Complete
    results become versions of the table (read with :func:`read_table`), appended ones a
    directory per micro-batch; a replayed micro-batch writes what it wrote before."""
    writer = _versions_of(path) if mode == "complete" else _parts_of(path)
    q = (sdf.writeStream.outputMode(mode).foreachBatch(writer).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def read_table(spark: SparkSession, path: str, mode: str) -> DataFrame:
    """What :func:`run_to_table` has written so far."""
    if mode == "complete":
        return LK.read_version(spark, path)
    return spark.read.option("basePath", path).parquet(f"{path}/batch_id=*").drop("batch_id")
