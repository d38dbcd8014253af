"""Current values as they change (STR06): state per key, and a table written in proportion to the changes.

:func:`changes` keeps the newest row per key in the state store, one row per key, and emits a
key only when a micro-batch brought a newer row for it; a late row that is older than what is known changes
nothing. It is an aggregate: a micro-batch's rows are brought down to one per key before they are shuffled, and a key's
state is read and written once, without a Python worker. The newest row keeps the time of the micro-batch that
brought it (its log has it, so a replay finds the same), which tells a key that changed from one that only had
late rows. With ``idle`` a key's state expires when no newer row came for that long (processing time), which takes
``transformWithState``; the table keeps its value.

:func:`run_current` writes each micro-batch's changes as a directory of its own, which a replay replaces. Once the
changes since the last base outgrow it, base and changes are folded into a new base, so the total
that is written stays in proportion to the changed keys. :func:`read_current` is base and changes, newest row per key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as ST
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from asofspark.operators import pit
from asofspark.sources import lake as LK

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Newest(StatefulProcessor):
    """The newest row of a key, by ``order``; emitted when it changes."""

    def __init__(self, schema: ST.StructType, keys: Sequence[str], order: Sequence[str], idle_ms: int | None):
        self.schema, self.keys, self.order, self.idle = schema, list(keys), list(order), idle_ms
        self.rest = [f.name for f in schema if f.name not in self.keys]

    def init(self, handle: StatefulProcessorHandle) -> None:
        fields = ST.StructType([self.schema[c] for c in self.rest])
        self.handle = handle
        self.newest = handle.getValueState("newest", fields, ttlDurationMs=self.idle)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        rank = lambda r: tuple((r[c] is not None, r[c]) for c in self.order)
        best = max(rows, key=rank)
        known = self.newest.get()
        if known is not None:
            known = dict(zip(self.rest, known, strict=True))
            if rank(known) >= rank(best):
                return
        self.newest.update(tuple(best[c] for c in self.rest))
        yield Row(**{f.name: best[f.name] for f in self.schema})

    def close(self) -> None:
        pass


def changes(sdf: DataFrame, *, key: Sequence[str], posted: str, tie: str | None = None, idle_ms: int | None = None) -> DataFrame:
    """The rows of a stream that become the newest of their key (all columns; latest ``posted``, then ``tie``).
    With ``idle_ms`` the session's state store must be RocksDB (:data:`STORE`)."""
    order = [posted, *([tie] if tie else [])]
    if not idle_ms:
        # the micro-batch's own time; of equal rows the one that is known stays
        seen = sdf.withColumn("__seen", F.unix_micros(F.current_timestamp()))
        row, rank = F.struct(*sdf.columns, "__seen"), F.struct(*order, -F.col("__seen"))
        newest = seen.groupBy(*[F.col(k).alias(f"__key{n}") for n, k in enumerate(key)]).agg(F.max_by(row, rank).alias("__newest"))
        return newest.where(F.col("__newest.__seen") == F.unix_micros(F.current_timestamp())).select(
            *[F.col("__newest").getField(c).alias(c) for c in sdf.columns])
    processor = Newest(sdf.schema, key, order, idle_ms)
    return sdf.groupBy(*key).transformWithState(processor, sdf.schema, "Update", "ProcessingTime")


def _rows(df: DataFrame | None) -> int:
    return 0 if df is None else df.count()


def _deltas(spark: SparkSession, path: str, schema: ST.StructType, after: int) -> DataFrame | None:
    """Changes of the micro-batches after the one that the base holds."""
    fs, p = LK._fs(spark, f"{path}/changes")
    if not fs.exists(p):
        return None
    names = sorted(int(s.getPath().getName()[9:]) for s in fs.listStatus(p) if s.getPath().getName().startswith("batch_id="))
    new = [f"{path}/changes/batch_id={n}" for n in names if n > after]
    return spark.read.schema(schema).parquet(*new) if new else None


def _base(spark: SparkSession, path: str) -> tuple[int, str | None]:
    """(last micro-batch in the base, its directory)."""
    found = LK.newest_version(spark, f"{path}/base")
    return (int(found.rsplit("=", 1)[1]), found) if found else (-1, None)


def read_current(spark: SparkSession, path: str, schema: ST.StructType, *, key: Sequence[str], posted: str,
                 tie: str | None = None) -> DataFrame:
    """The newest row per key that :func:`run_current` has written."""
    last, base = _base(spark, path)
    parts = [df for df in (spark.read.schema(schema).parquet(base) if base else None, _deltas(spark, path, schema, last)) if df is not None]
    if not parts:
        return spark.createDataFrame([], schema)
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return pit.latest(both, key=key, posted=posted, tie=[tie] if tie else ())


def run_current(sdf: DataFrame, path: str, checkpoint: str, *, key: Sequence[str], posted: str, tie: str | None = None) -> None:
    """Bring the table at ``path`` up to date with a stream and wait for it (``availableNow``)."""
    schema = sdf.schema

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        last, base = _base(spark, path)
        if batch_id <= last:
            return  # replayed, and folded already
        batch.write.mode("overwrite").parquet(f"{path}/changes/batch_id={batch_id}")
        if _rows(_deltas(spark, path, schema, last)) > _rows(spark.read.schema(schema).parquet(base) if base else None):
            whole = read_current(spark, path, schema, key=key, posted=posted, tie=tie)
            LK.write_version(spark, whole, f"{path}/base", batch_id, keep=2)

    conf, before = sdf.sparkSession.conf, sdf.sparkSession.conf.get("spark.sql.streaming.stateStore.providerClass")
    conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    try:
        q = (changes(sdf, key=key, posted=posted, tie=tie).writeStream.outputMode("update").foreachBatch(write)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        conf.set("spark.sql.streaming.stateStore.providerClass", before)
