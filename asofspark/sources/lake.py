"""The lake layout on Spark: raw landing, curated partitions, day scans and file listings
(SNK01, SNK02, SRC09, SRC11, SRC12, FN22).

Layout: ``raw/product=<p>/date=<posting day>/posted=<stamp>/`` holding the posting bytes, and
``curated/product=<p>/date=<delivery day>/batch=<part|merged>-<stamp>/``. Spark cannot name its
files, so the stamp is a directory; with dynamic partition overwrite, re-writing a posting
replaces exactly its own directories (idempotent replays), and merged batches sit next to
the parts they replace until those are deleted.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from asofspark.functions import time as T

# a part may name its document after the stamp: two postings of one second are two batches
BATCH_PATTERN = r"^(part|merged)-(\d{8}T\d{6}Z)(?:-[^/]+)?$"
PATH_PATTERN = r"/product=([^/]+)/date=(\d{4}-\d{2}-\d{2})/batch=((part|merged)-(\d{8}T\d{6}Z)(?:-[^/]+)?)/"


def _writer(df: DataFrame, *cols: str):
    return (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd").partitionBy(*cols))


def land_raw(docs: DataFrame, root: str) -> None:
    """SNK01: postings ``(product, posted_at, name, content)`` before any parsing, partitioned by
    local posting day and posting stamp; a re-landed posting replaces only itself."""
    extra = [c for c in ("doc_id",) if c in docs.columns]
    posted = T.stamp("posted_at")
    if extra:  # two postings of one second land side by side
        posted = F.concat_ws("-", posted, F.col("doc_id").cast("string"))
    out = docs.select("product", T.delivery_date("posted_at").alias("date"),
                      posted.alias("posted"), "posted_at", *extra, "name", "content")
    _writer(out.repartition("product", "date", "posted"), "product", "date", "posted").parquet(f"{root}/raw")


def read_raw(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/raw")


def with_batch(df: DataFrame, kind: str = "part", posted: str = "posted_at", doc: str | None = None) -> DataFrame:
    """PRJ09 + the batch key: delivery date of ``interval_start`` and ``<kind>-<stamp>[-<doc>]``;
    with ``doc`` postings of the same second never share a batch."""
    name = F.concat(F.lit(f"{kind}-"), T.stamp(posted))
    if doc:
        name = F.concat_ws("-", name, F.regexp_replace(F.col(doc).cast("string"), r"[^A-Za-z0-9_.]", "_"))
    return df.withColumn("date", T.delivery_date("interval_start")).withColumn("batch", name)


def write_curated(df: DataFrame, root: str) -> None:
    """SNK02: one output directory per (product, delivery date, batch); the shuffle groups each
    directory's rows into one task so a posting day writes one file, and rows are sorted by
    interval so Parquet min/max statistics skip row groups on range reads."""
    out = df.repartition("product", "date", "batch").sortWithinPartitions("product", "date", "batch", "interval_start")
    _writer(out, "product", "date", "batch").parquet(f"{root}/curated")


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """The subset of ``paths`` that exist (driver-side metadata calls, one per path)."""
    out = []
    for path in paths:
        fs, p = _fs(spark, path)
        if fs.exists(p):
            out.append(path)
    return out


def days_there(spark: SparkSession, product_dir: str, d_from: dt.date, d_to: dt.date) -> list[str]:
    """The day directories of a product between two days: one listing, however many days are asked for."""
    fs, p = _fs(spark, product_dir)
    if not fs.exists(p):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(p))
    return [f"{product_dir}/{n}" for n in names if f"date={d_from}" <= n <= f"date={d_to}"]


def newest_version(spark: SparkSession, path: str, before: int | None = None) -> str | None:
    """The newest complete ``v=<n>`` directory under ``path`` (below ``before``), or None."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    found = []
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if name.startswith("v=") and (before is None or int(name[2:]) < before) and existing(spark, [f"{path}/{name}/_SUCCESS"]):
            found.append(int(name[2:]))
    return f"{path}/v={max(found):020d}" if found else None


def write_version(spark: SparkSession, df: DataFrame, path: str, version: int | None = None, keep: int = 3) -> None:
    """A new version of a table beside the older ones: a reader sees the old or the new one whole,
    and a crash while writing leaves the old one. Versions older than the last ``keep`` go."""
    if version is None:
        last = newest_version(spark, path)
        version = int(last.rsplit("=", 1)[1]) + 1 if last else 0
    df.write.mode("overwrite").parquet(f"{path}/v={version:020d}")
    fs, p = _fs(spark, path)
    names = sorted(s.getPath().getName() for s in fs.listStatus(p) if s.getPath().getName().startswith("v="))
    for name in [n for n in names if int(n[2:]) <= version][:-keep]:
        old, q = _fs(spark, f"{path}/{name}")
        old.delete(q, True)


def read_version(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """The newest complete version of a table, or None."""
    found = newest_version(spark, path, before)
    return spark.read.parquet(found) if found else None


def read_bytes(df: DataFrame, path: str, out: str = "content") -> DataFrame:
    """``df`` with the bytes of the file that each row's ``path`` names, read inside tasks."""

    def load(batches):
        for pdf in batches:
            data = []
            for name in pdf[path]:
                store, where = store_of(name)
                with store.open_input_stream(where) as f:
                    data.append(f.read())
            yield pdf.assign(**{out: data})

    return df.mapInPandas(load, ST.StructType([*df.schema, ST.StructField(out, ST.BinaryType())]))


def scan_days(spark: SparkSession, root: str, product: str, d_from: dt.date, d_to: dt.date,
              version: int | None = None) -> DataFrame:
    """SRC09: only the requested delivery days are listed and opened (explicit partition paths
    with ``basePath``), never the whole product; absent days are skipped. On a lake with a
    snapshot log these are the directories that are live in one version."""
    from asofspark.sources import snapshots as SN

    base = f"{root}/curated"
    if SN.newest(spark, root) is not None:
        paths = SN.live_paths(spark, root, product, d_from, d_to, version)
    else:
        paths = days_there(spark, f"{base}/product={product}", d_from, d_to)
    if not paths:
        return None
    return spark.read.option("basePath", base).parquet(*paths)


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """SRC12: every Parquet file under ``root`` with size and modification time, listed by a
    distributed ``binaryFile`` scan that never reads file contents."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
            .option("recursiveFileLookup", "true").load(root)
            .select("path", F.col("modificationTime").alias("modified"), "length"))


def path_parts(path) -> list:
    """FN22: product, delivery date, batch, batch kind and stamp from a curated file path."""
    p = F.col(path) if isinstance(path, str) else path
    return [F.regexp_extract(p, PATH_PATTERN, 1).alias("product"),
            F.to_date(F.regexp_extract(p, PATH_PATTERN, 2)).alias("date"),
            F.regexp_extract(p, PATH_PATTERN, 3).alias("batch"),
            F.regexp_extract(p, PATH_PATTERN, 4).alias("kind"),
            T.parse_stamp(F.regexp_extract(p, PATH_PATTERN, 5)).alias("stamp")]


def store_of(path: str):
    """The file system of ``path`` and its name there (``pyarrow.fs``), for work inside tasks."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "file:///" + path[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


def delete_dirs(dirs: DataFrame, under: str) -> int:
    """Delete the batch directories in ``dirs(dir)`` from executors; refuses, before it deletes
    any, a directory outside ``under`` (the curated root). A directory that is gone is no error."""
    inside = F.col("dir").startswith(under.rstrip("/") + "/")
    stray = dirs.filter(~inside | F.col("dir").contains("/../")).first()
    if stray:
        raise ValueError(f"refusing to delete {stray['dir']} outside {under}")

    def delete(batches):
        import pandas as pd
        from pyarrow import fs

        for pdf in batches:
            n = 0
            for path in pdf["dir"]:
                store, name = store_of(path)
                if store.get_file_info(name).type == fs.FileType.Directory:
                    store.delete_dir(name)
                    n += 1
            yield pd.DataFrame({"n": [n]})

    return dirs.distinct().mapInPandas(delete, "n long").agg(F.sum("n")).first()[0] or 0
