"""Snapshot log of a curated lake: which batch directories are live (SNK02, JOB08, JOB03).

Without a log every directory under ``curated`` is live, and a reader that meets a compaction between
its write and its deletes sees rows twice. :func:`start` gives a lake a log; from then on ingestion
and compaction commit to it and readers resolve one version of it:

* ``log/<version>.json`` names a small table of directories that this version adds and removes. It is
  put there only if absent, so of two writers one wins a version; the other looks at what has
  changed and tries the next one. A commit that takes away directories fails with
  :class:`Conflict` when another commit has taken one of them away before.
* Every ``CHECKPOINT`` versions the whole list of live directories is written beside
  (``<version>.full.json``), so a reader opens a bounded number of tables.
* Directories that no kept version names are deleted by :func:`vacuum`, once they are old enough for
  no writer to be about to commit them. A reader of a kept version never loses a file.

The lists are tables that executors write and read; the driver holds a version's name and, for a
read, the directories of the days that it asks for. "Only if absent" is a hard link on a local
file system and elsewhere a rename that does not overwrite, which HDFS and its like do atomically.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import uuid
from urllib.parse import urlparse

from pyspark.errors.exceptions.captured import CapturedException
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asofspark.sources import lake as LK

DIRECTORY = ["product", "date", "batch"]
CHECKPOINT = 10


class Conflict(RuntimeError):
    """Another commit has taken away a directory that this one builds on."""


def put_if_absent(spark: SparkSession, path: str, data: bytes, *, link: bool | None = None) -> bool:
    """Write a small file whole unless it is there; whether this call wrote it. ``link`` chooses
    the hard link (default: on local file systems) or the rename."""
    fs, p = LK._fs(spark, path)
    fs.mkdirs(p.getParent())
    temp = f"{path}.{uuid.uuid4().hex}.tmp"
    if link if link is not None else fs.getScheme() == "file":
        here, there = urlparse(temp).path, urlparse(path).path
        with open(here, "wb") as f:
            f.write(data)
        try:
            os.link(here, there)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(here)
    _, t = LK._fs(spark, temp)
    out = fs.create(t, False)
    out.write(bytearray(data))
    out.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(t, p, none)
        return True
    except (Py4JJavaError, CapturedException) as e:
        if "FileAlreadyExistsException" not in str(e) and not fs.exists(p):
            raise
        fs.delete(t, False)
        return False


def _names(spark: SparkSession, root: str) -> tuple[list[int], list[int]]:
    """(versions, versions with a full list), ascending."""
    fs, p = LK._fs(spark, f"{root}/log")
    if not fs.exists(p):
        return [], []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    plain = sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.endswith(".full.json"))
    return plain, sorted(int(n[:-10]) for n in names if n.endswith(".full.json"))


def _entry(spark: SparkSession, root: str, version: int, full: bool = False) -> DataFrame:
    fs, p = LK._fs(spark, f"{root}/log/{version:020d}{'.full' if full else ''}.json")
    stream = fs.open(p)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return spark.read.schema("product string, date date, batch string, live boolean").parquet(
        f"{root}/log/{json.loads(text)['table']}")


def _table(spark: SparkSession, root: str, rows: DataFrame) -> bytes:
    name = f"tables/{uuid.uuid4().hex}"
    rows.write.option("compression", "zstd").parquet(f"{root}/log/{name}")
    return json.dumps({"table": name}).encode()


def newest(spark: SparkSession, root: str) -> int | None:
    """The newest version, or None where the lake has no log."""
    plain, _ = _names(spark, root)
    return plain[-1] if plain else None


def live(spark: SparkSession, root: str, version: int | None = None) -> DataFrame | None:
    """``(product, date, batch)`` of the directories that are live in a version (default: the newest);
    None where the lake has no log."""
    plain, full = _names(spark, root)
    if not plain:
        return None
    version = plain[-1] if version is None else version
    if version not in plain:
        raise ValueError(f"no version {version} in the log of {root}")
    base = max((v for v in full if v <= version), default=None)
    parts = [] if base is None else [_entry(spark, root, base, full=True).withColumn("v", F.lit(base))]
    parts += [_entry(spark, root, v).withColumn("v", F.lit(v)) for v in plain if v <= version and (base is None or v > base)]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    last = rows.groupBy(*DIRECTORY).agg(F.max_by("live", "v").alias("live"))
    return last.filter("live").select(*DIRECTORY)


def commit(spark: SparkSession, root: str, added: DataFrame, removed: DataFrame | None = None, *, tries: int = 50) -> int:
    """A new version in which ``added`` directories are live and ``removed`` ones are not; its number.
    A directory in both is live."""
    rows = added.select(*DIRECTORY).distinct().withColumn("live", F.lit(True))
    if removed is not None:
        gone = removed.select(*DIRECTORY).distinct().join(added.select(*DIRECTORY), DIRECTORY, "left_anti")
        rows = rows.unionByName(gone.withColumn("live", F.lit(False)))
    data = _table(spark, root, rows)
    written = spark.read.parquet(f"{root}/log/{json.loads(data)['table']}")
    for _ in range(tries):
        base = newest(spark, root)
        if base is not None and removed is not None:
            lost = written.filter("not live").join(live(spark, root, base), DIRECTORY, "left_anti").first()
            if lost is not None:
                raise Conflict(f"{lost['product']}/{lost['date']}/{lost['batch']} is not live in version {base}")
        version = 0 if base is None else base + 1
        if put_if_absent(spark, f"{root}/log/{version:020d}.json", data):
            if version % CHECKPOINT == CHECKPOINT - 1:  # the same list whoever writes it
                whole = live(spark, root, version).withColumn("live", F.lit(True))
                put_if_absent(spark, f"{root}/log/{version:020d}.full.json", _table(spark, root, whole))
            return version
    raise Conflict(f"lost {tries} versions of {root} to other writers")


def directories(spark: SparkSession, root: str) -> DataFrame:
    """``(product, date, batch, modified)`` of all batch directories that are there."""
    files = LK.list_files(spark, f"{root}/curated").select("modified", *LK.path_parts("path")).filter(F.col("kind") != "")
    return files.groupBy(*DIRECTORY).agg(F.max("modified").alias("modified"))


def start(spark: SparkSession, root: str) -> int:
    """Give a lake a log whose first version holds the directories that are there. A lake that has
    one keeps it."""
    known = newest(spark, root)
    if known is not None:
        return known
    fs, p = LK._fs(spark, f"{root}/curated")
    there = directories(spark, root) if fs.exists(p) else spark.createDataFrame([], "product string, date date, batch string")
    put_if_absent(spark, f"{root}/log/{0:020d}.json", _table(spark, root, there.select(*DIRECTORY).withColumn("live", F.lit(True))))
    return newest(spark, root)


def live_paths(spark: SparkSession, root: str, product: str, d_from: dt.date, d_to: dt.date,
               version: int | None = None) -> list[str]:
    """The live directories of a product's delivery days: what a read of these days opens."""
    rows = live(spark, root, version).filter((F.col("product") == product) & F.col("date").between(F.lit(d_from), F.lit(d_to)))
    return sorted(f"{root}/curated/product={r.product}/date={r.date}/batch={r.batch}" for r in rows.collect())


def vacuum(spark: SparkSession, root: str, *, now, min_age_minutes: int = 60, keep: int = 1) -> int:
    """Delete the directories that none of the last ``keep`` versions names and that are at least
    ``min_age_minutes`` old; how many went. Older versions can no longer be read afterwards,
    and their log entries go where a full list makes them dispensable."""
    from asofspark.functions import time as T

    plain, full = _names(spark, root)
    kept = plain[-keep:]
    named = live(spark, root, kept[0])
    for v in kept[1:]:
        named = named.unionByName(live(spark, root, v))
    now_us = T.micros_between(F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.lit(now).cast("timestamp_ntz"))
    old = directories(spark, root).filter(now_us - F.unix_micros("modified") >= min_age_minutes * 60_000_000)
    base = f"{root}/curated"
    gone = old.join(named, DIRECTORY, "left_anti").select(F.concat(
        F.lit(f"{base}/product="), "product", F.lit("/date="), F.col("date").cast("string"), F.lit("/batch="), "batch").alias("dir"))
    deleted = LK.delete_dirs(gone, base)
    last_full = max((v for v in full if v <= kept[0]), default=None)
    for v in plain:
        if last_full is not None and v < last_full:
            fs, p = LK._fs(spark, f"{root}/log/{v:020d}.json")
            fs.delete(p, False)
    return deleted
