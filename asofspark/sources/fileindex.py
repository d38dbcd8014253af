"""Zone maps of a lake's files: which files a read has to open (SRC09, SRC12, FLT01, FLT03, FLT04).

The index is a versioned table (``state/files``) of one row per Parquet file of a lake with a snapshot log:
least and greatest interval and posting time, null counts and schema versions from the file's footer, and
a Bloom filter of the names (points, series) in it. Executors read the footers and the one name
column of files that the index does not hold yet; no row data goes through the driver.

A read takes the live directories of its days from the log and leaves out files whose
intervals lie outside the range, whose postings all came after the knowledge cut, or whose Bloom
filter holds none of the names. A file without statistics, and a live directory that is not in the index yet,
is always opened: the index saves work and never decides an answer.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asofspark.plans.declare import NAME_COLUMN
from asofspark.sources import lake as LK
from asofspark.sources import snapshots as SN

TABLE = "state/files"
BITS = 16  # Bloom filter bits for every distinct name
PROBES = 4
COUNTED = ("interval_start", "interval_minutes", "posted_at", "ingested_at", "source", "schema_version")

SCHEMA = ("product string, date date, batch string, path string, n_rows bigint, lo_interval timestamp_ntz, hi_interval timestamp_ntz, "
          "lo_posted timestamp_ntz, hi_posted timestamp_ntz, lo_version int, hi_version int, nulls map<string, bigint>, names binary")
FIELDS = ["product", "date", "batch", "path", "n_rows", "lo_interval", "hi_interval", "lo_posted", "hi_posted", "lo_version",
          "hi_version", "nulls", "names"]


# ---- Bloom filter ------------------------------------------------------------------------------

def _probes(name: str, bits: int) -> list[int]:
    h = hashlib.blake2b(name.encode(), digest_size=16).digest()
    a, b = int.from_bytes(h[:8], "little"), int.from_bytes(h[8:], "little") | 1
    return [(a + k * b) % bits for k in range(PROBES)]


def bloom(names: set[str]) -> bytes:
    """A filter of all ``names``; it grows with them, so its error rate does not."""
    bits = max(64, -(-BITS * len(names) // 8) * 8)
    out = bytearray(bits // 8)
    for name in names:
        for p in _probes(name, bits):
            out[p >> 3] |= 1 << (p & 7)
    return bytes(out)


def may_hold(data: bytes, names: Sequence[str]) -> bool:
    """Whether a filter may hold one of ``names``; never False for a name that it holds."""
    return any(all(data[p >> 3] >> (p & 7) & 1 for p in _probes(name, len(data) * 8)) for name in names)


# ---- one file ------------------------------------------------------------------------------------

def _zone(meta, column: str):
    """(least, greatest, nulls) of a column from a footer; None where any row group lacks them."""
    lo = hi = None
    nulls, known, counted = 0, True, True
    for g in range(meta.num_row_groups):
        group = meta.row_group(g)
        at = [c for c in range(group.num_columns) if group.column(c).path_in_schema == column]
        stats = group.column(at[0]).statistics if at else None
        if stats is None:
            return None, None, None
        counted = counted and stats.has_null_count
        nulls += stats.null_count or 0
        if stats.has_min_max:
            lo = stats.min if lo is None else min(lo, stats.min)
            hi = stats.max if hi is None else max(hi, stats.max)
        elif not (stats.has_null_count and stats.null_count == group.num_rows):
            known = False
    return (lo if known else None), (hi if known else None), (nulls if counted else None)


def file_entry(path: str) -> dict:
    """Zone map of one file, from its footer and its name column."""
    import pyarrow.parquet as pq

    store, where = LK.store_of(path)
    with store.open_input_file(where) as f:
        file = pq.ParquetFile(f)
        columns = set(file.schema_arrow.names)
        out = {"path": path, "n_rows": file.metadata.num_rows, "nulls": {}, "names": None}
        for name, field in (("interval", "interval_start"), ("posted", "posted_at"), ("version", "schema_version")):
            lo, hi, _ = _zone(file.metadata, field) if field in columns else (None, None, None)
            out[f"lo_{name}"], out[f"hi_{name}"] = lo, hi
        for field in COUNTED:
            nulls = _zone(file.metadata, field)[2] if field in columns else None
            if nulls is not None:
                out["nulls"][field] = nulls
        named = [c for c in NAME_COLUMN.values() if c in columns]
        if len(named) == 1:
            found: set[str] = set()
            for batch in file.iter_batches(columns=named):
                found.update(v for v in batch.column(0).unique().to_pylist() if v is not None)
            out["names"] = bloom(found)
    return out


# ---- the index -----------------------------------------------------------------------------------

def read(spark: SparkSession, root: str) -> DataFrame | None:
    return LK.read_version(spark, f"{root}/{TABLE}")


def indexed(spark: SparkSession, root: str) -> bool:
    """Whether the lake has a log and an index."""
    return LK.newest_version(spark, f"{root}/{TABLE}") is not None and SN.newest(spark, root) is not None


def update(spark: SparkSession, root: str) -> int:
    """Bring the index in line with the newest version of the log: new files enter, files that are no
    longer live leave. How many files were looked at."""
    now = SN.live(spark, root)
    if now is None:
        raise ValueError(f"{root} has no snapshot log")
    there = LK.list_files(spark, f"{root}/curated").select("path", *LK.path_parts("path"))
    there = there.join(now, SN.DIRECTORY, "left_semi").select(*SN.DIRECTORY, "path")
    known = read(spark, root)
    if known is None:
        known = spark.createDataFrame([], SCHEMA)
    new = there.join(known.select("path"), "path", "left_anti")

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [file_entry(path) | {"product": p, "date": d, "batch": b}
                    for p, d, b, path in zip(pdf["product"], pdf["date"], pdf["batch"], pdf["path"], strict=True)]
            if rows:
                out = pd.DataFrame(rows, columns=FIELDS)
                yield out.astype({"lo_version": "Int32", "hi_version": "Int32"})

    # file by file over all tasks: a listing has few partitions
    dealt = new.repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "path")
    entries = dealt.select(*SN.DIRECTORY, "path").mapInPandas(look, SCHEMA)
    kept = known.join(there.select("path"), "path", "left_semi").select(*FIELDS)
    before = known.select("path")
    LK.write_version(spark, kept.unionByName(entries), f"{root}/{TABLE}")
    return read(spark, root).join(before, "path", "left_anti").count()


def _overlaps(lo: Column, hi: Column, at_least, below) -> Column:
    """Whether a zone may hold a value in [at_least, below); an unknown zone may."""
    wanted = F.lit(True)
    if at_least is not None:
        wanted = wanted & (hi >= F.lit(at_least).cast("timestamp_ntz"))
    if below is not None:
        wanted = wanted & (lo < F.lit(below).cast("timestamp_ntz"))
    return F.coalesce(wanted, F.lit(True))


def chosen(spark: SparkSession, root: str, product: str, d_from: dt.date, d_to: dt.date, *, start=None, end=None,
           as_of=None, names: Sequence[str] | None = None, version: int | None = None) -> DataFrame:
    """``(path, indexed, wanted)``: the files of the live directories of a product's days, and the directories
    that the index does not hold; ``wanted`` where a read of intervals ``[start, end)`` as known at
    ``as_of``, limited to ``names``, has to open them."""
    days = (F.col("product") == product) & F.col("date").between(F.lit(d_from), F.lit(d_to))
    dirs = SN.live(spark, root, version).filter(days)
    index = read(spark, root)
    if index is None:
        index = spark.createDataFrame([], SCHEMA)
    known = dirs.join(index.filter(days), SN.DIRECTORY, "left")
    wanted = _overlaps(F.col("lo_interval"), F.col("hi_interval"), start, end)
    if as_of is not None:
        wanted = wanted & F.coalesce(F.col("lo_posted") <= F.lit(as_of).cast("timestamp_ntz"), F.lit(True))
    whole = F.concat(F.lit(f"{root}/curated/product={product}/date="), F.col("date").cast("string"), F.lit("/batch="), "batch")
    rows = known.select(F.coalesce("path", whole).alias("path"), F.col("path").isNotNull().alias("indexed"), wanted.alias("wanted"), "names")
    if not names:
        return rows.drop("names")
    asked = list(names)

    def hold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            held = [x is None or may_hold(bytes(x), asked) for x in pdf["names"]]
            yield pdf.assign(wanted=pdf["wanted"] & pd.Series(held, index=pdf.index, dtype=bool)).drop(columns="names")

    return rows.mapInPandas(hold, "path string, indexed boolean, wanted boolean")


def scan(spark: SparkSession, root: str, product: str, d_from: dt.date, d_to: dt.date, **wanted) -> DataFrame | None:
    """The rows of the files that :func:`chosen` wants; None where there are none."""
    paths = sorted(r.path for r in chosen(spark, root, product, d_from, d_to, **wanted).filter("wanted").collect())
    if not paths:
        return None
    return spark.read.option("basePath", f"{root}/curated").parquet(*paths)
