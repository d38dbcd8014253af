"""Posting archives: zipped CSV postings and bundles of postings (SRC01, SRC02, SRC05, FN16).

A posting is one immutable zip holding CSV members; a bundle is a zip of posting zips. Both are
read as binary rows (``binaryFile`` on files, or landed raw rows) and unpacked on executors by
``mapInArrow``: each task opens its own archives with the standard library, reads a member as a stream (once
through for damage, once for its lines) and yields lines in batches of 10,000, so beside the archive's own
bytes memory is bounded by a batch, not by a member. Header cells
are trimmed, all-blank lines dropped, cells kept verbatim, a UTF-8 BOM stripped; other member
types are ignored.
"""

from __future__ import annotations

import codecs
import csv
import io
import zipfile
import zlib
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from asofspark.functions import time as T

RECORD_SCHEMA = (
    "path string, doc string, doc_index int, member string, member_index int, line_no int, "
    "header array<string>, cells array<string>, problem string"
)
_COLUMNS = [f.split(" ")[0] for f in RECORD_SCHEMA.split(", ")]
# what a damaged archive, member or text raises
_BROKEN = (zipfile.BadZipFile, zlib.error, EOFError, UnicodeDecodeError, csv.Error, NotImplementedError, RuntimeError)

_FLUSH_ROWS = 10_000


def _check(z: zipfile.ZipFile, info: zipfile.ZipInfo) -> None:
    """Read a member once through, a piece at a time: a damaged one raises before any of its lines is passed on."""
    decoder, wrong = codecs.getincrementaldecoder("utf-8-sig")(), None
    with z.open(info) as stream:
        while piece := stream.read(1 << 20):
            if wrong is None:
                try:
                    decoder.decode(piece)
                except UnicodeDecodeError as e:
                    wrong = e
    if wrong is not None:
        raise wrong
    decoder.decode(b"", final=True)


def _csv_rows(stream):
    """The header as line 0 without cells, then every line that is not blank."""
    header = None
    for line_no, row in enumerate(csv.reader(io.TextIOWrapper(stream, encoding="utf-8-sig", newline="\n"))):
        if header is None:
            header = [h.strip() for h in row]
            yield line_no, header, None
        elif any(c.strip() for c in row):
            yield line_no, header, row


def _members(z: zipfile.ZipFile, doc: str | None, doc_index: int | None):
    """CSV members at any depth, as (document, member's name and number, its rows); ``doc`` is the outermost zip inside
    the archive."""
    index = 0
    for info in z.infolist():
        name = info.filename
        lower = name.lower()
        if lower.endswith(".zip"):
            with zipfile.ZipFile(io.BytesIO(z.read(info))) as inner:
                yield from _members(inner, name if doc is None else doc, index if doc is None else doc_index)
            index += 1
        elif lower.endswith(".csv"):
            _check(z, info)
            with z.open(info) as stream:
                yield doc, doc_index, name, index, _csv_rows(stream)
            index += 1


def _records(path: str, content: bytes):
    """The rows of one archive. What cannot be read ends in a row with a ``problem``; nothing is raised."""
    found = False
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            for doc, doc_index, member, member_index, rows in _members(z, None, None):
                found = True
                lines = False
                for line_no, header, cells in rows:
                    lines = True
                    yield path, doc, doc_index, member, member_index, line_no, header, cells, None
                if not lines:
                    yield path, doc, doc_index, member, member_index, None, None, None, "CSV member without a header"
    except _BROKEN as e:
        yield path, None, None, None, None, None, None, None, f"unreadable archive: {type(e).__name__}"
        return
    if not found:
        yield path, None, None, None, None, None, None, None, "archive without a CSV member"


def _unzip_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of ``(path, content, *carried)`` batches; carried values are taken as they are."""
    types = [pa.string(), pa.string(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.string()),
             pa.list_(pa.string()), pa.string()]

    def out(b: pa.RecordBatch, rows: list[tuple], at: list[int]) -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
        carried = [b.column(k).take(pa.array(at, pa.int32())) for k in range(2, b.num_columns)]
        return pa.record_batch([*columns, *carried], names=[*_COLUMNS, *b.schema.names[2:]])

    for b in batches:
        rows: list[tuple] = []
        at: list[int] = []
        for n, (path, content) in enumerate(zip(b.column(0), b.column(1), strict=True)):
            for row in _records(path.as_py(), content.as_py()):
                rows.append(row)
                at.append(n)
                if len(rows) >= _FLUSH_ROWS:
                    yield out(b, rows, at)
                    rows, at = [], []
        if rows:
            yield out(b, rows, at)


def unpack(raw: DataFrame, path: str = "path", content: str = "content", carry: Sequence[str] = ()) -> DataFrame:
    """SRC01 + SRC02 + SRC05: binary archives -> one row per CSV line. Per member also a row for its
    header (``cells`` NULL), so that members without data lines are seen; per archive that
    cannot be read, in whole or in part, a row with a ``problem``: one damaged archive never
    fails the run. ``doc`` is the posting zip's name inside a bundle (NULL for a plain posting).
    The columns ``carry`` of an archive's row come with each of its records: no join brings them back."""
    rows = raw.select(F.col(path).alias("path"), F.col(content).alias("content"), *carry)
    return rows.mapInArrow(_unzip_batches, ST.StructType([*ST.StructType.fromDDL(RECORD_SCHEMA), *rows.schema.fields[2:]]))


def csv_records(raw: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """The data lines of :func:`unpack`."""
    return unpack(raw, path, content).filter(F.col("cells").isNotNull()).drop("problem")


def read_archives(spark: SparkSession, root: str, glob: str = "*.zip") -> DataFrame:
    """Binary rows of every archive under ``root`` (recursive), content read lazily per task."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true").load(root))


def member_posting(records: DataFrame, listed_utc=None) -> DataFrame:
    """FN16 + FN17 + SRC05: the posting time of each member from its name's local stamp;
    a bundle's doc id is the numeric head of the posting zip's name, else its position.
    ``listed_utc`` (a column) picks the nearer occurrence in the repeated hour; without it the
    first occurrence is used. Members without a stamp get NULL (a bundle skips them)."""
    local = T.stamp_from_name(F.col("member"))
    posted = T.nearest_occurrence(local, listed_utc) if listed_utc is not None else T.local_to_utc(local)
    head = F.regexp_extract(F.regexp_extract(F.col("doc"), r"([^/]+)$", 1), r"^(\d+)\.", 1)
    doc_id = F.when(F.col("doc").isNull(), F.lit(None).cast("bigint")).when(
        head != "", head.cast("bigint")).otherwise(F.col("doc_index").cast("bigint"))
    return records.withColumn("posted_local", local).withColumn("posted_at", posted).withColumn("doc_id", doc_id)


def bundle_postings(records: DataFrame, post_from, post_to, tz: str = T.CT) -> DataFrame:
    """SRC05 + SRC07: the postings of bundles published in ``(post_from, post_to]``, oldest first, ties
    by document: path, doc, doc_id, posted_at and the number of their lines. Stamps in the
    repeated hour are told apart by the order of the documents in their bundle; members without a
    stamp are skipped. ``records`` comes from :func:`member_posting`."""
    from asofspark.operators.repeated import resolve_repeated_hour

    heads = (records.filter(F.col("posted_local").isNotNull()).groupBy("path", "doc", "doc_id", "posted_local")
             .agg(F.count(F.lit(1)).alias("n_lines")))
    dated = resolve_repeated_hour(heads, order="doc_id", local="posted_local", by=["path"], tz=tz, out="posted_at")
    lo, hi = F.lit(post_from).cast("timestamp_ntz"), F.lit(post_to).cast("timestamp_ntz")
    dated = dated.filter((F.col("posted_at") > lo) & (F.col("posted_at") <= hi))
    return dated.select("path", "doc", "doc_id", "posted_at", "n_lines").orderBy("posted_at", "doc_id")


# -- writing archives (landing fixtures and exports) ------------------------------------------


def zip_members(members: list[tuple[str, bytes]]) -> bytes:
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", compression=zipfile.ZIP_DEFLATED) as z:
        for name, data in members:
            z.writestr(name, data)
    return buf.getvalue()


def zip_csv(name: str, header: Sequence[str], rows: Iterable[Sequence]) -> bytes:
    """A zip with one CSV member, its lines compressed as they come."""
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", compression=zipfile.ZIP_DEFLATED) as z, z.open(name, "w", force_zip64=True) as f:
        f.write(codecs.BOM_UTF8)
        text = io.TextIOWrapper(f, encoding="utf-8", newline="")
        w = csv.writer(text, lineterminator="\r\n")
        w.writerow(header)
        w.writerows(rows)
        text.flush()
        text.detach()
    return buf.getvalue()


def csv_bytes(header: list[str], rows: list[list[str]], bom: bool = True) -> bytes:
    buf = io.StringIO()
    w = csv.writer(buf, lineterminator="\r\n")
    w.writerow(header)
    w.writerows(rows)
    return (("﻿" if bom else "") + buf.getvalue()).encode("utf-8")


def _export(batches: Iterator[pd.DataFrame], root: str) -> Iterator[pd.DataFrame]:
    from pyarrow import fs as pafs

    if "://" in root:
        filesystem, base = pafs.FileSystem.from_uri(root)
    else:
        filesystem, base = pafs.LocalFileSystem(), root
    filesystem.create_dir(base, recursive=True)
    made = {base}
    for pdf in batches:
        written = []
        for name, content in zip(pdf["name"], pdf["content"], strict=True):
            target = f"{base}/{name}"
            parent = target.rsplit("/", 1)[0]
            if parent not in made:
                filesystem.create_dir(parent, recursive=True)
                made.add(parent)
            with filesystem.open_output_stream(target) as f:
                f.write(bytes(content))
            written.append(target)
        yield pd.DataFrame({"name": list(pdf["name"]), "written": written})


def export_files(df: DataFrame, root: str) -> DataFrame:
    """Write each ``(name, content)`` row as a file under ``root`` from the executors (through
    ``pyarrow.fs``, so ``root`` may be any shared file system it can reach). Lazy: returns the
    written paths; run it with an action."""
    if root.startswith("file:"):
        root = "/" + root[len("file:"):].lstrip("/")
    return df.select("name", "content").mapInPandas(lambda it: _export(it, root), "name string, written string")
