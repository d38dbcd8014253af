"""Archives read by member (SRC01, SRC02, SRC05): a large archive is many tasks, and a member is a stream.

A zip's directory stands at its end. One task per archive reads that tail only and deals the members into
slices of some ``SLICE`` compressed bytes; the slices go to tasks of their own, which seek to their members and
read nothing else. A bundle of a month is so unpacked by as many tasks as it has slices, and a
CSV member is decompressed and parsed line by line, never held whole. Zips inside an archive (the
postings of a bundle) are read into memory one at a time.

Damage stays where it is: an archive without a readable directory is one problem row, and so is a member
that cannot be read, beside all other members' lines. Lines, headers and problems come in the columns
of :data:`asofspark.sources.archive.RECORD_SCHEMA`.

Files are opened with ``pyarrow.fs`` inside tasks. Where that does not know the file system
(a scheme that only Spark reads), :func:`read_members` falls back to whole archives as binary rows.
"""

from __future__ import annotations

import csv
import io
import struct
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asofspark.sources import archive as AR
from asofspark.sources import lake as LK

SLICE = 32 << 20
SLICE_SCHEMA = "path string, slice int, members array<int>, bytes bigint, problem string"
#: Schemes that tasks can open themselves.
OPENED = ("file", "hdfs", "s3", "gs", "gcs", "abfs", "abfss", "viewfs")
#: Damage. A read error of the file system is none: it fails the task, which is tried again.
_DAMAGE = (*AR._BROKEN, struct.error, ValueError)


def _is_data(name: str) -> bool:
    return name.lower().endswith((".zip", ".csv"))


def slices_of(path: str, infos: list[zipfile.ZipInfo], size: int) -> list[dict]:
    """An archive's CSV and zip members, by their number, in slices of about ``size`` compressed bytes."""
    out, members, held = [], [], 0
    for k, info in enumerate(infos):
        if not _is_data(info.filename):
            continue
        if members and held + info.compress_size > size:
            out.append({"path": path, "slice": len(out), "members": members, "bytes": held, "problem": None})
            members, held = [], 0
        members.append(k)
        held += info.compress_size
    if members:
        out.append({"path": path, "slice": len(out), "members": members, "bytes": held, "problem": None})
    return out or [{"path": path, "slice": None, "members": None, "bytes": 0, "problem": "archive without a CSV member"}]


class _Seekable(io.RawIOBase):
    """A remote file as ``zipfile`` wants it: a place before its start is an ``OSError``."""

    def __init__(self, file):
        self.file, self.size = file, file.size()

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.file.tell()

    def seek(self, offset: int, whence: int = 0) -> int:
        at = offset + (0, self.file.tell(), self.size)[whence]
        if at < 0:
            raise OSError("a place before the file's start")
        self.file.seek(min(at, self.size))
        return self.file.tell()

    def readinto(self, buffer) -> int:
        data = self.file.read(len(buffer))
        buffer[:len(data)] = data
        return len(data)

    def close(self) -> None:
        self.file.close()
        super().close()


def _open(path: str):
    store, where = LK.store_of(path)
    return io.BufferedReader(_Seekable(store.open_input_file(where)), 1 << 16)


def directories(paths: DataFrame, size: int = SLICE) -> DataFrame:
    """The slices of every archive in ``paths(path)``, from the archives' directories alone."""

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows: list[dict] = []
            for path in pdf["path"]:
                try:
                    with _open(path) as f, zipfile.ZipFile(f) as z:
                        rows += slices_of(path, z.infolist(), size)
                except _DAMAGE as e:
                    rows.append({"path": path, "slice": None, "members": None, "bytes": 0,
                                 "problem": f"unreadable archive: {type(e).__name__}"})
            yield pd.DataFrame(rows, columns=["path", "slice", "members", "bytes", "problem"]).astype({"slice": "Int32"})

    return paths.select("path").mapInPandas(look, SLICE_SCHEMA)


def _lines(stream) -> Iterator[tuple]:
    """(line number, header, cells) of a CSV stream: the header without cells, then every line that is not blank."""
    header = None
    for no, row in enumerate(csv.reader(io.TextIOWrapper(stream, encoding="utf-8-sig", newline=""))):
        if header is None:
            header = [h.strip() for h in row]
            yield no, header, None
        elif any(c.strip() for c in row):
            yield no, header, row


def _csv(z: zipfile.ZipFile, info: zipfile.ZipInfo, at: tuple, index: int) -> Iterator[tuple]:
    """The rows of a CSV member; what breaks on the way ends in a problem row of this member."""
    path, doc, doc_index = at
    lines = False
    try:
        with z.open(info) as stream:
            for no, header, cells in _lines(stream):
                lines = True
                yield path, doc, doc_index, info.filename, index, no, header, cells, None
    except _DAMAGE as e:
        yield path, doc, doc_index, info.filename, index, None, None, None, f"unreadable member: {type(e).__name__}"
        return
    if not lines:
        yield path, doc, doc_index, info.filename, index, None, None, None, "CSV member without a header"


def _inner(data: bytes, at: tuple) -> Iterator[tuple]:
    """The rows of a zip inside an archive, at any depth; ``at`` names the outermost one."""
    path, doc, doc_index = at
    index, found = 0, False
    try:
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            for info in z.infolist():
                if not _is_data(info.filename):
                    continue
                found = True
                if info.filename.lower().endswith(".csv"):
                    yield from _csv(z, info, at, index)
                else:
                    yield from _zip(z, info, at)
                index += 1
    except _DAMAGE as e:
        yield path, doc, doc_index, None, None, None, None, None, f"unreadable archive: {type(e).__name__}"
        return
    if not found:
        yield path, doc, doc_index, None, None, None, None, None, "archive without a CSV member"


def _zip(z: zipfile.ZipFile, info: zipfile.ZipInfo, at: tuple) -> Iterator[tuple]:
    path, doc, doc_index = at
    try:
        data = z.read(info)
    except _DAMAGE as e:
        yield path, doc, doc_index, None, None, None, None, None, f"unreadable member: {type(e).__name__}"
        return
    yield from _inner(data, at)


def slice_records(path: str, members: list[int]) -> Iterator[tuple]:
    """The rows of some members of an archive."""
    try:
        with _open(path) as f, zipfile.ZipFile(f) as z:
            infos = z.infolist()
            number, index = {}, 0  # CSV and zip members are numbered among themselves
            for k, info in enumerate(infos):
                if _is_data(info.filename):
                    number[k] = index
                    index += 1
            for k in members:
                info = infos[k]
                if info.filename.lower().endswith(".csv"):
                    yield from _csv(z, info, (path, None, None), number[k])
                else:
                    yield from _zip(z, info, (path, info.filename, number[k]))
    except _DAMAGE as e:
        yield path, None, None, None, None, None, None, None, f"unreadable archive: {type(e).__name__}"


def _read_slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows: list[tuple] = []
    for pdf in batches:
        for path, members, problem in zip(pdf["path"], pdf["members"], pdf["problem"], strict=True):
            found = slice_records(path, [int(m) for m in members]) if problem is None else iter(
                [(path, None, None, None, None, None, None, None, problem)])
            for row in found:
                rows.append(row)
                if len(rows) >= AR._FLUSH_ROWS:
                    yield pd.DataFrame(rows, columns=AR._COLUMNS)
                    rows = []
    if rows:
        yield pd.DataFrame(rows, columns=AR._COLUMNS)


def unpack_by_member(slices: DataFrame, tasks: int) -> DataFrame:
    """The records of ``slices`` (from :func:`directories`), dealt evenly over ``tasks`` tasks."""
    # the number of a slice in its archive spreads one archive's slices over all tasks
    turn = F.pmod(F.xxhash64("path") + F.coalesce("slice", F.lit(0)), F.lit(tasks)).cast("int")
    dealt = slices.withColumn("turn", turn).repartitionById(tasks, F.col("turn"))
    return dealt.select("path", "members", "problem").mapInPandas(_read_slices, AR.RECORD_SCHEMA)


def read_members(spark: SparkSession, root: str, glob: str = "*.zip", *, size: int = SLICE, tasks: int | None = None) -> DataFrame:
    """SRC01 + SRC02 + SRC05: the records of every archive under ``root``, read by member."""
    fs, _ = LK._fs(spark, root)
    if fs.getScheme() not in OPENED:
        return AR.unpack(AR.read_archives(spark, root, glob))
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
             .load(root).select("path"))
    tasks = tasks or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    slices = directories(files.repartition(tasks, "path"), size)
    return unpack_by_member(slices, tasks)
