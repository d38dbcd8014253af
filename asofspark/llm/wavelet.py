"""Wavelet matrix shards of token ids.

A shard file holds whole documents in ascending id order: a header, the documents' ids and
lengths, and the wavelet matrix of their tokens. The matrix has one bit plane per id bit, the most
significant first; after each plane the sequence is split stably, zeros before ones. A plane is cut into
blocks of ``BLOCK`` bits that are compressed one by one; its table has for every block where it ends
and the ones before it. A token, a count of a token or its j-th occurrence takes one rank or select
per plane, and a rank or select reads the plane's table and one block: a reader opens that much of a file
and no more (:meth:`Shard.over` takes any function that reads a range).

Layout, little-endian: magic ``WMX2``; unsigned 32-bit header length; JSON header (bucket, file,
tokens, documents, bits, and for every section its length); then the sections: document ids (64-bit) and
token counts (64-bit), zstandard-compressed, and per plane its table (pairs of 32-bit integers: end of the
block in the plane, ones up to its end) and its blocks, packed low bit first, zstandard-compressed.

Documents are dealt to buckets of ascending id ranges, one task each; a bucket is cut into files
of about ``shard_tokens``. A file is written under a temporary name and moved into place, and its
name and bytes depend only on the rows, so a repeated task writes the same file again.

Cases: a null text is empty and still has its end id. Null ids come first; rows sharing an id
follow the hash of their text. A document longer than a shard has a shard of its own. An empty
table writes no files.
"""

from __future__ import annotations

import json
import struct
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from asofspark.llm.common import bounded_batches, text_of, written
from asofspark.llm.ranges import by_range
from asofspark.llm.tokens import encoder
from asofspark.session import scratch_path

MAGIC = b"WMX2"
BLOCK = 1 << 15
SHARD_TOKENS = 4 << 20
SLICE = 256
#: Tokens that are split or merged at a time: their places stay in a core's cache.
PART = 1 << 16
_LEVEL = 1


def _pack(array: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=_LEVEL).compress(array.tobytes())


def build(tokens: np.ndarray) -> tuple[int, list[np.ndarray]]:
    """``(bits, planes)``; a plane is its packed bits."""
    bits = max(1, int(tokens.max()).bit_length()) if len(tokens) else 1
    seq = tokens.astype(np.uint16 if bits <= 16 else np.uint32)
    split, planes = np.empty_like(seq), []
    for level in range(bits - 1, -1, -1):
        ones = (seq & seq.dtype.type(1 << level)) != 0
        planes.append(np.packbits(ones, bitorder="little"))
        zero, one = 0, len(seq) - int(np.count_nonzero(ones))
        for s in range(0, len(seq) if level else 0, PART):
            mask, part = ones[s:s + PART], seq[s:s + PART]
            found = part.take(np.flatnonzero(mask))
            split[one:one + len(found)] = found
            one += len(found)
            found = part.take(np.flatnonzero(~mask))
            split[zero:zero + len(found)] = found
            zero += len(found)
        seq, split = split, seq
    return bits, planes


def _blocks(packed: np.ndarray) -> tuple[bytes, bytes]:
    """``(table, blocks)`` of a plane."""
    step, squeeze = BLOCK // 8, zstandard.ZstdCompressor(level=_LEVEL).compress
    if not len(packed):
        return b"", b""
    parts = [squeeze(packed[s:s + step]) for s in range(0, len(packed), step)]
    ones = np.add.reduceat(np.bitwise_count(packed).astype(np.int64), np.arange(0, len(packed), step))
    table = np.stack([np.cumsum([len(p) for p in parts]), np.cumsum(ones)], 1).astype("<u4")
    return table.tobytes(), b"".join(parts)


def to_bytes(bucket: int, file: int, ids: list, counts: list[int], tokens: np.ndarray) -> bytes:
    """One shard. ``ids`` may hold None, written as a flag beside a zero."""
    bits, planes = build(tokens)
    sections = [_pack(np.array([0 if i is None else i for i in ids], "<i8")), _pack(np.array(counts, "<i8"))]
    for packed in planes:
        sections += _blocks(packed)
    header = json.dumps({"bucket": bucket, "file": file, "tokens": len(tokens), "documents": len(ids), "bits": bits,
                         "nulls": [k for k, i in enumerate(ids) if i is None],
                         "sections": [len(s) for s in sections]}).encode()
    return b"".join([MAGIC, struct.pack("<I", len(header)), header, *sections])


class Shard:
    """A shard read from its bytes, or over a function that reads ranges of it."""

    def __init__(self, data: bytes):
        self._open(lambda at, size: data[at:at + size])

    @classmethod
    def over(cls, read: Callable[[int, int], bytes]) -> Shard:
        """A shard of which ``read(place, size)`` gives the bytes that are asked for."""
        shard = cls.__new__(cls)
        shard._open(read)
        return shard

    def _open(self, read: Callable[[int, int], bytes]) -> None:
        head = read(0, 8)
        if head[:4] != MAGIC:
            raise ValueError("not a wavelet matrix shard")
        (n,) = struct.unpack_from("<I", head, 4)
        self.header = json.loads(read(8, n))
        self._read, at = read, 8 + n
        self._at = []
        for size in self.header["sections"]:
            self._at.append((at, size))
            at += size
        self._tables: dict[int, np.ndarray] = {}
        self._held: dict[tuple[int, int], np.ndarray] = {}
        self.n, self.bits = self.header["tokens"], self.header["bits"]

    def _section(self, k: int, dtype: str) -> np.ndarray:
        return np.frombuffer(zstandard.ZstdDecompressor().decompress(self._read(*self._at[k])), dtype)

    def documents(self) -> tuple[list, np.ndarray]:
        """Document ids and token counts, in file order."""
        ids = self._section(0, "<i8").tolist()
        for k in self.header["nulls"]:
            ids[k] = None
        return ids, self._section(1, "<i8")

    def _table(self, level: int) -> np.ndarray:
        """(end, ones up to it) of every block of a plane, after a row of zeros."""
        if level not in self._tables:
            table = np.frombuffer(self._read(*self._at[2 + 2 * level]), "<u4").reshape(-1, 2).astype(np.int64)
            self._tables[level] = np.concatenate([np.zeros((1, 2), np.int64), table])
        return self._tables[level]

    def _zeros(self, level: int) -> int:
        return self.n - int(self._table(level)[-1, 1])

    def _block(self, level: int, block: int) -> np.ndarray:
        """Packed bits of one block; the last few that were asked for are kept."""
        key = (level, block)
        if key not in self._held:
            table = self._table(level)
            a, b = int(table[block, 0]), int(table[block + 1, 0])
            data = self._read(self._at[3 + 2 * level][0] + a, b - a)
            while len(self._held) >= 4 * self.bits:
                self._held.pop(next(iter(self._held)))
            self._held[key] = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
        return self._held[key]

    def _rank1(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        block, inside = divmod(i, BLOCK)
        ones = int(self._table(level)[block, 1])
        if not inside:
            return ones
        packed = self._block(level, block)
        ones += int(np.bitwise_count(packed[:inside // 8]).sum())
        return ones + (int(packed[inside // 8] & ((1 << (inside % 8)) - 1)).bit_count() if inside % 8 else 0)

    def _select(self, level: int, bit: int, j: int) -> int:
        """Place of the j-th (from 0) ``bit`` of a plane."""
        ones = self._table(level)[:, 1]
        before = ones if bit else np.arange(len(ones)) * BLOCK - ones
        block = int(np.searchsorted(before[:-1], j, side="right")) - 1
        inside = np.unpackbits(self._block(level, block), bitorder="little")[:self.n - block * BLOCK]
        return block * BLOCK + int(np.flatnonzero(inside == bit)[j - int(before[block])])

    def access(self, i: int) -> int:
        """The i-th token."""
        value = 0
        for level in range(self.bits):
            block, inside = divmod(i, BLOCK)
            bit = (int(self._block(level, block)[inside // 8]) >> (inside % 8)) & 1
            ones = self._rank1(level, i)
            i = self._zeros(level) + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _range(self, token: int, start: int, end: int) -> tuple[int, int]:
        for level in range(self.bits):
            a, b = self._rank1(level, start), self._rank1(level, end)
            if token >> (self.bits - 1 - level) & 1:
                zeros = self._zeros(level)
                start, end = zeros + a, zeros + b
            else:
                start, end = start - a, end - b
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """Occurrences of a token in a range."""
        if token >> self.bits or not self.n:
            return 0
        a, b = self._range(token, start, self.n if end is None else end)
        return b - a

    def locate(self, token: int, j: int) -> int:
        """Place of the j-th (from 0) occurrence of a token; -1 beyond the last."""
        if token >> self.bits or not self.n:
            return -1
        a, b = self._range(token, 0, self.n)
        if j >= b - a:
            return -1
        at = a + j
        for level in range(self.bits - 1, -1, -1):
            bit = token >> (self.bits - 1 - level) & 1
            at = self._select(level, bit, at - self._zeros(level) if bit else at)
        return at

    def _plane(self, level: int) -> np.ndarray:
        """A whole plane's packed bits."""
        ends, data = self._table(level)[:, 0].tolist(), self._read(*self._at[3 + 2 * level])
        unpack = zstandard.ZstdDecompressor().decompress
        return np.frombuffer(b"".join(unpack(data[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)), np.uint8)

    def tokens(self) -> np.ndarray:
        """All tokens: the stable splits undone from the last plane to the first."""
        seq = np.zeros(self.n, np.uint16 if self.bits <= 16 else np.uint32)
        merged = np.empty_like(seq)
        for level in range(self.bits - 1, -1, -1):
            zero, one, bit = 0, self._zeros(level), seq.dtype.type(1 << (self.bits - 1 - level))
            ones = np.unpackbits(self._plane(level), count=self.n, bitorder="little").view(bool)
            for s in range(0, self.n, PART):
                mask, part = ones[s:s + PART], merged[s:s + PART]
                places = np.flatnonzero(mask)
                part[places] = seq[one:one + len(places)] | bit
                one += len(places)
                places = np.flatnonzero(~mask)
                part[places] = seq[zero:zero + len(places)]
                zero += len(places)
            seq, merged = merged, seq
        return seq.astype("<u4")


def _store(folder: str):
    """The folder's file system and the folder's path in it. Hadoop's names for S3 are pyarrow's ``s3``."""
    from pyarrow import fs

    for name in ("s3a://", "s3n://"):
        folder = "s3://" + folder[len(name):] if folder.startswith(name) else folder
    return fs.FileSystem.from_uri(folder if ":/" in folder else f"file://{folder}")


def write_file(folder: str, name: str, data: bytes) -> None:
    """A whole file or none: written under another name, then moved into place."""
    store, root = _store(folder)
    part = f"{root}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(part) as out:
        out.write(data)
    store.move(part, f"{root}/{name}")


def write_shards(spark: SparkSession, docs: DataFrame, folder: str, tokenizer_path: str, *, end_id: int,
                 shard_tokens: int = SHARD_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> int:
    """Encode all documents and write their shards to ``folder``; returns the number of files."""
    bounded_batches(spark)
    store, root = _store(folder)
    store.create_dir(root, recursive=True)
    slim = docs.select(docs[id_col].cast("long").alias("id"), text_of(docs, text_col).alias("text"))
    dealt = by_range(spark, slim.withColumn("text_key", F.xxhash64("text")), "id", "text_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path).encode
        bucket, file, ids, parts, held = None, 0, [], [], 0

        def close():
            nonlocal file, ids, parts, held
            if ids:
                data = to_bytes(bucket, file, ids, [len(p) for p in parts], np.concatenate(parts))
                write_file(folder, f"shard-{bucket:06d}-{file:06d}.wm", data)
                file, ids, parts, held = file + 1, [], [], 0
                return 1
            return 0

        done = 0
        for b in batches:
            for at, doc_id, tokens in zip(*(b.column(k).to_pylist() for k in (0, 1)), encode(b.column(2)), strict=True):
                if at != bucket or held >= shard_tokens:
                    done += close()
                    if at != bucket:
                        bucket, file = at, 0
                ids.append(doc_id)
                parts.append(np.append(tokens, np.uint32(end_id)))
                held += len(parts[-1])
        done += close()
        yield pa.record_batch([pa.array([done], pa.int64())], names=["files"])

    files = dealt.select("bucket", "id", "text").mapInArrow(run, "files long").agg(F.sum("files")).first()[0]
    return files or 0


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document, from the files alone: bucket, file, id, in_file (tokens before it in
    the file), file_tokens, tokens (little-endian unsigned 32-bit integers).
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.wm").load(folder).select("content"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                shard = Shard(content.as_py())
                ids, counts = shard.documents()
                ends = np.cumsum(counts)
                data = shard.tokens().tobytes()
                h, m = shard.header, len(ids)
                for s in range(0, m, SLICE):
                    e = min(m, s + SLICE)
                    starts = (ends[s:e] - counts[s:e]).tolist()
                    blobs = [data[4 * a:4 * z] for a, z in zip(starts, ends[s:e].tolist(), strict=True)]
                    yield pa.record_batch(
                        [pa.array([h["bucket"]] * (e - s), pa.int32()), pa.array([h["file"]] * (e - s), pa.int32()),
                         pa.array(ids[s:e], pa.int64()), pa.array(starts, pa.int64()),
                         pa.array([shard.n] * (e - s), pa.int64()), pa.array(blobs, pa.binary())],
                        names=["bucket", "file", "id", "in_file", "file_tokens", "tokens"])

    return files.mapInArrow(run, "bucket int, file int, id long, in_file long, file_tokens long, tokens binary")


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """Per document read back: id, start (tokens of all documents before it), n_tokens, ids_crc32."""
    bounded_batches(spark)
    rows = written(spark, read_shards(spark, folder).select(
        "bucket", "file", "id", "in_file", "file_tokens",
        (F.length("tokens") / 4).cast("long").alias("n_tokens"), F.crc32("tokens").alias("ids_crc32")), "shard-rows")
    firsts = rows.where("in_file = 0").groupBy("bucket", "file").agg(F.max("file_tokens").alias("n"))
    # sums over the files of a bucket, then over the buckets: one row per task that wrote
    before = Window.partitionBy("bucket").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = firsts.withColumn("file_start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    buckets = firsts.groupBy("bucket").agg(F.sum("n").alias("n"))
    ahead = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select("bucket", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("bucket_start"))
    at = files.join(buckets, "bucket").select("bucket", "file", (F.col("file_start") + F.col("bucket_start")).alias("base"))
    return rows.join(at, ["bucket", "file"]).select(
        "id", (F.col("base") + F.col("in_file")).cast("long").alias("start"), "n_tokens", "ids_crc32")


def shard_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "llm-wavelet")
