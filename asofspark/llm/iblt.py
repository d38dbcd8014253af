"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text's paragraphs are its lines; lines of more than ``PARAGRAPH`` code points are cut every so
many. Every paragraph's digest goes into one cell of each of three tables; a cell holds a count,
the exclusive or of its digests and of their checks. Subtracting two sketches cancels what the
versions share, and peeling cells that hold one digest recovers the digests that differ. When the
difference is too large for the sketches, peeling stops early, and the pair is tried again with
sketches twice as large, until it succeeds. Peeling takes at most as many rounds as there are cells. The fingerprint of a text is its smallest sketch.

A paragraph that repeats in a text counts as often as it stands there: the digest of its k-th
occurrence is its own. Empty paragraphs do not count.

Likeness of two texts is the share of all their distinct digests that both have; two texts
without paragraphs are alike (1).

Neighbours: rows are dealt in ascending ranges of (id, text hash), also inside one id or none; the first row of a range also
travels to the range before it, and the very first to the last range. So each text moves
once, and no task holds more than a slice of rows.

Cases: a null text is empty. Null ids come first. Rows that share an id follow the hash of their
text. A single row is its own neighbour. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asofspark.llm.common import bounded_batches, shuffle_width, text_of
from asofspark.llm.ranges import bounds, bucket_of

PARAGRAPH = 160
CELLS = 24
#: Cells a digest beyond which a sketch that still cannot be peeled is given up.
SPARSE = 64
SLICE = 512
_M64 = (1 << 64) - 1
_GOLD, _A, _B = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def paragraphs(text: str) -> list[str]:
    out = []
    for line in text.split("\n"):
        if len(line) <= PARAGRAPH:
            out.append(line)
        else:
            out.extend(line[s:s + PARAGRAPH] for s in range(0, len(line), PARAGRAPH))
    return [p for p in out if p]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def digests(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``(owner, digest)`` of every paragraph, distinct per owner: repeats carry their number."""
    parts = [paragraphs(t) for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
    raw = np.array([xxhash.xxh3_64_intdigest(p.encode()) for ps in parts for p in ps], dtype=np.uint64)
    order = np.lexsort((raw, owner))
    owner, raw = owner[order], raw[order]
    new = np.ones(len(raw), bool)
    new[1:] = (raw[1:] != raw[:-1]) | (owner[1:] != owner[:-1])
    at = np.arange(len(raw))
    nth = at - np.maximum.accumulate(np.where(new, at, 0)) if len(raw) else at
    return owner, _mix(raw + nth.astype(np.uint64) * _GOLD)


def _cells(keys: np.ndarray, owner: np.ndarray, cells: int) -> np.ndarray:
    """The three cells of every key, as places in the flat table of all owners."""
    third = np.uint64(cells // 3)
    salt = [np.uint64((t + 1) * int(_GOLD) * (cells + 1) & _M64) for t in range(3)]
    places = [_mix(keys + salt[t]) % third + np.uint64(t) * third for t in range(3)]
    return np.stack(places).astype(np.int64) + owner * cells


def check_of(keys: np.ndarray) -> np.ndarray:
    return _mix(keys ^ _B)


class Sketches:
    """One sketch per owner, side by side in flat arrays."""

    def __init__(self, owners: int, cells: int):
        self.owners, self.cells = owners, cells
        self.count = np.zeros(owners * cells, np.int32)
        self.keys = np.zeros(owners * cells, np.uint64)
        self.checks = np.zeros(owners * cells, np.uint64)

    def add(self, owner: np.ndarray, keys: np.ndarray, sign) -> None:
        checks = check_of(keys)
        for at in _cells(keys, owner, self.cells):
            np.add.at(self.count, at, sign)
            np.bitwise_xor.at(self.keys, at, keys)
            np.bitwise_xor.at(self.checks, at, checks)

    def text(self, owner: int) -> str:
        s = slice(owner * self.cells, (owner + 1) * self.cells)
        return base64.b64encode(self.count[s].astype("<i4").tobytes() + self.keys[s].astype("<u8").tobytes()
                                + self.checks[s].astype("<u8").tobytes()).decode()

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(owner, key, sign, whole)``: recovered digests, and per owner whether all were.

        A sketch that can be peeled holds no more digests than cells and gives at least one a round,
        so there are at most as many rounds as cells. A cell that passes its check by chance could
        be added and removed for ever; such a sketch runs out of rounds and is not whole.
        """
        found = []
        for _ in range(self.cells):
            at = np.flatnonzero(np.abs(self.count) == 1)
            at = at[check_of(self.keys[at]) == self.checks[at]]
            if not len(at):
                break
            owner, keys, sign = at // self.cells, self.keys[at], self.count[at]
            # a cell that looks pure by chance does not hold a digest of its own
            right = (_cells(keys, owner, self.cells) == at).any(axis=0)
            owner, keys, sign = owner[right], keys[right], sign[right]
            order = np.lexsort((keys, owner))
            owner, keys, sign = owner[order], keys[order], sign[order]
            once = np.ones(len(keys), bool)
            once[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
            owner, keys, sign = owner[once], keys[once], sign[once]
            if not len(keys):
                break
            self.add(owner, keys, -sign)
            found.append((owner, keys, sign))
        left = (self.count != 0) | (self.keys != 0) | (self.checks != 0)
        whole = ~left.reshape(self.owners, self.cells).any(axis=1)
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int32), whole
        return *(np.concatenate(x) for x in zip(*found, strict=True)), whole


def _plain_differences(a: tuple, b: tuple, pairs: np.ndarray) -> Iterator[tuple]:
    """As :func:`differences`, by the sorted digests of the named pairs."""
    for p in pairs:
        own, other = a[1][a[0] == p], b[1][b[0] == p]
        for keys, sign in ((np.setdiff1d(own, other), 1), (np.setdiff1d(other, own), -1)):
            yield np.full(len(keys), p), keys, np.full(len(keys), sign, np.int32)


def differences(a: tuple, b: tuple, pairs: int, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(pair, digest, sign)`` that differ between the sides ``a`` and ``b`` = (pair, digest):
    +1 only in ``a``, -1 only in ``b``. Pairs whose peeling fails are tried again with twice the cells;
    one that fails with ``SPARSE`` cells a digest (digests that collide) is compared digest by digest.
    """
    todo, out = np.arange(pairs), []
    most = np.bincount(a[0], minlength=pairs) + np.bincount(b[0], minlength=pairs)
    while len(todo):
        plain = todo[cells > np.maximum(SPARSE * most[todo], CELLS)]
        out.extend(_plain_differences(a, b, plain))
        todo = todo[~np.isin(todo, plain)]
        name = np.full(pairs, -1)
        name[todo] = np.arange(len(todo))
        diff = Sketches(len(todo), cells)
        for (pair, keys), sign in ((a, 1), (b, -1)):
            use = name[pair] >= 0
            diff.add(name[pair[use]], keys[use], sign)
        pair, keys, sign, whole = diff.peel()
        ok = whole[pair]
        out.append((todo[pair[ok]], keys[ok], sign[ok]))
        todo, cells = todo[~whole], cells * 2
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int32)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def likeness(a: tuple, b: tuple, pairs: int) -> np.ndarray:
    """Shared digests over all digests, from the sizes and the recovered difference."""
    pair, _, sign = differences(a, b, pairs)
    n_a = np.bincount(a[0], minlength=pairs)
    only_a = np.bincount(pair[sign > 0], minlength=pairs)
    only_b = np.bincount(pair[sign < 0], minlength=pairs)
    both = n_a + only_b
    return np.where(both == 0, 1.0, (n_a - only_a) / np.maximum(both, 1))


def edited_text(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the next text."""
    k = len(text) // 4
    return text[:len(text) - k] + following[:k]


def _with_next(docs: DataFrame, spark: SparkSession, parts: int) -> DataFrame:
    """``docs(id, text)`` dealt by ranges of id, with the guests that close each range."""
    keyed = docs.withColumn("text_key", F.xxhash64("text"))
    cuts = bounds(docs, "id", parts)
    place = keyed.withColumn("bucket", bucket_of(F.col("id"), F.col("text_key"), cuts).cast("int"))
    firsts = sorted((r.bucket, r.first) for r in place.groupBy("bucket").agg(  # one row per range
        F.min(F.struct("id", "text_key")).alias("first")).collect())
    if not firsts:
        return place.withColumn("guest", F.lit(False)).limit(0)
    names = [b for b, _ in firsts]
    homes = [(None if f["id"] is None else int(f["id"]), int(f["text_key"]), names[k - 1]) for k, (_, f) in enumerate(firsts)]
    homes = spark.createDataFrame(homes, "g_id long, g_key long, home int")
    here = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("guest"))
    there = F.struct(F.col("home").alias("bucket"), F.lit(True).alias("guest"))
    known = F.col("id").eqNullSafe(F.col("g_id")) & (F.col("text_key") == F.col("g_key"))
    both = (place.join(F.broadcast(homes), known, "left")
            .withColumn("at", F.explode(F.when(F.col("home").isNull(), F.array(here)).otherwise(F.array(here, there))))
            .select("id", "text", "text_key", "at.bucket", "at.guest"))
    return (both.repartitionById(len(cuts) + 1, F.col("bucket"))
            .sortWithinPartitions("bucket", "guest", "id", "text_key"))


def fingerprints(spark: SparkSession, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 cells: int = CELLS, parts: int | None = None) -> DataFrame:
    """Per row: id, n_chars, edited_sha256, the fingerprints of its text and of the edited text,
    the likeness to the edited and to the next text, and the digests by which the edit differs
    (``gone`` and ``come``).
    """
    bounded_batches(spark)
    slim = docs.select(docs[id_col].cast("long").alias("id"), text_of(docs, text_col).alias("text"))
    dealt = _with_next(slim, spark, parts or shuffle_width(spark))
    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "gone", "come"]

    def finished(ids: list, texts: list[str], following: list[str]) -> pa.RecordBatch:
        n = len(texts)
        edited = [edited_text(t, f) for t, f in zip(texts, following, strict=True)]
        own, new, nxt = digests(texts), digests(edited), digests(following)
        base = Sketches(2 * n, cells)
        base.add(own[0], own[1], 1)
        base.add(new[0] + n, new[1], 1)
        pair, keys, sign = differences(own, new, n, cells)
        lists = []
        for which in (1, -1):
            use = sign == which
            order = np.lexsort((keys[use], pair[use]))
            counts = np.bincount(pair[use], minlength=n)
            lists.append(pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()),
                                                  pa.array(keys[use][order].view(np.int64))))
        return pa.record_batch([
            pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
            pa.array([base.text(k) for k in range(n)]), pa.array([base.text(n + k) for k in range(n)]),
            pa.array(likeness(own, new, n)), pa.array(likeness(own, nxt, n)), *lists], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, last, ids, texts, following = None, None, [], [], []
        for b in batches:
            for doc_id, text, at, guest in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                if at == bucket and last is not None:
                    ids.append(last[0]), texts.append(last[1]), following.append(text)
                    if len(ids) == SLICE:
                        yield finished(ids, texts, following)
                        ids, texts, following = [], [], []
                bucket, last = at, None if guest else (doc_id, text)
        if ids:
            yield finished(ids, texts, following)

    return dealt.select("id", "text", "bucket", "guest").mapInArrow(
        run, "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double, gone array<long>, come array<long>")
