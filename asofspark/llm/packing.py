"""Bounded-space online packing of token ids into fixed windows.

Each partition keeps ``open_windows`` open windows. Whole windows' worth of a document goes out
directly; what is left of it is placed best-fit, into the open window that it fills up most. When
none has room the fullest window is emitted: as it is if at most ``max_pad`` places stay empty,
and otherwise topped up with a cut of the document at hand. At its end a partition passes on its
open windows, at most ``open_windows`` of them; these leftovers are merged in rounds, ``FAN`` partitions
to one, by the same packer. The last round fills windows to the brim and cuts the rest into
sequences whose lengths are powers of two, so that nothing is padded there.

Memory is the open windows and one slice of documents. The ids are written once, after the first
round, so that a lost executor never repeats the tokenizer's work for both the finished windows
and the leftovers.

Cases: a null text is empty and still has its end id. Rows that share an id are packed
each for itself. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asofspark.llm.common import bounded_batches, text_of, written
from asofspark.llm.tokens import REMEMBERED, encoder

WINDOW = 2048
OPEN = 32
MAX_PAD = 16
FAN = 64
SLICE = 256
SCHEMA = ("sealed boolean, sequence_id long, offset int, doc_id long, start long, doc_tokens long, ids binary")
_NAMES = [f.split()[0] for f in SCHEMA.split(", ")]


class Packer:
    """The open windows of one partition. A piece is (doc_id, start, doc_tokens, ids)."""

    def __init__(self, window: int, open_windows: int, max_pad: int, base: int):
        self.window, self.most, self.max_pad = window, open_windows, max_pad
        self.open: list[list] = []  # [room, pieces]
        self.next_id = base
        self.rows: list[tuple] = []

    def emit(self, pieces: list[tuple], sealed: bool = True) -> None:
        offset = 0
        for doc_id, start, total, ids in pieces:
            self.rows.append((sealed, self.next_id, offset, doc_id, start, total, ids.tobytes()))
            offset += len(ids)
        self.next_id += 1

    def add(self, doc_id, start: int, total: int, ids: np.ndarray) -> None:
        while len(ids) >= self.window:
            self.emit([(doc_id, start, total, ids[:self.window])])
            start, ids = start + self.window, ids[self.window:]
        while len(ids):
            fits = [w for w in self.open if w[0] >= len(ids)]
            if fits:
                best = min(fits, key=lambda w: w[0])
            elif len(self.open) < self.most:
                best = [self.window, []]
                self.open.append(best)
            else:
                best = min(self.open, key=lambda w: w[0])
                if best[0] <= self.max_pad:
                    self.open.remove(best)
                    self.emit(best[1])
                    continue
            part = ids[:best[0]]
            best[1].append((doc_id, start, total, part))
            best[0] -= len(part)
            start, ids = start + len(part), ids[len(part):]
            if not best[0]:
                self.open.remove(best)
                self.emit(best[1])

    def leave(self) -> None:
        """Pass the open windows on."""
        for _, pieces in self.open:
            self.emit(pieces, sealed=False)
        self.open = []

    def finish(self) -> None:
        """No window is left open: full ones, then lengths that are powers of two."""
        rest = [p for _, pieces in self.open for p in pieces]
        self.open = []
        left = sum(len(p[3]) for p in rest)
        while left:
            size = min(self.window, 1 << (left.bit_length() - 1))
            left -= size
            now = []
            while size:
                doc_id, start, total, ids = rest.pop(0)
                now.append((doc_id, start, total, ids[:size]))
                if len(ids) > size:
                    rest.insert(0, (doc_id, start + size, total, ids[size:]))
                size -= min(size, len(ids))
            self.emit(now)

    def batch(self) -> pa.RecordBatch:
        cols = list(zip(*self.rows, strict=True)) if self.rows else [[]] * len(_NAMES)
        self.rows = []
        types = [pa.bool_(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        return pa.record_batch([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=_NAMES)


def _base(level: int) -> int:
    """Sequence ids: 3 bits of round, 24 of partition, 36 of running number."""
    return (level << 60) | (TaskContext.get().partitionId() << 36)


def pack(spark: SparkSession, docs: DataFrame, tokenizer_path: str, *, end_id: int, window: int = WINDOW,
         open_windows: int = OPEN, max_pad: int = MAX_PAD, id_col: str = "doc_id",
         text_col: str = "text", remembered: int = REMEMBERED) -> DataFrame:
    """One row per piece: sequence_id, offset in the sequence, doc_id, start in the document,
    doc_tokens and the piece's ids (little-endian unsigned 32-bit integers). ``remembered`` words are
    kept encoded by each worker (some 60 bytes each).
    """
    bounded_batches(spark)
    slim = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(docs, text_col).alias("text"))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, encode = Packer(window, open_windows, max_pad, _base(0)), encoder(tokenizer_path, remembered).encode
        for b in batches:
            rows = list(zip(b.column(0).to_pylist(), encode(b.column(1)), strict=True))
            for s in range(0, len(rows), SLICE):
                for doc_id, ids in rows[s:s + SLICE]:
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    packer.add(doc_id, 0, len(ids), ids)
                yield packer.batch()
        packer.leave()
        yield packer.batch()

    out = written(spark, slim.mapInArrow(first, SCHEMA), "packed")
    done = out.where("sealed")
    left = out.where("not sealed")
    group = F.shiftrightunsigned("sequence_id", 36).bitwiseAND(F.lit((1 << 24) - 1))
    # an upper bound of the partitions that passed windows on
    parts = (left.agg(F.max(group)).first()[0] or 0) + 1
    level = 1
    while True:
        parts = -(-parts // FAN)
        last = parts == 1

        def merge(batches: Iterator[pa.RecordBatch], level=level, last=last) -> Iterator[pa.RecordBatch]:
            packer = Packer(window, open_windows, max_pad, _base(level))
            for b in batches:
                for doc_id, start, total, ids in zip(*(b.column(k).to_pylist() for k in (3, 4, 5, 6)), strict=True):
                    packer.add(doc_id, start, total, np.frombuffer(ids, "<u4"))
                yield packer.batch()
            (packer.finish if last else packer.leave)()
            yield packer.batch()

        dealt = (left.withColumn("of", F.floor(group / FAN).cast("int"))
                 .repartitionById(parts, F.col("of")).drop("of"))
        merged = dealt.sortWithinPartitions("sequence_id", "offset").mapInArrow(merge, SCHEMA)
        if last:
            return done.union(merged).drop("sealed")
        merged = written(spark, merged, "merged")
        done, left, level = done.union(merged.where("sealed")), merged.where("not sealed"), level + 1
