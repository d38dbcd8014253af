"""SimHash near-duplicates through a segment-popcount embedding.

A 64-bit fingerprint is cut into 32 segments of two bits; its embedding is the vector of the
segments' bit counts. One differing bit changes one count by one, so the Manhattan distance of
two embeddings never exceeds the Hamming distance of the fingerprints. The range join runs on a
grid over the embedding: the segments form ``2 * max_bits`` groups, at most ``max_bits`` of which
can differ between two linked fingerprints, so linked fingerprints share the cell of at least one
choice of ``max_bits`` groups. Cell mates pass the Manhattan bound first and are then compared
exactly.

Counts are kept in unary (0 -> 00, 1 -> 01, 2 -> 11), so a Manhattan distance is the population
count of an exclusive or.

Cases: a null or blank text has fingerprint zero and is linked like any other. Texts with fewer
words than a shingle are one shingle. Rows with equal fingerprints are one point, however many.
A null id is never the smallest of a group; a group with null ids only has a null component.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asofspark.llm.common import bounded_batches, packed, shuffle_width, text_of, unpacked, written
from asofspark.llm.components import components

SEGMENTS = 32
LOW = 0x5555555555555555
#: Members of one cell that one task compares; larger cells go on as pairs of such blocks.
BLOCK = 32768
_digest = partial(xxhash.xxh64_intdigest, seed=42)


def fingerprint(text: str, shingle: int = 3) -> int:
    """The fingerprint of one text, as a signed 64-bit integer.

    Bytes split at exactly ``[\\x20\\x09-\\x0D]+`` and lower-case exactly A-Z.
    """
    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    h = np.array(list(map(_digest, grams)), dtype=np.uint64)
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    over = np.add.reduce(bits, axis=0, dtype=np.int64) * 2 > len(h)
    return int(np.packbits(over, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(id, fp)`` of every row."""
    slim = docs.select(docs[id_col].cast("long").alias("id"), text_of(docs, text_col).alias("text"))

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = [fingerprint(t.as_py(), shingle) for t in b.column(1)]
            yield pa.record_batch([b.column(0), pa.array(fp, pa.int64())], names=["id", "fp"])

    return slim.mapInArrow(prints, "id long, fp long")


def embedding(fp: Column) -> Column:
    """Unary bit counts of the two-bit segments."""
    a = fp.bitwiseAND(F.lit(LOW))
    b = F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(LOW))
    return F.shiftleft(a.bitwiseAND(b), 1).bitwiseOR(a.bitwiseOR(b))


def _embed(fp: np.ndarray) -> np.ndarray:
    fp = fp.view(np.uint64)
    a, b = fp & np.uint64(LOW), (fp >> np.uint64(1)) & np.uint64(LOW)
    return ((a & b) << np.uint64(1)) | a | b


def masks(max_bits: int) -> list[int]:
    """Bit masks of the grid's projections: every choice of ``max_bits`` of ``2 * max_bits`` groups."""
    groups = [sum(3 << (2 * int(s)) for s in part)
              for part in np.array_split(range(SEGMENTS), 2 * max_bits)]
    out = [sum(c) for c in combinations(groups, max_bits)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in out]


def linked(fp: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Star edges of the components among one cell's fingerprints.

    Breadth first over the points not reached yet: each point is compared with those only, so
    a cell of near copies costs about its size, and only points that do not link cost pairs.
    """
    rest = np.unique(fp)
    while len(rest) > 1:
        first, reach = rest[0], [rest[:1]]
        todo, rest = [rest[0]], rest[1:]
        emb = _embed(rest)
        while todo and len(rest):
            p = np.array([todo.pop()])
            near = np.bitwise_count(emb ^ _embed(p)) <= max_bits
            if near.any():
                i = np.flatnonzero(near)
                i = i[np.bitwise_count((rest[i] ^ p).view(np.uint64)) <= max_bits]
                if len(i):
                    hit = rest[i]
                    todo.extend(hit.tolist())
                    reach.append(hit)
                    rest, emb = np.delete(rest, i), np.delete(emb, i)
        if len(reach) > 1:
            others = np.concatenate(reach[1:])
            yield np.full(len(others), first), others


def _runs(batches: Iterator[pa.RecordBatch], max_bits: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Edges of each run of equal cells in a sorted partition.

    A run longer than ``limit`` is passed on in blocks of ``limit`` (``block`` is then not null).
    """
    held_cell, held, passed = None, [], 0
    names = ["a", "b", "block"]

    def rows(a, b, block):
        return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64()), block], names=names)

    def flush():
        nonlocal held, passed
        points = np.concatenate(held) if held else np.zeros(0, np.int64)
        if passed:
            block = pa.array(np.full(len(points), passed), pa.int32())
            yield rows(np.full(len(points), held_cell), points, block)
        elif len(points) > 1:
            for a, b in linked(points, max_bits):
                yield rows(a, b, pa.nulls(len(a), pa.int32()))
        held, passed = [], 0

    for batch in batches:
        cell, fp = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(cell):
            continue
        cuts = np.flatnonzero(cell[1:] != cell[:-1]) + 1
        starts, ends = np.r_[0, cuts], np.r_[cuts, len(cell)]
        # runs of one inside the batch need no look; the first and last may go on elsewhere
        look = (ends - starts) > 1
        look[0] = look[-1] = True
        for s, e in zip(starts[look].tolist(), ends[look].tolist(), strict=True):
            if held_cell is None or cell[s] != held_cell:
                yield from flush()
                held_cell = cell[s]
            held.append(fp[s:e])
            while sum(map(len, held)) > limit:
                points = np.concatenate(held)
                block = pa.array(np.full(limit, passed), pa.int32())
                yield rows(np.full(limit, held_cell), points[:limit], block)
                held, passed = [points[limit:]], passed + 1
    yield from flush()


def edges(spark: SparkSession, fps: DataFrame, max_bits: int = 3, block: int = BLOCK) -> DataFrame:
    """Edges whose components are those of "differ in at most ``max_bits`` bits".

    ``fps(fp)`` holds distinct fingerprints. Cells are dealt by hash and streamed sorted; a cell
    with more than ``block`` points is cut into blocks, and every pair of blocks becomes a task
    of its own, so no task holds more than two blocks and no link is lost.
    """
    width = shuffle_width(spark)
    emb = embedding(F.col("fp"))
    cells = fps.select("fp", F.explode(F.array(*[
        F.xxhash64(F.lit(i), emb.bitwiseAND(F.lit(m))) for i, m in enumerate(masks(max_bits))
    ])).alias("cell")).select("cell", "fp")
    schema = "a long, b long, block int"
    found = (cells.repartition(width, "cell").sortWithinPartitions("cell", "fp")
             .mapInArrow(partial(_runs, max_bits=max_bits, limit=block), schema))
    found = written(spark, found, "cells")
    direct = found.where("block is null").select("a", "b")
    over = found.where("block is not null").select(F.col("a").alias("cell"), F.col("b").alias("fp"), "block")
    last = over.groupBy("cell").agg(F.max("block").alias("last"))
    mine, other = F.col("block"), F.col("other")
    pairs = (over.join(last, "cell")
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
             .select(F.xxhash64("cell", F.least(mine, other), F.greatest(mine, other)).alias("cell"), "fp"))
    crossed = (pairs.repartition(width, "cell").sortWithinPartitions("cell", "fp")
               .mapInArrow(partial(_runs, max_bits=max_bits, limit=2 * block), schema))
    return direct.union(crossed.select("a", "b"))


def components_of(spark: SparkSession, docs: DataFrame, shingle: int = 3, max_bits: int = 3,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fp, component_id)`` of every row: the smallest id reachable over links."""
    bounded_batches(spark)
    prints = written(spark, fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    points = written(spark, prints.groupBy("fp").agg(F.min("id").alias("least")), "points")
    labels = written(spark, components(spark, edges(spark, points.select("fp"), max_bits)), "labels")
    named = points.join(labels, points.fp == labels.node, "left").select(
        "fp", "least", F.coalesce("label", "fp").alias("label"))
    roots = named.groupBy("label").agg(F.min("least").alias("component_id"))
    known = named.join(roots, "label").select("fp", "component_id")
    return prints.join(known, "fp").select("id", "fp", "component_id")


def near_dedup(spark: SparkSession, docs: DataFrame, shingle: int = 3, max_bits: int = 3,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each component the row with the smallest id.

    Rows that share that id are one document: of them the one whose JSON text is smallest stays.
    Rows with a null id cannot be named by a component and all stay.
    """
    found = components_of(spark, docs, shingle, max_bits, id_col, text_col)
    keep = (found.where("id = component_id").groupBy("id")
            .agg(F.count("*").alias("copies")).select(F.col("id").alias("kept_id"), "copies"))
    row_id = F.col("row").getField(id_col).cast("long")
    rows = packed(docs).select("row", row_id.alias("row_id"))
    held = rows.join(keep, F.col("row_id") == F.col("kept_id"))
    one = held.where("copies = 1").select("row")
    more = (held.where("copies > 1").groupBy("row_id")
            .agg(F.min_by("row", F.to_json("row")).alias("row")).select("row"))
    nameless = rows.where("row_id is null").select("row")
    return unpacked(one.union(more).union(nameless), docs.columns)
