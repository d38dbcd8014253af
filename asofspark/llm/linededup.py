"""Line dedup through a deletion-neighbourhood join.

Lines are compared as sequences of lower-cased words. A line goes when an earlier line is equal
to it, or, for lines of at least ``near_words`` words, when an earlier line lies within one edit
(a word inserted, deleted or replaced). "Earlier" is by (id, line number); whether the earlier
line stays itself does not matter, so the outcome does not depend on any processing order.
Blank lines, those of fewer than ``min_words`` = 1 words, are left alone. In a line of ``near_words`` = 5
words one edit leaves a similarity of 0.8; shorter lines go for equality only.

The join: a line emits its deletion variants, the line without its i-th word, as hashed keys.

* Two lines within one replacement share a variant and its position i. All lines that share
  both are within one replacement of each other, so every one but the earliest links to the
  earliest: a star, never all pairs.
* Of two lines one deletion apart, one is a variant of the other: variants join whole lines.

Links are then verified word by word. Variants are emitted only for distinct lines that share
half of their words in place with another line: one edit leaves the first or the last half of the
shorter line untouched, so no pair is lost (pigeonhole).

Cases: a null text has no lines and stays null; an empty text is one line of no words. Rows sharing id and text
are one document; rows sharing the id with different texts are ordered by the texts' hash. Null
ids come first. A document that had lines to lose and lost all of them goes; one that had
none to lose stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asofspark.llm.common import bounded_batches, packed, unpacked, written

MIN_WORDS = 1
NEAR_WORDS = 5
#: Distinct candidate lines whose keys are broadcast (some 40 MB in memory); more are shuffled.
BROADCAST_LINES = 500_000
_M64 = (1 << 64) - 1


def words_of(line: str) -> list[bytes]:
    """Lower-cased (A-Z) words between runs of ``[\\x20\\x09-\\x0D]``."""
    return line.encode().lower().split()


def _two(data: bytes) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(data)
    return h >> 64, h & _M64


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, dtype=np.uint64).view(np.int64))


def line_key(words: list[bytes]) -> tuple[int, int]:
    return _two(b" ".join(words))


def halves(words: list[bytes]) -> list[int]:
    """Keys of the halves in place, for partners of the same length and one word shorter."""
    n, out = len(words), []
    for m in (n, n - 1):
        h = m // 2
        out.append(xxhash.xxh3_64_intdigest(b"%d L " % m + b" ".join(words[:h])))
        out.append(xxhash.xxh3_64_intdigest(b"%d R " % m + b" ".join(words[n - (m - h):])))
    return out


def _text_key(text: Column) -> Column:
    """Hash of a text; null without one."""
    return F.when(text.isNotNull(), F.xxhash64(text))


def _slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text")) \
        .withColumn("text_key", _text_key(F.col("text")))


def line_table(docs: DataFrame, near_words: int) -> DataFrame:
    """``(id, text_key, line_no, n, h1, h2, halves)`` of every line of ``docs(id, text, text_key)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, no, n, h1, h2, near = [], [], [], [], [], []
            for i, text in enumerate(b.column(1)):
                for k, line in enumerate(text.as_py().split("\n")):
                    words = words_of(line)
                    x, y = line_key(words)
                    row.append(i), no.append(k), n.append(len(words)), h1.append(x), h2.append(y)
                    near.append([v - (1 << 64) if v >> 63 else v for v in halves(words)]
                                if len(words) >= near_words else None)
            at = pa.array(row, pa.int32())
            yield pa.record_batch(
                [b.column(0).take(at), b.column(2).take(at), pa.array(no, pa.int32()), pa.array(n, pa.int32()),
                 _signed(h1), _signed(h2), pa.array(near, pa.list_(pa.int64()))],
                names=["id", "text_key", "line_no", "n", "h1", "h2", "halves"])

    return docs.mapInArrow(run, "id long, text_key long, line_no int, n int, h1 long, h2 long, halves array<long>")


_BASE = 0x9E3779B97F4A7C15 | 1
_BACK = np.uint64(pow(_BASE, -1, 1 << 64))


def variants(words: list[bytes]) -> np.ndarray:
    """Keys of the line without its i-th word, for every i, and last of the whole line.

    A polynomial over the words' hashes modulo 2^64: running sums give every variant in linear
    time, and a line equal to another's variant has that variant's key. Keys only propose
    links, which are verified.
    """
    n = len(words)
    h = np.array([xxhash.xxh3_64_intdigest(w) for w in words], dtype=np.uint64)
    power = np.ones(n, np.uint64)
    power[1:] = np.cumprod(np.full(max(n - 1, 0), _BASE, np.uint64))
    head = np.r_[np.uint64(0), np.cumsum(h * power)]  # words before i
    tail = head[n] - head[1:]  # words after i, one power too high
    keys = np.r_[head[:n] + tail * _BACK, head[n]]
    lengths = np.r_[np.full(n, n - 1), n].astype(np.uint64)
    return ((keys ^ (keys >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + lengths).view(np.int64)


def within_one_edit(a: list[bytes], b: list[bytes]) -> bool:
    """At most one word inserted, deleted or replaced."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1:
        return False
    i = 0
    while i < len(b) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i + 1:] == b[i:]


def _candidate_lines(spark: SparkSession, docs: DataFrame, lines: DataFrame, near_words: int) -> DataFrame:
    """``(h1, h2, line)`` of each distinct line that shares a half with another one."""
    keyed = lines.where("halves is not null").select("h1", F.explode("halves").alias("half"))
    shared = (keyed.groupBy("half").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi"))
              .where("lo <> hi").select("half"))
    wanted = written(spark, keyed.join(shared, "half", "left_semi").select("h1").distinct(), "candidates")
    few = wanted.count() <= BROADCAST_LINES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h1, h2, found = [], [], []
            for text in b.column(0):
                for line in text.as_py().split("\n"):
                    words = words_of(line)
                    if len(words) >= near_words:
                        x, y = line_key(words)
                        h1.append(x), h2.append(y), found.append(b" ".join(words).decode())
            yield pa.record_batch([_signed(h1), _signed(h2), pa.array(found, pa.string())], names=["h1", "h2", "line"])

    texts = docs.select("text").mapInArrow(run, "h1 long, h2 long, line string")
    texts = texts.join(F.broadcast(wanted) if few else wanted, "h1", "left_semi")
    return texts.groupBy("h1", "h2").agg(F.first("line").alias("line"))


def near_links(spark: SparkSession, docs: DataFrame, lines: DataFrame, distinct: DataFrame, near_words: int) -> DataFrame:
    """``(h1, h2)`` of the distinct lines that have an earlier line within one edit."""
    found = _candidate_lines(spark, docs, lines, near_words)
    # a candidate's rank ascends with its place: it orders the line and names it
    place = ["id", "text_key", "line_no"]
    ranked = (found.join(distinct, ["h1", "h2"]).repartitionByRange(*place).sortWithinPartitions(*place)
              .select(F.monotonically_increasing_id().alias("rank"), "h1", "h2", "line"))
    ranked = written(spark, ranked, "near-lines")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, 512):
                part = b.slice(s, 512)
                keys = [variants(line.as_py().encode().split()) for line in part.column(1)]
                at = np.repeat(np.arange(part.num_rows), [len(k) for k in keys])
                gone = [np.r_[np.arange(len(k) - 1), -1] for k in keys]
                yield pa.record_batch([pa.array(np.concatenate(keys)), pa.array(np.concatenate(gone), pa.int32()),
                                       part.column(0).take(pa.array(at))], names=["v", "i", "rank"])

    keys = written(spark, ranked.select("rank", "line").mapInArrow(run, "v long, i int, rank long"), "variants")
    # lines that share a variant and its place: a star around the earliest
    subs = (keys.where("i >= 0").groupBy("v", "i").agg(F.min("rank").alias("first"), F.count("*").alias("n"))
            .where("n > 1").drop("n"))
    stars = keys.where("i >= 0").join(subs, ["v", "i"]).select("rank", "first")
    # a whole line that is another's variant
    met = (keys.groupBy("v").agg(F.min(F.when(F.col("i") >= 0, F.col("rank"))).alias("least"),
                                 F.max(F.when(F.col("i") < 0, F.col("rank"))).alias("whole"))
           .where("least is not null and whole is not null"))
    shorter = met.select(F.col("whole").alias("rank"), F.col("least").alias("first"))
    longer = keys.where("i >= 0").join(met, "v").select("rank", F.col("whole").alias("first"))
    links = stars.union(shorter).union(longer).where("first < rank").groupBy("rank").agg(F.min("first").alias("first"))
    earlier = ranked.select(F.col("rank").alias("first"), F.col("line").alias("earlier"))
    both = links.join(ranked, "rank").join(earlier, "first").select("h1", "h2", "line", "earlier")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [within_one_edit(x.as_py().encode().split(), y.as_py().encode().split())
                  for x, y in zip(b.column(2), b.column(3), strict=True)]
            yield pa.record_batch([b.column(0), b.column(1)], names=["h1", "h2"]).filter(pa.array(ok, pa.bool_()))

    return both.mapInArrow(verify, "h1 long, h2 long")


def dropped_lines(spark: SparkSession, docs: DataFrame, *, min_words: int = MIN_WORDS,
                  near_words: int = NEAR_WORDS) -> DataFrame:
    """``(id, text_key, lines, gone)`` of ``docs(id, text, text_key)``: the number of lines and the
    sorted numbers of those that go. Documents that lose none are absent.
    """
    bounded_batches(spark)
    docs = docs.where("text is not null")
    lines = written(spark, line_table(docs, near_words), "lines")
    place = F.struct("id", "text_key", "line_no")
    long = lines.where(F.col("n") >= min_words)
    first = long.groupBy("h1", "h2").agg(F.min(place).alias("first"))
    distinct = written(spark, first.select("h1", "h2", "first.id", "first.text_key", "first.line_no"), "distinct")
    near = near_links(spark, docs, lines, distinct, near_words).withColumn("near", F.lit(True))
    known = distinct.select("h1", "h2", F.struct("id", "text_key", "line_no").alias("first")).join(near, ["h1", "h2"], "left")
    gone = (long.select("id", "text_key", "line_no", "h1", "h2").join(known, ["h1", "h2"])
            .where(F.col("near") | (place > F.col("first"))).select("id", "text_key", "line_no"))
    return gone.groupBy("id", "text_key").agg(F.sort_array(F.collect_set("line_no")).alias("gone"))


def _cleaned(text, gone):
    kept = F.filter(F.split(text, "\n", -1), lambda line, i: ~F.array_contains(gone, i))
    return F.when(gone.isNull(), text).otherwise(F.array_join(kept, "\n"))


def _joined(spark: SparkSession, rows: DataFrame, gone: DataFrame) -> DataFrame:
    gone = gone.select(F.col("id").alias("g_id"), F.col("text_key").alias("g_key"), "gone")
    return rows.join(gone, F.col("id").eqNullSafe(F.col("g_id")) & (F.col("text_key") == F.col("g_key")), "left")


def report(spark: SparkSession, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
           min_words: int = MIN_WORDS, near_words: int = NEAR_WORDS) -> DataFrame:
    """One row per document: id, n_lines, gone (line numbers from 0), clean text (null of a null text)."""
    slim = _slim(docs, id_col, text_col)
    out = _joined(spark, slim, dropped_lines(spark, slim, min_words=min_words, near_words=near_words))
    return out.select("id", F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n", -1))).alias("n_lines"),
                      F.coalesce("gone", F.array().cast("array<int>")).alias("gone"),
                      _cleaned(F.col("text"), F.col("gone")).alias("clean"))


def line_dedup(spark: SparkSession, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
               min_words: int = MIN_WORDS, near_words: int = NEAR_WORDS) -> DataFrame:
    """``docs`` with the lines that go taken out of the text; documents left without any line go."""
    gone = dropped_lines(spark, _slim(docs, id_col, text_col), min_words=min_words, near_words=near_words)
    get = F.col("row").getField
    text = get(text_col).cast("string")
    rows = packed(docs).select("row", get(id_col).cast("long").alias("id"), _text_key(text).alias("text_key"))
    out = _joined(spark, rows, gone)
    left = F.size(F.split(text, "\n", -1)) - F.size("gone")
    out = out.where(F.col("gone").isNull() | (left > 0))
    return unpacked(out.select(F.when(F.col("gone").isNull(), F.col("row")).otherwise(
        F.col("row").withField(text_col, _cleaned(text, F.col("gone")))).alias("row")), docs.columns)
