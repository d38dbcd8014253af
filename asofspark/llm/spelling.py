"""Spelling variants: the vocabulary's minimised acceptor, a one-edit transducer and the acceptor again.

Two words are near when they differ by exactly one inserted, deleted or replaced code point. The
composition acceptor * one edit * acceptor accepts exactly the near pairs. It is enumerated for one
initial state at a time: all words that share what was read before form a partition.

* Partitions. Let m be the shorter length of a near pair. The edit leaves the first m // 2 code
  points of both words alone, or their last m - m // 2. So a word of length n goes, for m = n and
  m = n - 1, to the partition of the acceptor's state behind its first m // 2 code points, and to that of
  the reversed acceptor's state behind its last m - m // 2 ones. No near pair is lost.
* A partition of more than ``PARTITION`` words is refined the same way on what remains of its
  words, until it is small or one code point remains; what then shares a partition is near indeed,
  or an alphabet's size. No partition grows with the vocabulary.
* In a partition the remainders become a minimal acceptor (built from sorted words). At each of its
  states the transducer replaces, inserts or deletes, and both words go on with what the two
  states reached accept in common.

A word's form is its most frequent near word (ties: smallest in code-point order) when that is at
least ``ratio`` times as frequent as the word. Forms are followed to the last by doubling: a
form is ``ratio`` times as frequent as its word, so chains are short.

Cases: a null text holds no words. Equal words are counted over all rows, rows sharing an id included.
An empty table gives no rows. Words of any length are handled; nothing recurses on their length.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asofspark.llm.common import bounded_batches, text_of, written

MIN_CODES = 7
MIN_COUNT = 2
RATIO = 10
#: Words of a partition beyond which it is refined.
PARTITION = 4000
#: Distinct words a task counts before it passes the counts on.
REMEMBERED = 200_000
_RUN = "[A-Za-zÀ-ÿ]"


# ---- words ---------------------------------------------------------------------------------------

def vocabulary(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_codes: int = MIN_CODES,
               min_count: int = MIN_COUNT,
               edit: Callable[[int | None, str], str] | None = None) -> DataFrame:
    """``(word, n)``: lower-cased maximal runs of letters with at least ``min_codes`` code points and
    ``min_count`` occurrences. ``edit`` may shorten or change a run of a document, never lengthen it.
    """
    # a shorter run cannot give a word, so only runs that can are looked at
    pattern = re.compile(_RUN + "{%d,}" % min_codes)
    slim = docs.select(docs[id_col].cast("long").alias("id"), text_of(docs, text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.record_batch([pa.array(list(total.keys()), pa.string()), pa.array(list(total.values()), pa.int64())],
                                    names=["word", "n"])
            total.clear()
            return batch

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                # bytes.lower() changes A-Z only
                found = Counter(pattern.findall(text.as_py().encode().lower().decode()))
                if edit is not None:
                    for w, n in found.items():
                        total[edit(doc_id, w)] += n
                else:
                    total.update(found)
                if len(total) > REMEMBERED:
                    yield out()
        yield out()

    counted = slim.mapInArrow(run, "word string, n long").where(F.length("word") >= min_codes)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# ---- acceptor and composition ----------------------------------------------------------------------

class Acceptor:
    """The minimal acyclic acceptor of sorted distinct words: arcs and finality per state."""

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = [{}]
        self.final = [False]
        register: dict[tuple, int] = {}
        path, last = [0], ""  # states along the last word, none of them merged yet
        for w in [*words, None]:
            shared = 0
            if w is not None:
                while shared < len(last) and shared < len(w) and last[shared] == w[shared]:
                    shared += 1
            for k in range(len(last) - 1, shared - 1, -1):  # from the end: equal states become one
                s = path[k + 1]
                key = (self.final[s], tuple(self.arcs[s].items()))
                same = register.setdefault(key, s)
                self.arcs[path[k]][last[k]] = same
            if w is None:
                break
            del path[shared + 1:]
            for c in w[shared:]:
                self.arcs.append({}), self.final.append(False)
                self.arcs[path[-1]][c] = len(self.arcs) - 1
                path.append(len(self.arcs) - 1)
            self.final[path[-1]] = True
            last = w

    def common(self, a: int, b: int) -> list[str]:
        """All words that both states accept."""
        found, todo = [], [(a, b, "")]
        while todo:
            a, b, read = todo.pop()
            if self.final[a] and self.final[b]:
                found.append(read)
            x, y = self.arcs[a], self.arcs[b]
            if len(y) < len(x):
                x, y = y, x
            for c, s in x.items():
                t = y.get(c)
                if t is not None:
                    todo.append((s, t, read + c))
        return found

    def one_edit_pairs(self) -> Iterator[tuple[str, str]]:
        """The pairs accepted by acceptor * one edit * acceptor: the longer, or smaller, word first."""
        edits: dict[int, list[tuple[str, str]]] = {}  # what an edit at a state leads to
        todo = [(0, "")]
        while todo:
            s, read = todo.pop()
            if s not in edits:
                arcs, here = sorted(self.arcs[s].items()), []
                for k, (c, t) in enumerate(arcs):
                    here += [(c + rest, rest) for rest in self.common(t, s)]
                    for d, u in arcs[k + 1:]:
                        here += [(c + rest, d + rest) for rest in self.common(t, u)]
                edits[s] = here
            for x, y in edits[s]:
                yield read + x, read + y
            for c, t in self.arcs[s].items():
                todo.append((t, read + c))


# ---- partitions ------------------------------------------------------------------------------------

def _halved(df: DataFrame, rest: Column, m: Column, key: Column) -> DataFrame:
    """Each row twice: ``key`` for the first m // 2 code points of ``rest``, and for the last of it;
    what remains is the new ``rest`` with its shorter length ``m``."""
    first = m - F.expr("m div 2")
    head = F.struct(F.concat_ws("|", key, F.lit("L"), m.cast("string"), F.substr(rest, F.lit(1), m - first)).alias("key"),
                    F.substr(rest, m - first + 1).alias("rest"), first.alias("m"))
    tail = F.struct(F.concat_ws("|", key, F.lit("R"), m.cast("string"), F.substr(rest, F.length(rest) - first + 1)).alias("key"),
                    F.substr(rest, F.lit(1), F.length(rest) - first).alias("rest"), (m - first).alias("m"))
    return df.withColumn("half", F.explode(F.array(head, tail))).select("word", "half.key", "half.rest", "half.m")


def near_pairs(spark: SparkSession, words: DataFrame, *, partition: int = PARTITION) -> DataFrame:
    """``(a, b)``: every pair of near words of ``words(word)``, each once."""
    n = F.length("word")
    rows = words.select("word", F.explode(F.array(n, n - 1)).alias("m")).withColumn("rest", F.col("word"))
    rows = _halved(rows, F.col("rest"), F.col("m"), F.lit(""))
    parts = []
    while True:
        rows = written(spark, rows, "spelling-rows")
        sizes = rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
        sizes = written(spark, sizes, "spelling-sizes")
        big = sizes.where((F.col("size") > partition)).select("key")
        # with one code point left or none, a partition cannot be larger than a few alphabets
        too_big = rows.join(big, "key", "left_semi").where("m > 1")
        small = rows.join(sizes, "key").where((F.col("size") <= partition) | (F.col("m") <= 1))
        parts.append(small.select("word", "key", "rest", "m"))
        if too_big.isEmpty():
            break
        rows = _halved(too_big, F.col("rest"), F.col("m"), F.col("key"))

    def pairs(key: str, words: list[str], rests: list[str]) -> Iterator[tuple[str, str]]:
        if len(words) < 2:
            return
        name = dict(zip(rests, words, strict=True))
        for x, y in Acceptor(sorted(name)).one_edit_pairs():
            yield name[x], name[y]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, words, rests, a, b = None, [], [], [], []
        for batch in batches:
            for k, w, r in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                if k != key:
                    for x, y in pairs(key, words, rests):
                        a.append(min(x, y)), b.append(max(x, y))
                    key, words, rests = k, [], []
                words.append(w), rests.append(r)
            if len(a) > 10_000:
                yield pa.record_batch([pa.array(a, pa.string()), pa.array(b, pa.string())], names=["a", "b"])
                a, b = [], []
        for x, y in pairs(key, words, rests):
            a.append(min(x, y)), b.append(max(x, y))
        yield pa.record_batch([pa.array(a, pa.string()), pa.array(b, pa.string())], names=["a", "b"])

    every = parts[0]
    for p in parts[1:]:
        every = every.union(p)
    dealt = every.repartition("key").sortWithinPartitions("key").select("key", "word", "rest")
    return dealt.mapInArrow(run, "a string, b string").distinct()


def spelling_groups(spark: SparkSession, words: DataFrame, *, ratio: int = RATIO, partition: int = PARTITION) -> DataFrame:
    """One row per word of ``words(word, n)``: word, n, n_near, form, form_n, root."""
    bounded_batches(spark)
    words = written(spark, words.select("word", "n"), "spelling-words")
    pairs = near_pairs(spark, words, partition=partition)
    both = written(spark, pairs.union(pairs.select("b", "a")), "spelling-pairs").toDF("word", "near")
    known = both.join(words.toDF("near", "near_n"), "near")
    # most frequent first, then smallest: the least struct
    best = known.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus_n"), "near")).alias("best"))
    found = words.join(best, "word", "left")
    takes = -F.col("best.minus_n") >= ratio * F.col("n")
    found = written(spark, found.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(takes, F.col("best.near")).alias("form"),
        F.when(takes, -F.col("best.minus_n")).alias("form_n")), "spelling-forms")
    roots = found.where("form is not null").select("word", F.col("form").alias("root"))
    while True:  # root of the root: the way doubles in every round
        roots = written(spark, roots, "spelling-roots")
        on = roots.toDF("root", "next")
        step = roots.join(on, "root")
        if step.isEmpty():
            break
        roots = roots.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return found.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
