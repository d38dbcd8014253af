"""Quality classifier by importance resampling.

Two bag-of-hashed-n-grams models are counted, one over the target texts (labelled as good) and
one over all raw texts. The log-weight of a text is the log ratio of its probability under the
two; adding Gumbel noise and taking the ``k`` largest keys draws ``k`` texts without replacement
in proportion to their weights. Texts that are not drawn are rejected.

Features are words and punctuation runs of the lower-cased text and their bigrams, hashed to
``buckets`` buckets. A word right after itself is written as a repeat mark, so that runs of any
word meet in the same buckets.

``k`` is, unless given, the number of texts whose log-weight is not negative, those that the
target explains at least as well as the raw text does; and at least ``share`` of all rows, the
share of good rows among the labelled ones. The second bound carries small label sets, under
which an uncertain model finds most texts a little less likely than the raw model does.

The target model is smoothed towards the raw one by ``PRIOR`` imagined features a bucket, so a
bucket that few target texts have met says little.

The raw model counts every text. The target model is fitted on at most ``max_targets`` labelled
rows, the ones with the smallest hashed id: the only bounded sample here, and what makes the id
set safe to broadcast. What reaches the driver is one row per bucket, and one per 16-bit digit
while the k-th largest key is found.

Cases: a null or blank text has no features, log-weight 0. Rows that share the id share their
noise; rows tied at the k-th key are all kept. Without labelled targets every weight is near the
same, and the draw is by noise. An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asofspark.llm.common import bounded_batches, text_of, unpacked, written

BUCKETS = 1 << 14
MAX_TARGETS = 20_000
PRIOR = 16
SEED = 7
_TOKEN = re.compile(rb"[0-9a-z\x80-\xff]+|[^\s0-9a-z\x80-\xff]+")
_MIX_A, _MIX_B, _MIX_C = (np.uint64(x) for x in (
    0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD))
_REPEAT = np.uint64(0x5BF03635)


def features(text: str, buckets: int = BUCKETS) -> np.ndarray:
    """Buckets of a text's words and bigrams, repeats included."""
    tokens = _TOKEN.findall(text.encode().lower())
    h = np.array(list(map(zlib.crc32, tokens)), dtype=np.uint64) * _MIX_A
    if not len(h):
        return np.zeros(0, np.int64)
    h[1:][h[1:] == h[:-1]] = _REPEAT
    pairs = (h[:-1] * _MIX_B + h[1:]) * _MIX_A
    keys = np.concatenate([h * _MIX_C, pairs])
    return ((keys >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def target_ids(labels: DataFrame, good, max_targets: int = MAX_TARGETS, id_col: str = "doc_id") -> DataFrame:
    """At most ``max_targets`` distinct ids that satisfy ``good``: those with the smallest hash."""
    ids = labels.where(good).select(labels[id_col].cast("long").alias("target_id")).dropna().distinct()
    return ids.orderBy(F.xxhash64("target_id"), "target_id").limit(max_targets)


def good_share(labels: DataFrame, good) -> float:
    """Share of the labelled rows that satisfy ``good``; 0 without labels."""
    return labels.agg(F.avg(F.coalesce(good, F.lit(False)).cast("double"))).first()[0] or 0.0


def log_ratios(spark: SparkSession, docs: DataFrame, targets: DataFrame, *, buckets: int = BUCKETS,
               id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """Per bucket log p(target) - log p(raw). One pass over all texts."""
    bounded_batches(spark)
    slim = docs.select(docs[id_col].cast("long").alias("id"), text_of(docs, text_col).alias("text"))
    flagged = slim.join(F.broadcast(targets), F.col("id") == F.col("target_id"), "left").select(
        "text", F.col("target_id").isNotNull().alias("hit"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, hits = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for b in batches:
            for text, hit in zip(b.column(0), b.column(1), strict=True):
                n = np.bincount(features(text.as_py(), buckets), minlength=buckets)
                raw += n
                if hit.as_py():
                    hits += n
        at = np.flatnonzero(raw)
        yield pa.record_batch([pa.array(at), pa.array(raw[at]), pa.array(hits[at])], names=["bucket", "raw", "hits"])

    sums = (flagged.mapInArrow(count, "bucket long, raw long, hits long")
            .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("hits").alias("hits")))
    raw, hits = np.zeros(buckets), np.zeros(buckets)
    for r in sums.collect():  # at most one row per bucket
        raw[r.bucket], hits[r.bucket] = r.raw, r.hits
    usual, prior = (raw + 1) / (raw.sum() + buckets), float(PRIOR * buckets)
    return np.log((hits + prior * usual) / (hits.sum() + prior)) - np.log(usual)


def gumbel(doc_id: int | None, seed: int) -> float:
    """Standard Gumbel noise, a function of the id and the seed."""
    u = (xxhash.xxh64_intdigest(repr(doc_id).encode(), seed=seed) + 0.5) / 2.0**64
    return float(-np.log(-np.log(u)))


def _sortable(key: np.ndarray) -> np.ndarray:
    """Signed integers in the order of the doubles."""
    bits = key.view(np.int64)
    return bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))


def weigh(docs: DataFrame, ratios: np.ndarray, carry: list[str], *, seed: int = SEED,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ``carry`` columns in ``row``, with log_weight, gumbel_key and its sortable ``rank``."""
    slim = docs.select(F.struct(*[docs[c] for c in carry]).alias("row"),
                       docs[id_col].cast("long").alias("id"), text_of(docs, text_col).alias("text"))
    buckets = len(ratios)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w = np.array([ratios[features(t.as_py(), buckets)].sum() for t in b.column(2)], np.float64)
            key = w + np.array([gumbel(i.as_py(), seed) for i in b.column(1)], np.float64)
            yield pa.record_batch([b.column(0), pa.array(w), pa.array(key), pa.array(_sortable(key))],
                                  names=["row", "log_weight", "gumbel_key", "rank"])

    schema = T.StructType([slim.schema["row"], T.StructField("log_weight", T.DoubleType()),
                           T.StructField("gumbel_key", T.DoubleType()), T.StructField("rank", T.LongType())])
    return slim.mapInArrow(run, schema)


def kth_largest(ranks: DataFrame, k: int) -> int:
    """The k-th largest ``rank``: four histograms of 16 bits each, from the top digit down."""
    prefix, left = None, k
    for shift in (48, 32, 16, 0):
        part = ranks if prefix is None else ranks.where(F.shiftright("rank", shift + 16) == prefix)
        digit = F.shiftright("rank", shift)
        counts = part.groupBy(digit.alias("digit")).agg(F.count("*").alias("n")).collect()  # <= 65536 rows
        for r in sorted(counts, key=lambda r: -r.digit):
            if left <= r.n:
                prefix = r.digit
                break
            left -= r.n
    return prefix


def _threshold(ranks: DataFrame, k: int | None, share: float) -> int | None:
    """The least rank drawn; None when nothing is."""
    total, natural = ranks.agg(F.count("*"), F.count_if(F.col("log_weight") >= 0)).first()
    k = max(natural, round(share * total)) if k is None else min(k, total)
    return kth_largest(ranks, k) if k > 0 else None


def resample(spark: SparkSession, docs: DataFrame, targets: DataFrame, *, k: int | None = None, share: float = 0.0,
             buckets: int = BUCKETS, seed: int = SEED, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """Every row's id, log_weight, gumbel_key and whether it is drawn (``kept``)."""
    ratios = log_ratios(spark, docs, targets, buckets=buckets, id_col=id_col, text_col=text_col)
    keys = weigh(docs, ratios, [id_col], seed=seed, id_col=id_col, text_col=text_col)
    keys = written(spark, keys.select(F.col("row").getField(id_col).cast("long").alias("id"),
                                      "log_weight", "gumbel_key", "rank"), "keys")
    least = _threshold(keys, k, share)
    kept = F.lit(False) if least is None else F.col("rank") >= F.lit(least)
    return keys.select("id", "log_weight", "gumbel_key", kept.alias("kept"))


def draw(spark: SparkSession, docs: DataFrame, targets: DataFrame, *, k: int | None = None, share: float = 0.0,
         buckets: int = BUCKETS, seed: int = SEED, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are drawn. Weights are computed again rather than moving texts."""
    ratios = log_ratios(spark, docs, targets, buckets=buckets, id_col=id_col, text_col=text_col)
    keys = weigh(docs, ratios, [id_col], seed=seed, id_col=id_col, text_col=text_col)
    least = _threshold(written(spark, keys.select("log_weight", "rank"), "keys"), k, share)
    if least is None:
        return docs.limit(0)
    drawn = weigh(docs, ratios, docs.columns, seed=seed, id_col=id_col, text_col=text_col)
    return unpacked(drawn.where(F.col("rank") >= F.lit(least)), docs.columns)
