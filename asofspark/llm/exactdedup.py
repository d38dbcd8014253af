"""Exact dedup by progressive refinement, in DataFrame functions only.

Texts are equal when identical after every run of ``[\\x20\\x09-\\x0D]`` becomes one space. Rows
are grouped by the normalised length; rows that share a length by length and a hash of a prefix;
and only rows that still share both by the SHA-256 of the whole text. A text never leaves the task that
reads it: what is grouped, joined and shuffled are some sixty bytes a row, kept as a table.

Which texts are hashed in full must be known where they are read. The surviving (length, prefix) pairs set
bits of a table of at most ``WORDS`` words of 64, whatever their number, which is broadcast; a text whose bit
is not set is not hashed. A bit set by another pair costs one hash and changes nothing, since groups
are joined by their pairs. Callers that need every text's digest anyway (``digests``) get them from one scan,
and the refinement works on these.

Group sizes come from aggregates, which combine before the shuffle, and go back to the rows by
joins of small rows, whose skewed partitions Spark splits: one group may hold a third of all rows.

Cases: a null text counts as empty, and empty texts are equal to each other. Rows that
share an id and are equal all name that id as the one that stays, and all count as kept. A null
id comes after all others: it stays only in a group of null ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asofspark.llm.common import SPACE, text_of, written

PREFIX = 64
#: Words of the table that says which texts are hashed in full (some 8 MB when broadcast).
WORDS = 1 << 18


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACE, " ")


def full_hash(text: Column) -> Column:
    """Lowercase hexadecimal SHA-256 of the normalised text's UTF-8 bytes."""
    return F.sha2(normalised(text).cast("binary"), 256)


def _survivors(rows: DataFrame) -> DataFrame:
    """``(len, head)`` that more than one row has, by way of the lengths that more than one row has."""
    lengths = rows.groupBy("len").agg(F.count("*").alias("n")).where("n > 1").select("len")
    by_head = rows.select("len", "head").join(lengths, "len", "left_semi")
    return by_head.groupBy("len", "head").agg(F.count("*").alias("n")).where("n > 1").select("len", "head")


def _word(words: int) -> Column:
    """Of a (len, head) pair: its word in the table."""
    return F.pmod(F.shiftrightunsigned(F.xxhash64("len", "head"), 6), F.lit(words))


def _bit() -> Column:
    """Of a (len, head) pair: its bit in the word."""
    return F.expr("shiftleft(cast(1 as bigint), cast(pmod(xxhash64(len, head), 64) as int))")


def exact_dedup(spark: SparkSession, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                prefix: int = PREFIX, digests: bool = False, words: int = WORDS) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, and with ``digests`` text_sha256."""
    slim = docs.select(docs[id_col].cast("long").alias("id"), text_of(docs, text_col).alias("text"))
    norm = normalised(F.col("text"))
    keyed = slim.select("id", "text", F.length(norm).alias("len"), F.xxhash64(F.substring(norm, 1, prefix)).alias("head"))
    if digests:
        small = written(spark, keyed.select("id", "len", "head", full_hash(F.col("text")).alias("full")), "exact")
        heads = _survivors(small)
    else:
        heads = _survivors(written(spark, keyed.select("len", "head"), "exact-heads"))
        heads = written(spark, heads, "exact-survivors")
        bits = heads.select(_word(words).alias("word"), _bit().alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
        marked = keyed.withColumn("word", _word(words)).join(F.broadcast(bits), "word", "left")  # at most ``words`` rows
        full = F.when(F.coalesce(F.col("bits").bitwiseAND(_bit()), F.lit(0)) != 0, full_hash(F.col("text")))
        small = written(spark, marked.select("id", "len", "head", full.alias("full")), "exact")
    left = small.join(heads, ["len", "head"], "left_semi")
    groups = (left.groupBy("len", "head", "full").agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size"))
              .where("group_size > 1"))
    out = small.join(groups, ["len", "head", "full"], "left")
    alone = F.col("group_size").isNull()
    out = out.select("id", F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
                     F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                     *([F.col("full").alias("text_sha256")] if digests else []))
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id")))
