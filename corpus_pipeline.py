"""The training-data pipeline: quality classifier, line dedup, near-dedup, mixing, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and reread as the next one's ``docs``.

Cases: a null or empty text has no features, lines or words: the quality stage judges it like any text of
weight zero, line dedup leaves it as it is, null and empty texts have fingerprint zero and are
near-duplicates of one another, mixing repeats it at no cost in words, and packing gives it its end id alone.
Rows without an id all stay in near-dedup; a null source is a source of its own. Rows that share id and
text are judged alike, and one of their group stays. Columns beside those of ``documents`` are kept, whatever
their names. Without labelled good texts the target is the prior, all weights are equal and no text is
rejected for its words; an empty table goes through all stages empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asofspark.llm import importance, linededup, mixing, packing, simhash
from asofspark.llm.common import written
from asofspark.llm.tokens import word_bpe_path


def _recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the texts as they are now."""
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that importance resampling draws; the target is labelled good text."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    good = F.col("quality") == 1
    return importance.draw(spark, docs, importance.target_ids(labels, good), share=importance.good_share(labels, good))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take out lines that an earlier line repeats exactly or within one word."""
    return _recounted(linededup.line_dedup(spark, docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of linked fingerprints."""
    return simhash.near_dedup(spark, docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or thin out the sources to their target weights."""
    return _recounted(mixing.mix(spark, docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of fixed windows."""
    # the workers of earlier stages still hold memory: a smaller store of encoded words
    pieces = packing.pack(spark, docs, word_bpe_path(), end_id=1, remembered=400_000)
    return pieces.withColumn("length", (F.length("ids") / 4).cast("long"))


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("simhash near-dedup", near_duplicates),
    ("mixing", mixture),
    ("packing", packed),
]

#: SQL has neither the hashed models and keys nor the tokenizer; see tests/llm for brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = written(spark, stage(spark, docs, sf_dir), f"stage{k + 1}")
    return docs
