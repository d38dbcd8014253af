"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asofspark.session import scratch_path

#: ``[\x20\x09-\x0D]+`` as a Java regular expression.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
_BATCH_BYTES = 8 << 20


def text_of(df: DataFrame, name: str = "text") -> Column:
    """The text column; a null text is the empty text."""
    return F.coalesce(df[name].cast("string"), F.lit(""))


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back.

    Cuts lineage with a copy every executor can read: a lost executor costs a re-read, and
    every reader sees the same rows.
    """
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def packed(df: DataFrame) -> DataFrame:
    """All columns in one struct ``row``: names of the caller cannot clash with an operator's."""
    return df.select(F.struct(*[df[c] for c in df.columns]).alias("row"))


def unpacked(df: DataFrame, columns: list[str]) -> DataFrame:
    """The caller's columns back from ``row``."""
    return df.select(*[F.col("row").getField(c).alias(c) for c in columns])


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes as well as rows: texts may be very long."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(key, str(min(_BATCH_BYTES, int(spark.conf.get(key, str(_BATCH_BYTES))))))


def shuffle_width(spark: SparkSession) -> int:
    """The session's shuffle width: what the cluster is sized for."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def fresh(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"
