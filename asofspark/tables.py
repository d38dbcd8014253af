"""Reading the driver's tables and the mappings that turn them into bitemporal inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a revised posting log: business key (day, user_id, event_type), posted at
    ``ts``; a key that repeats is a value that was published and then corrected."""
    e = read(spark, sf_dir, "events")
    return e.select(
        F.to_date("ts").alias("day"),
        "user_id",
        "event_type",
        F.col("ts").alias("posted_at"),
        "event_id",
        "value",
    )
