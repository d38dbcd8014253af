"""Compaction reads every batch's own schema: nothing off the contract is merged or deleted."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from asofspark.operators import pit
from asofspark.plans import compact as CP
from asofspark.session import scratch_path
from asofspark.sources import lake as LK

NOW = "2100-01-01 00:00:00"
COLUMNS = ("interval_start timestamp_ntz, interval_minutes int, posted_at timestamp_ntz, ingested_at timestamp_ntz, "
           "source string, schema_version int, dst_flag boolean, series string, value double")


def rows(spark, posted, values, product="p"):
    return spark.createDataFrame([(product, posted, float(v)) for v in values], "product string, posted string, value double").select(
        "product", F.lit("2024-01-05 12:00:00").cast("timestamp_ntz").alias("interval_start"), F.lit(60).alias("interval_minutes"),
        F.col("posted").cast("timestamp_ntz").alias("posted_at"), F.col("posted").cast("timestamp_ntz").alias("ingested_at"),
        F.lit("archive").alias("source"), F.lit(1).alias("schema_version"), F.lit(False).alias("dst_flag"),
        F.concat(F.lit("s"), F.col("value").cast("string")).alias("series"), "value")


def batches(spark, root, product):
    return {r.batch for r in spark.read.parquet(f"{root}/curated").filter(F.col("product") == product).select("batch").distinct().collect()}


@pytest.mark.parametrize("damage", ["extra", "type", "missing", "null"])
@pytest.mark.parametrize("declared", [True, False])
def test_odd_partitions_are_skipped_whole(spark, damage, declared):
    root = scratch_path(spark, "odd")
    LK.write_curated(LK.with_batch(rows(spark, "2024-01-05 13:00:00", [1, 2])), root)
    odd = LK.with_batch(rows(spark, "2024-01-05 14:00:00", [3]))
    odd = {"extra": lambda: odd.withColumn("note", F.lit("kept")),
           "type": lambda: odd.withColumn("value", F.col("value").cast("string")),
           "missing": lambda: odd.drop("dst_flag"),
           "null": lambda: odd.withColumn("source", F.lit(None).cast("string"))}[damage]()
    LK.write_curated(odd, root)
    for posted, v in (("2024-01-05 13:00:00", 7), ("2024-01-05 14:00:00", 8)):
        LK.write_curated(LK.with_batch(rows(spark, posted, [v], "q")), root)
    contract = dict.fromkeys("pq", COLUMNS) if declared else None
    out = {r.product: r for r in CP.compact(spark, root, now=NOW, key=["interval_start", "series"], contract=contract).collect()}
    assert (out["p"].skipped, out["p"].partitions, out["p"].rows) == (1, 0, 0)
    assert (out["q"].skipped, out["q"].partitions, out["q"].batches_in, out["q"].rows) == (0, 1, 2, 2)
    assert batches(spark, root, "p") == {"part-20240105T130000Z", "part-20240105T140000Z"}
    assert batches(spark, root, "q") == {"merged-21000101T000000Z"}
    if damage == "extra":
        path = f"{root}/curated/product=p/date=2024-01-05/batch=part-20240105T140000Z"
        assert [r.note for r in spark.read.parquet(path).collect()] == ["kept"]


def test_whole_partitions_against_a_declaration_they_do_not_meet(spark):
    root = scratch_path(spark, "odd")
    for posted in ("2024-01-05 13:00:00", "2024-01-05 14:00:00"):
        LK.write_curated(LK.with_batch(rows(spark, posted, [1]).withColumn("more", F.lit(1))), root)
    out = CP.compact(spark, root, now=NOW, key=["interval_start", "series"], contract={"p": COLUMNS}).collect()
    assert [(r.skipped, r.partitions) for r in out] == [(1, 0)] and len(batches(spark, root, "p")) == 2
    out = CP.compact(spark, root, now=NOW, key=["interval_start", "series"]).collect()
    assert [(r.skipped, r.partitions, r.rows) for r in out] == [(0, 1, 2)]
    assert "more" in spark.read.parquet(f"{root}/curated").columns


def test_leftovers_of_an_interrupted_run_go_once(spark):
    root = scratch_path(spark, "left")
    parts = [rows(spark, "2024-01-05 13:00:00", [1, 1, 2]), rows(spark, "2024-01-05 14:00:00", [3])]
    for p in parts:
        LK.write_curated(LK.with_batch(p), root)
    both = LK.with_batch(parts[0].union(parts[1])).withColumn("batch", F.lit("merged-20240106T000000Z"))
    LK.write_curated(both, root)
    out = CP.compact(spark, root, now=NOW, key=["interval_start", "series"]).collect()
    assert [(r.leftovers, r.rows) for r in out] == [(2, 4)]
    assert batches(spark, root, "p") == {"merged-21000101T000000Z"}


def test_nothing_outside_the_lake_is_deleted(spark):
    dirs = spark.createDataFrame([("/tmp/elsewhere/product=p",)], "dir string")
    with pytest.raises(ValueError, match="outside"):
        LK.delete_dirs(dirs, "/tmp/lake/curated")


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 59), st.lists(st.integers(0, 4), min_size=1, max_size=5)), min_size=2, max_size=5,
                unique_by=lambda x: x[0]))
def test_answers_stay(spark, postings):
    root = scratch_path(spark, "same")
    for minute, values in postings:
        LK.write_curated(LK.with_batch(rows(spark, f"2024-01-05 13:{minute:02d}:00", values)), root)

    def answers():
        lake = spark.read.parquet(f"{root}/curated")
        every = sorted(map(str, lake.drop("batch").collect()))
        asof = [sorted(map(str, pit.latest_as_of(lake.drop("batch"), key=["interval_start", "series"], posted="posted_at",
                                                 tie="ingested_at", as_of=f"2024-01-05 13:{m}:00").collect())) for m in ("20", "40")]
        return every, asof

    before = answers()
    CP.compact(spark, root, now=NOW, key=["interval_start", "series"])
    assert answers() == before and len(batches(spark, root, "p")) == 1
