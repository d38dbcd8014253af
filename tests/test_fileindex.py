"""Zone maps: the same rows from fewer files."""

import datetime as dt
from urllib.parse import urlparse

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from asofspark.plans import compact as CP
from asofspark.plans.read import Lake
from asofspark.session import scratch_path
from asofspark.sources import fileindex as FI
from asofspark.sources import lake as LK
from asofspark.sources import snapshots as SN

DAY = dt.date(2024, 1, 10)


def utc(*at):
    return dt.datetime(2024, 1, *at, tzinfo=dt.UTC)


@given(st.sets(st.text(max_size=8), max_size=60), st.text(max_size=8))
def test_bloom_filters_hold_their_names(names, other):
    data = FI.bloom(names)
    assert all(FI.may_hold(data, [n]) for n in names) and not FI.may_hold(data, [])
    assert FI.may_hold(data, [other, *names]) == bool(names) or FI.may_hold(data, [other])


def test_bloom_filters_leave_most_others_out():
    data = FI.bloom({f"a{k}" for k in range(1000)})
    assert sum(FI.may_hold(data, [f"b{k}"]) for k in range(2000)) < 20


@pytest.fixture(scope="module")
def root(spark):
    """Six batches, one an hour: hours 10 + k, posted at k, with two points of their own each and a shared one."""
    root = scratch_path(spark, "index")
    for k in range(6):
        df = spark.range(30).select(
            F.lit("p").alias("product"),
            (F.lit(f"2024-01-10 {10 + k}:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id").cast("int"))).alias("interval_start"),
            F.lit(5).alias("interval_minutes"), F.lit(f"2024-01-10 {k:02d}:00:00").cast("timestamp_ntz").alias("posted_at"),
            F.lit("2024-01-11 00:00:00").cast("timestamp_ntz").alias("ingested_at"), F.lit("archive").alias("source"),
            F.lit(1).alias("schema_version"),
            F.when(F.col("id") % 3 == 0, "shared").otherwise(F.concat(F.lit(f"s{k}-"), (F.col("id") % 3).cast("string"))).alias("series"),
            F.when(F.col("id") % 5 > 0, F.col("id").cast("double")).alias("value"), F.lit(False).alias("dst_flag"))
        LK.write_curated(LK.with_batch(df), root)
    SN.start(spark, root)
    return root


def rows(df):
    return sorted(map(tuple, df.select("interval_start", "series", "posted_at", "value").collect()), key=str)


def test_reads_open_only_files_that_may_hold_rows(spark, root):
    lake = Lake(spark, root, {"p": "series"})
    reads = [({}, (utc(10, 6), utc(11, 6)), utc(11), 6), ({}, (utc(10, 12), utc(10, 13)), utc(11), 1),
             ({}, (utc(10, 6), utc(11, 6)), utc(10, 2), 3), ({"names": ["s4-1"]}, (utc(10, 6), utc(11, 6)), utc(11), 1),
             ({"names": ["shared"]}, (utc(10, 6), utc(11, 6)), utc(11), 6), ({"names": ["s1-1", "s2-2"]}, (utc(10, 6), utc(11, 6)), utc(10, 1), 1),
             ({"names": ["nobody"]}, (utc(10, 6), utc(11, 6)), utc(11), 0), ({}, (utc(10, 6), utc(10, 7)), utc(11), 0)]
    want = [rows(lake.by_range("p", *span, as_of=as_of, **names)) for names, span, as_of, _ in reads]
    every = [rows(lake.postings("p", *span, as_of=as_of, **names)) for names, span, as_of, _ in reads]
    assert FI.update(spark, root) == 6 and FI.update(spark, root) == 0
    for (names, span, as_of, opened), w, e in zip(reads, want, every, strict=True):
        assert lake.files("p", *span, as_of=as_of, **names) == (opened, 6)
        assert rows(lake.by_range("p", *span, as_of=as_of, **names)) == w
        assert rows(lake.postings("p", *span, as_of=as_of, **names)) == e
        assert (len(lake.by_range("p", *span, as_of=as_of, **names).inputFiles()) == opened) or not opened


def test_statistics_of_an_entry(spark, root):
    path = LK.list_files(spark, f"{root}/curated").orderBy("path").first().path
    e = FI.file_entry(path)
    assert (e["n_rows"], e["lo_version"], e["hi_version"], e["nulls"]["posted_at"]) == (30, 1, 1, 0)
    assert e["lo_interval"] == dt.datetime(2024, 1, 10, 10) and e["hi_interval"] == dt.datetime(2024, 1, 10, 10, 29)
    assert FI.may_hold(e["names"], ["shared"]) and not FI.may_hold(e["names"], ["s5-1"])


def test_files_without_statistics_and_unindexed_directories_are_opened(spark):
    root = scratch_path(spark, "index2")
    table = pa.table({"interval_start": pa.array([dt.datetime(2024, 1, 10, 12)], pa.timestamp("us")), "interval_minutes": pa.array([5], pa.int32()),
                      "posted_at": pa.array([dt.datetime(2024, 1, 10)], pa.timestamp("us")),
                      "ingested_at": pa.array([dt.datetime(2024, 1, 10)], pa.timestamp("us")), "source": ["a"],
                      "schema_version": pa.array([1], pa.int32()), "series": ["x"], "value": [1.0], "dst_flag": [False]})
    fs, p = LK._fs(spark, f"{root}/curated/product=p/date=2024-01-10/batch=part-20240110T000000Z")
    fs.mkdirs(p)
    pq.write_table(table, urlparse(f"{root}/curated/product=p/date=2024-01-10/batch=part-20240110T000000Z/a.parquet").path, write_statistics=False)
    SN.start(spark, root)
    FI.update(spark, root)
    lake = Lake(spark, root, {"p": "series"})
    span = (utc(10, 20), utc(10, 21))
    assert lake.files("p", *span, as_of=utc(11)) == (1, 1) and lake.by_range("p", *span, as_of=utc(11)).count() == 0
    new = spark.createDataFrame([("p", DAY, "part-20240110T010000Z")], "product string, date date, batch string")
    fs, p = LK._fs(spark, f"{root}/curated/product=p/date=2024-01-10/batch=part-20240110T010000Z")
    fs.mkdirs(p)
    pq.write_table(table, urlparse(f"{root}/curated/product=p/date=2024-01-10/batch=part-20240110T010000Z/b.parquet").path)
    SN.commit(spark, root, new)
    assert lake.files("p", *span, as_of=utc(11)) == (2, 2)  # not in the index: opened
    assert FI.update(spark, root) == 1
    assert lake.files("p", *span, as_of=utc(11)) == (1, 2)
    assert lake.files("p", utc(10, 11), utc(10, 13), as_of=utc(11), names=["x"]) == (2, 2)


def test_compaction_keeps_the_index(spark, root):
    FI.update(spark, root)
    lake = Lake(spark, root, {"p": "series"})
    want = rows(lake.postings("p", utc(10, 6), utc(11, 6), as_of=utc(11)))
    CP.compact(spark, root, now="2100-01-01 00:00:00", key=["interval_start", "series"])
    assert [r.batch for r in FI.read(spark, root).select("batch").distinct().collect()] == ["merged-21000101T000000Z"]
    assert rows(lake.postings("p", utc(10, 6), utc(11, 6), as_of=utc(11))) == want
