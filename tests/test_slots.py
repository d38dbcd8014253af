"""Calendar bitmaps: equal to coverage from rows on days of 23, 24 and 25 hours, merged in any order."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from asofspark.operators import slots as SL
from asofspark.plans import ingest as IN
from asofspark.plans import monitor as MO
from asofspark.session import scratch_path
from asofspark.sources import lake as LK
from asofspark.sources import snapshots as SN

DAYS = [dt.date(2024, 3, 10), dt.date(2024, 7, 1), dt.date(2024, 11, 3)]
COLS = ["product", "delivery_date", "interval_minutes", "expected", "present", "n_missing", "missing"]


@pytest.fixture(scope="module")
def expected(spark):
    days = [(p, m, d) for p, m in (("a", 5), ("b", 60), (None, 15), ("empty", 15)) for d in DAYS]
    return MO.calendar(spark.createDataFrame(days, "product string, interval_minutes int, delivery_date date"))


@pytest.fixture(scope="module")
def present(expected):
    """Some of the slots, some of them twice, some off the minute, without an interval or on another day."""
    slots = expected.filter((F.hash("interval_start", "product") % 3 != 0) & F.coalesce(F.col("product") != "empty", F.lit(True)))
    rows = slots.select("product", "interval_start")
    off = rows.withColumn("interval_start", F.col("interval_start") + F.expr("INTERVAL 30 SECONDS"))
    late = rows.withColumn("interval_start", F.col("interval_start") + F.expr("INTERVAL 2 MINUTES"))
    none = rows.withColumn("interval_start", F.lit(None).cast("timestamp_ntz"))
    other = rows.withColumn("interval_start", F.col("interval_start") + F.expr("INTERVAL 40 DAYS"))
    return rows.unionByName(rows).unionByName(off).unionByName(late).unionByName(none).unionByName(other)


def found(df):
    return sorted((tuple(r) for r in df.select(*COLS).collect()), key=str)


def test_equal_to_coverage_from_rows(expected, present):
    known = F.col("product").isNotNull()  # coverage from rows does not match NULL products
    want = MO.coverage(expected.filter(known), present.filter(known))
    got = found(SL.coverage(expected, SL.bitmaps(present)))
    assert [r for r in got if r[0] is not None] == found(want)
    assert sorted({r[3] for r in got if r[2] == 60}) == [23, 24, 25]
    assert all(r[4] > 0 for r in got if r[0] is None) and all(r[4] == 0 for r in got if r[0] == "empty")


def test_merging_is_free_of_order_and_repeats(present):
    a, b = (SL.bitmaps(present.filter(F.pmod(F.hash("interval_start"), F.lit(2)) == k)) for k in (0, 1))
    rows = lambda df: sorted((tuple(r) for r in df.select(*SL.KEY, "bits").collect()), key=str)
    want = rows(SL.bitmaps(present))
    assert rows(SL.merged(a, b)) == rows(SL.merged(SL.merged(b, a), a)) == want
    assert rows(SL.bitmaps(present.limit(0))) == []


def test_state_of_a_lake_and_no_read_of_its_rows(spark, expected, present):
    root = scratch_path(spark, "slots")
    rows = present.filter(F.col("product").isNotNull() & F.col("interval_start").isNotNull()).withColumn(
        "posted_at", F.lit("2024-12-01").cast("timestamp_ntz"))
    expected = expected.filter(F.col("product").isNotNull())
    with pytest.raises(ValueError, match="start_slots"):
        IN.slot_coverage(spark, root, expected)
    LK.write_curated(LK.with_batch(rows.filter("product = 'a'")), root)
    SN.start(spark, root)
    IN.start_slots(spark, root)
    later = LK.with_batch(rows.filter("product = 'b'"))
    for _ in range(2):  # a replay
        IN.record_slots(spark, root, later)
    got = IN.slot_coverage(spark, root, expected)
    assert found(got) == found(MO.coverage(expected, rows))
    assert all("/state/slots/" in f for f in got.inputFiles())


def test_ingest_keeps_the_state(spark):
    from asofspark import fixtures as FX

    sf, root = "/root/testdata/sf0.001", scratch_path(spark, "slots")
    raw = FX.raw_postings(spark, sf)
    day = F.lit("2024-01-05").cast("timestamp_ntz")
    early = raw.filter(F.col("posted_at") < day)
    IN.ingest(spark, early, FX.event_declarations(), root, ingested_at="2024-02-01 00:00:00")
    assert IN.read_state(spark, root, "slots") is None
    IN.start_slots(spark, root)
    later = raw.filter((F.col("posted_at") >= day) & (F.col("posted_at") < F.lit("2024-01-08").cast("timestamp_ntz")))
    IN.ingest(spark, later, FX.event_declarations(), root, ingested_at="2024-02-02 00:00:00")
    whole = SL.bitmaps(spark.read.parquet(f"{root}/curated"))
    rows = lambda df: sorted(tuple(r) for r in df.select(*SL.KEY, "bits").collect())
    assert rows(IN.read_state(spark, root, "slots")) == rows(whole) != []
