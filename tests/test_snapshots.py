"""The snapshot log: one winner per version, reads that a compaction never disturbs."""

import datetime as dt
import os
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from asofspark.plans import compact as CP
from asofspark.plans.read import Lake
from asofspark.session import scratch_path
from asofspark.sources import lake as LK
from asofspark.sources import snapshots as SN

NOW = "2100-01-01 00:00:00"
DAY = dt.date(2024, 1, 10)
AS_OF = dt.datetime(2024, 2, 1, tzinfo=dt.UTC)


def rows(spark, posted_hour, n=8, product="p", value=0.0):
    df = spark.range(n).select(
        F.lit(product).alias("product"),
        (F.lit("2024-01-10 12:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("interval_start"),
        F.lit(60).alias("interval_minutes"), F.lit(f"2024-01-10 {posted_hour:02d}:00:00").cast("timestamp_ntz").alias("posted_at"),
        F.lit("2024-01-11 00:00:00").cast("timestamp_ntz").alias("ingested_at"), F.lit("archive").alias("source"),
        F.lit(1).alias("schema_version"), F.lit("s").alias("series"), (F.col("id") + value).cast("double").alias("value"),
        F.lit(False).alias("dst_flag"))
    return LK.with_batch(df)


@pytest.fixture
def root(spark):
    root = scratch_path(spark, "snap")
    for hour in (1, 2, 3):
        LK.write_curated(rows(spark, hour, value=hour / 10), root)
    LK.write_curated(rows(spark, 1, product="q"), root)
    return root


def seen(lake, product="p"):
    return sorted(map(tuple, lake._scan(product, DAY, DAY + dt.timedelta(days=1)).select("interval_start", "posted_at", "value").collect()))


def batches(spark, root, version=None):
    return sorted((r.product, str(r.date), r.batch) for r in SN.live(spark, root, version).collect())


@pytest.mark.parametrize("link", [True, False])
def test_a_version_has_one_winner(spark, link):
    path = urlparse(f"{scratch_path(spark, 'put')}/log/{7:020d}.json").path
    if link:
        with ThreadPoolExecutor(8) as pool:
            won = list(pool.map(lambda k: SN.put_if_absent(spark, path, b"%d" % k, link=True), range(24)))
    else:
        won = [SN.put_if_absent(spark, path, b"%d" % k, link=False) for k in range(3)]
    assert sum(won) == 1
    assert open(path, "rb").read() == b"%d" % won.index(True)
    assert [n for n in os.listdir(os.path.dirname(path)) if not n.startswith(".")] == [f"{7:020d}.json"]


def test_two_writers_cannot_both_take_a_version(spark, root):
    assert SN.live(spark, root) is None and SN.start(spark, root) == 0 == SN.start(spark, root)
    new = [spark.createDataFrame([("p", DAY, f"part-{k}")], "product string, date date, batch string") for k in range(4)]
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda d: SN.commit(spark, root, d), new))
    assert sorted(got) == [1, 2, 3, 4]
    assert {f"part-{k}" for k in range(4)} <= {b for _, _, b in batches(spark, root)}


def test_a_directory_is_taken_away_once(spark, root):
    SN.start(spark, root)
    none, some = SN.live(spark, root).limit(0), SN.live(spark, root).filter("product = 'p'").limit(1)
    SN.commit(spark, root, none, some)
    with pytest.raises(SN.Conflict):
        SN.commit(spark, root, none, some)
    assert len(batches(spark, root)) == len(batches(spark, root, 0)) - 1


def test_readers_before_during_and_after_a_compaction(spark, root):
    SN.start(spark, root)
    lake = Lake(spark, root, {"p": "series", "q": "series"})
    pinned, want, during = lake.pinned(), seen(lake), []
    assert len(want) == 24
    out = CP.compact(spark, root, now=NOW, key=["interval_start", "series"], before_commit=lambda: during.append(seen(lake))).collect()
    assert [(r.product, r.partitions, r.batches_in, r.rows) for r in out] == [("p", 1, 3, 24)]
    assert during == [want] and seen(lake) == want and seen(pinned) == want
    assert [b for p, _, b in batches(spark, root) if p == "p"] == ["merged-21000101T000000Z"]
    assert SN.directories(spark, root).filter("product = 'p'").count() == 4  # the sources are there for pinned readers
    assert SN.vacuum(spark, root, now=NOW) == 3
    assert seen(lake) == want and len(seen(lake, "q")) == 8
    assert SN.directories(spark, root).filter("product = 'p'").count() == 1
    assert CP.compact(spark, root, now="2100-01-02 00:00:00", key=["interval_start"]).count() == 0


def test_a_compaction_that_dies_before_its_commit_changes_nothing(spark, root):
    SN.start(spark, root)
    lake = Lake(spark, root, {"p": "series"})
    want = seen(lake)

    def die():
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        CP.compact(spark, root, now=NOW, key=["interval_start"], before_commit=die)
    assert seen(lake) == want
    CP.compact(spark, root, now="2100-01-02 00:00:00", key=["interval_start"])
    assert seen(lake) == want
    assert SN.vacuum(spark, root, now=NOW) == 4  # three sources and the merged batch of the lost run
    assert seen(lake) == want


def test_two_compactions_of_the_same_sources(spark, root):
    SN.start(spark, root)
    lake = Lake(spark, root, {"p": "series"})
    want = seen(lake)
    with pytest.raises(SN.Conflict):
        CP.compact(spark, root, now=NOW, key=["interval_start"], before_commit=lambda: CP.compact(
            spark, root, now="2100-01-02 00:00:00", key=["interval_start"]))
    assert seen(lake) == want and len([1 for p, _, _ in batches(spark, root) if p == "p"]) == 1


def test_many_versions_are_read_from_the_last_full_list(spark, root, monkeypatch):
    monkeypatch.setattr(SN, "CHECKPOINT", 3)
    SN.start(spark, root)
    want = {b for _, _, b in batches(spark, root)}
    for k in range(7):
        SN.commit(spark, root, spark.createDataFrame([("p", DAY, f"part-x{k}")], "product string, date date, batch string"))
        want.add(f"part-x{k}")
        assert {b for _, _, b in batches(spark, root)} == want
    plain, full = SN._names(spark, root)
    assert plain == list(range(8)) and full == [2, 5]
    assert len(batches(spark, root, 4)) == 8
    SN.vacuum(spark, root, now=NOW)
    assert SN._names(spark, root)[0] == [5, 6, 7] and {b for _, _, b in batches(spark, root)} == want
    with pytest.raises(ValueError, match="no version 1"):
        SN.live(spark, root, 1)
