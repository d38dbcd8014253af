"""Golden point-in-time reads through the lake reader on a hand-built curated lake."""

import datetime as dt
import os

import pytest

from asofspark.plans.read import Lake
from asofspark.session import scratch_path
from asofspark.sources import lake as LK

UTC = dt.UTC
P1 = dt.datetime(2026, 9, 3, 20, 20, tzinfo=UTC)
P2 = dt.datetime(2026, 9, 3, 21, 5, tzinfo=UTC)
SEP3 = dt.date(2026, 9, 3)


def _naive(t):
    return t.replace(tzinfo=None)


@pytest.fixture(scope="module")
def lake(spark):
    t0, t1 = dt.datetime(2026, 9, 3, 20, 0), dt.datetime(2026, 9, 3, 20, 15)
    late, late_posted = dt.datetime(2026, 9, 4, 4, 30), dt.datetime(2026, 9, 4, 4, 40)
    two = dt.timedelta(minutes=2)
    p1, p2 = _naive(P1), _naive(P2)
    rows = [
        ("rt", t0, "HB_NORTH", "HU", 30.0, p1, 1), ("rt", t0, "LZ_HOUSTON", "LZ", 31.0, p1, 1),
        ("rt", t0, "LZ_HOUSTON", "LZEW", 31.5, p1, 1), ("rt", t1, "HB_NORTH", "HU", 32.0, p1, 1),
        ("rt", t0, "HB_NORTH", "HU", 35.0, p2, 1),
        ("rt", late, "HB_NORTH", "HU", 33.0, late_posted, 1),
        ("da", t0, "DA_POINT", None, 40.0, p1, 1), ("da", t0, "DA_POINT", None, 41.0, p2, 1),
        ("v2", t0, "HB_NORTH", "HU", 1.0, p1, 2),
    ]
    data = [(p, i, 15, posted, posted + two, "archive", v, pt, ptype, price, False)
            for p, i, pt, ptype, price, posted, v in rows]
    df = spark.createDataFrame(data, "product string, interval_start timestamp_ntz, interval_minutes int, "
                                     "posted_at timestamp_ntz, ingested_at timestamp_ntz, source string, "
                                     "schema_version int, settlement_point string, settlement_point_type string, "
                                     "price_mwh double, dst_flag boolean")
    root = scratch_path(spark, "reader")
    LK.write_curated(LK.with_batch(df), root)
    # an unreadable file on a day no read below asks for
    bad = f"{root}/curated/product=rt/date=2026-09-05/batch=part-20260905T000000Z"
    os.makedirs(bad.removeprefix("file:"), exist_ok=True)
    with open(bad.removeprefix("file:") + "/part-0.parquet", "wb") as f:
        f.write(b"not parquet")
    return Lake(spark, root, {"rt": "spp", "da": "spp", "v2": "spp"})


def _prices(df):
    return {(r.settlement_point, r.settlement_point_type, r.interval_start.hour, r.interval_start.minute): r.price_mwh
            for r in df.collect()}


def test_before_between_and_after_a_repost(lake):
    assert lake.by_date("rt", SEP3, as_of=P1 - dt.timedelta(seconds=1)).count() == 0
    assert _prices(lake.by_date("rt", SEP3, as_of=P1))[("HB_NORTH", "HU", 20, 0)] == 30.0
    assert _prices(lake.by_date("rt", SEP3, as_of=P2 - dt.timedelta(seconds=1)))[("HB_NORTH", "HU", 20, 0)] == 30.0
    after = _prices(lake.by_date("rt", SEP3, as_of=P2))
    assert after[("HB_NORTH", "HU", 20, 0)] == 35.0 and after[("HB_NORTH", "HU", 20, 15)] == 32.0
    assert after[("LZ_HOUSTON", "LZ", 20, 0)] == 31.0 and after[("LZ_HOUSTON", "LZEW", 20, 0)] == 31.5


def test_a_late_evening_interval_belongs_to_its_central_day(lake):
    as_of = dt.datetime(2026, 9, 4, 5, 0, tzinfo=UTC)
    assert _prices(lake.by_date("rt", SEP3, as_of=as_of))[("HB_NORTH", "HU", 4, 30)] == 33.0
    assert lake.by_date("rt", dt.date(2026, 9, 4), as_of=as_of).count() == 0


def test_null_type_dedupes_and_sorts_last(lake):
    rows = lake.by_date("da", SEP3, as_of=P2).collect()
    assert [(r.settlement_point_type, r.price_mwh) for r in rows] == [(None, 41.0)]


def test_range_is_half_open_and_names_filter(lake):
    start, end = dt.datetime(2026, 9, 3, 20, 0, tzinfo=UTC), dt.datetime(2026, 9, 3, 20, 15, tzinfo=UTC)
    got = _prices(lake.by_range("rt", start, end, as_of=P2, names=["HB_NORTH"]))
    assert got == {("HB_NORTH", "HU", 20, 0): 35.0}
    versions = lake.postings("rt", start, end, as_of=P2, names=["HB_NORTH"]).collect()
    assert [r.price_mwh for r in versions] == [30.0, 35.0]


def test_only_requested_days_are_opened(lake):
    start, end = dt.datetime(2026, 9, 3, 5, 0, tzinfo=UTC), dt.datetime(2026, 9, 5, 5, 0, tzinfo=UTC)
    assert lake.by_range("rt", start, end, as_of=P2).count() == 4


def test_guards(lake):
    with pytest.raises(ValueError):
        lake.by_date("rt", SEP3, as_of=_naive(P2))
    long = dt.datetime(2026, 8, 1, tzinfo=UTC), dt.datetime(2026, 9, 5, tzinfo=UTC)
    assert lake.by_range("rt", *long, as_of=P2).count() > 0  # no limit unless one is given
    with pytest.raises(ValueError, match="at most 30 days"):
        Lake(lake.spark, lake.root, lake.tables, max_days=30).by_range("rt", *long, as_of=P2)
    with pytest.raises(ValueError):
        lake.by_range("rt", P2, P1, as_of=P2)
    with pytest.raises(ValueError, match="schema_version"):
        lake.by_date("v2", SEP3, as_of=P2)
    empty = lake.by_date("rt", dt.date(2026, 10, 1), as_of=P2)
    assert empty.count() == 0 and "price_mwh" in empty.columns
