"""Golden point-in-time reads on a hand-built lake: before, between and after a repost."""

import datetime as dt

from asofspark.operators import pit

P1 = dt.datetime(2026, 9, 3, 20, 20)
P2 = dt.datetime(2026, 9, 3, 21, 5)
KEY = ["interval_start", "settlement_point", "settlement_point_type"]


def lake(spark):
    t0, t1 = dt.datetime(2026, 9, 3, 20, 0), dt.datetime(2026, 9, 3, 20, 15)
    two = dt.timedelta(minutes=2)
    rows = [
        (t0, "HB_NORTH", "HU", 30.0, P1, P1 + two),
        (t0, "LZ_HOUSTON", "LZ", 31.0, P1, P1 + two),
        (t0, "LZ_HOUSTON", "LZEW", 31.5, P1, P1 + two),
        (t1, "HB_NORTH", "HU", 32.0, P1, P1 + two),
        (t0, "HB_NORTH", "HU", 35.0, P2, P2 + two),
        (t0, "DA_POINT", None, 40.0, P1, P1 + two),
        (t0, "DA_POINT", None, 41.0, P2, P2 + two),
    ]
    schema = ("interval_start timestamp_ntz, settlement_point string, settlement_point_type string, "
              "price_mwh double, posted_at timestamp_ntz, ingested_at timestamp_ntz")
    return spark.createDataFrame(rows, schema)


def read(spark, as_of):
    df = pit.latest_as_of(lake(spark), key=KEY, as_of=as_of, tie="ingested_at")
    return {(r.settlement_point, r.settlement_point_type, r.interval_start.minute): r.price_mwh
            for r in df.collect()}


def test_before_first_posting_is_empty(spark):
    assert read(spark, P1 - dt.timedelta(seconds=1)) == {}


def test_between_postings_sees_first(spark):
    assert read(spark, P1)[("HB_NORTH", "HU", 0)] == 30.0
    assert read(spark, P2 - dt.timedelta(seconds=1))[("HB_NORTH", "HU", 0)] == 30.0


def test_after_repost_sees_correction_and_keeps_untouched_rows(spark):
    r = read(spark, P2)
    assert r[("HB_NORTH", "HU", 0)] == 35.0 and r[("HB_NORTH", "HU", 15)] == 32.0
    assert r[("LZ_HOUSTON", "LZ", 0)] == 31.0 and r[("LZ_HOUSTON", "LZEW", 0)] == 31.5


def test_null_type_is_part_of_the_key(spark):
    r = read(spark, P2)
    assert r[("DA_POINT", None, 0)] == 41.0
    assert sum(1 for k in r if k[0] == "DA_POINT") == 1


def test_postings_keeps_every_version(spark):
    rows = pit.postings(lake(spark), key=KEY, as_of=P2).collect()
    assert len(rows) == 7


def test_point_in_time_join_matches_loop(spark):
    facts = lake(spark).filter("settlement_point = 'HB_NORTH' AND interval_start = '2026-09-03 20:00:00'")
    facts = facts.select("settlement_point", "posted_at", "price_mwh")
    decisions = spark.createDataFrame(
        [(1, "HB_NORTH", P1 - dt.timedelta(seconds=1)), (2, "HB_NORTH", P1), (3, "HB_NORTH", P2)],
        "id int, settlement_point string, at timestamp_ntz")
    for bucket in (None, "1 hour"):
        out = pit.point_in_time_join(decisions, facts, on="settlement_point", decision_time="at",
                                     posted="posted_at", value_cols=["price_mwh"], bucket=bucket)
        got = {r.id: r.price_mwh for r in out.collect()}
        assert got == {1: None, 2: 30.0, 3: 35.0}
