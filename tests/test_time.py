"""Golden DST cases of the market's time conventions (Central time)."""

import datetime as dt

from pyspark.sql import functions as F

from asofspark.functions import time as T


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_day_interval_counts(spark):
    for day, n15, n60 in [("2026-09-14", 96, 24), ("2026-11-01", 100, 25), ("2026-03-08", 92, 23)]:
        d = F.lit(day).cast("date")
        r = one(spark, F.size(T.day_interval_starts(d, 15)).alias("a"), F.size(T.day_interval_starts(d, 60)).alias("b"))
        assert (r.a, r.b) == (n15, n60)


def test_fall_back_hour_ending_two(spark):
    d = F.lit("2026-11-01").cast("date")
    first, p1 = T.hour_ending_start(d, F.lit(2), 60, F.lit(False))
    second, p2 = T.hour_ending_start(d, F.lit(2), 60, F.lit(True))
    r = one(spark, first.alias("a"), second.alias("b"), p1.alias("p1"), p2.alias("p2"))
    assert r.a == dt.datetime(2026, 11, 1, 6, 0) and r.b == dt.datetime(2026, 11, 1, 7, 0)
    assert r.p1 is None and r.p2 is None


def test_spring_forward_either_label(spark):
    d = F.lit("2026-03-08").cast("date")
    he2, _ = T.hour_ending_start(d, F.lit(2), 60)
    he3, p3 = T.hour_ending_start(d, F.lit(3), 60)
    r = one(spark, he2.alias("a"), he3.alias("b"), p3.alias("p"))
    assert r.a == r.b == dt.datetime(2026, 3, 8, 7, 0) and r.p is None


def test_spring_gap_refused_in_interval_style(spark):
    d = F.lit("2026-03-08").cast("date")
    _, problem = T.interval_start(d, F.lit(3), F.lit(1), 15, F.lit(False))
    assert "the clocks skip" in one(spark, problem.alias("p")).p


def test_flag_on_unambiguous_hour_refused(spark):
    d = F.lit("2026-09-14").cast("date")
    _, problem = T.interval_start(d, F.lit(5), F.lit(1), 15, F.lit(True))
    assert "outside a repeated hour" in one(spark, problem.alias("p")).p


def test_every_interval_gapless(spark):
    # exhaustive: consecutive starts of a day differ by exactly the grain at 60/15/5 minutes
    for day in ("2026-03-08", "2026-11-01", "2026-07-04"):
        for m in (60, 15, 5):
            arr = one(spark, T.day_interval_starts(F.lit(day).cast("date"), m).alias("a")).a
            assert all((b - a) == dt.timedelta(minutes=m) for a, b in zip(arr, arr[1:], strict=False))
            assert len(set(arr)) == len(arr)


def test_session_zone_does_not_matter(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        d = F.lit("2026-11-01").cast("date")
        second, _ = T.hour_ending_start(d, F.lit(2), 60, F.lit(True))
        assert one(spark, second.alias("a")).a == dt.datetime(2026, 11, 1, 7, 0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_stamp_roundtrip(spark):
    ts = F.lit("2026-09-03 17:32:53").cast("timestamp_ntz")
    r = one(spark, T.stamp(ts).alias("s"), T.parse_stamp(T.stamp(ts)).alias("b"))
    assert r.s == "20260903T173253Z" and r.b == dt.datetime(2026, 9, 3, 17, 32, 53)


def test_zone_shifts_equal_convert_timezone_under_any_session_zone(spark):
    """Every 5 minutes of both DST days: the cached-zone conversion equals convert_timezone."""
    start = [dt.datetime(2024, 11, 3), dt.datetime(2024, 3, 10)]
    rows = [(s + dt.timedelta(minutes=5 * i),) for s in start for i in range(2 * 24 * 12)]
    d = spark.createDataFrame(rows, "x timestamp_ntz")
    ref_utc = F.convert_timezone(F.lit(T.CT), F.lit("UTC"), F.col("x"))
    ref_loc = F.convert_timezone(F.lit("UTC"), F.lit(T.CT), F.col("x"))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Tokyo", "America/Chicago"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            bad = d.filter((T.first_utc("x") != ref_utc) | (T.utc_to_local("x") != ref_loc)).count()
            assert bad == 0, zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
