"""Groups of any size cut into segments of equal rows: the same answers, every task busy."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from asofspark.operators import carry as CA
from asofspark.operators import pit
from asofspark.operators.repeated import resolve_repeated_hour

START = dt.datetime(2024, 1, 1)


def known_at(facts, key, at):
    found = [(t, v) for k, t, v in facts if k == key and at is not None and t is not None and t <= at]
    return max(found)[1] if found else None


def frames(spark, facts, decisions):
    f = spark.createDataFrame(facts, "k string, t timestamp_ntz, v double").repartition(5)
    d = spark.createDataFrame(decisions, "n int, k string, t timestamp_ntz").repartition(5)
    return d, f


@pytest.mark.parametrize("shape", ["one key", "one time", "a third in one key", "no times"])
def test_as_of_join_of_hot_keys(spark, shape):
    rng = random.Random(shape)
    keys = ["a"] if shape in ("one key", "one time") else ["a", "a", None, *"bcdefgh"]

    def when():
        if shape == "no times" and rng.random() < 0.6:
            return None
        return START + dt.timedelta(minutes=0 if shape == "one time" else rng.randrange(600))

    facts = {(rng.choice(keys), when()): float(k) for k in range(400)}
    facts = [(k, t, v) for (k, t), v in facts.items()]
    if shape == "one time":
        facts += [("a", START - dt.timedelta(minutes=m), -float(m)) for m in range(1, 9)]
    decisions = [(n, rng.choice(keys), when()) for n in range(900)]
    rng.shuffle(decisions)
    want = {n: known_at(facts, k, t) for n, k, t in decisions}
    d, f = frames(spark, facts, decisions)
    for rows in (20, 150, CA.ROWS):
        got = pit.point_in_time_join(d, f, on="k", decision_time="t", posted="t", value_cols=["v"], rows=rows).collect()
        assert len(got) == 900 and {r.n: r.v for r in got} == want, rows


def test_one_key_with_all_rows_fills_every_segment(spark):
    rng = random.Random(3)
    order = list(range(8000))
    rng.shuffle(order)
    df = spark.createDataFrame([("a", x) for x in order], "k string, t long").repartition(7)
    seg, cut = CA.segmented(df, group=["k"], order=["t"], rows=500)
    per = seg.groupBy(CA.SEGMENT).agg(F.count("*").alias("n"), F.min("t").alias("lo"), F.max("t").alias("hi")).orderBy(CA.SEGMENT).collect()
    assert cut and len(per) == 16 and max(r.n for r in per) < 1500
    assert all(a.hi < b.lo for a, b in zip(per, per[1:], strict=False))
    assert CA.segmented(df, group=["k"], order=["t"], rows=8000)[1] is False


def test_segments_ascend_in_every_group(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", None, "b"]), rng.randrange(300), rng.random()) for _ in range(3000)] + [("c", 1, 0.5)]
    df = spark.createDataFrame(rows, "k string, t long, u double")
    seg, _ = CA.segmented(df, group=["k"], order=["t", "u"], rows=100)
    found = {}
    for r in seg.collect():
        found.setdefault(r.k, []).append((r.t, r.u, r[CA.SEGMENT]))
    for k, group in found.items():
        numbers = [s for _, _, s in sorted(group)]
        assert numbers == sorted(numbers) and (len(set(numbers)) > 5 or k == "c")


def brute_second_pass(rows):
    """Walk each group's repeated-hour rows in order."""
    flags, state = {}, {}
    for n, g, t in sorted(rows):
        if not dt.datetime(2024, 11, 3, 1) <= t < dt.datetime(2024, 11, 3, 2):
            flags[n] = False
            continue
        last, second = state.get(g, (None, False))
        second = second or (last is not None and t <= last)
        state[g] = (t if last is None else max(t, last), second)
        flags[n] = second
    return flags


@pytest.mark.parametrize("rows", [10, 10**6])
def test_repeated_hour_of_a_hot_day(spark, rows):
    base, data = dt.datetime(2024, 11, 3, 0, 30), []
    n = 0
    for g in ("x", None, "y"):
        for k in range(240 if g == "x" else 40):  # a walk over both passes, every 15 s or 90 s of UTC
            utc = dt.timedelta(seconds=k * (75 if g == "x" else 270))
            local = base + utc if utc < dt.timedelta(minutes=90) else base + utc - dt.timedelta(hours=1)
            data.append((n, g, local))
            n += 1
    df = spark.createDataFrame(data, "n int, g string, t timestamp_ntz").repartition(6)
    got = resolve_repeated_hour(df, order="n", local="t", by=["g"], rows=rows).collect()
    want = brute_second_pass(data)
    assert {r.n: r.second_pass for r in got} == want and sum(want.values()) > 20
    for r in got:  # Central time: UTC-5 in the first pass, UTC-6 from the second on
        hours = 6 if r.second_pass or r.t >= dt.datetime(2024, 11, 3, 2) else 5
        assert r.posted_utc == r.t + dt.timedelta(hours=hours)


def test_rows_without_order_or_time_stay(spark):
    t = dt.datetime(2024, 11, 3, 1, 30)
    df = spark.createDataFrame([(1, t), (2, t), (None, t), (4, None)], "n int, t timestamp_ntz")
    got = {(r.n, r.t): (r.second_pass, r.posted_utc) for r in resolve_repeated_hour(df, order="n", local="t").collect()}
    five = t + dt.timedelta(hours=5)
    assert got == {(1, t): (False, five), (2, t): (True, five + dt.timedelta(hours=1)), (None, t): (False, five), (4, None): (False, None)}
