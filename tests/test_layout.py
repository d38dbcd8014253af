"""The pre-shuffled layout: plans without an exchange, equal answers with hot, NULL and late keys."""

import pytest
from pyspark.sql import functions as F

from asofspark.operators import pit
from asofspark.session import scratch_path
from asofspark.sources import layout as LY

KEY = ["k", "t"]
AS_OF = "2024-01-09 00:00:00"


@pytest.fixture(scope="module")
def rows(spark):
    """A key with a third of all rows, NULL keys and ties of the posting time."""
    i = F.col("id")
    k = F.when(i % 3 == 0, F.lit("hot")).when(i % 11 == 0, F.lit(None)).otherwise(F.concat(F.lit("k"), (i % 40).cast("string")))
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    t = F.when(i % 3 == 0, start).otherwise(start + F.make_dt_interval(hours=(i % 5).cast("int")))
    return spark.range(3000).select(
        k.alias("k"), t.alias("t"), (start + F.make_dt_interval(hours=(i * 7 % 400).cast("int"))).alias("posted_at"),
        (start + F.make_dt_interval(mins=i.cast("int"))).alias("ingested_at"), i.alias("v"))


def answers(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("hot_rows", [100, 10**9])
def test_latest_equals_that_of_the_rows(spark, rows, hot_rows):
    old = F.col("v") % 4 != 0
    laid = LY.write(spark, rows.filter(old), scratch_path(spark, "layout"), KEY, buckets=6, hot_rows=hot_rows)
    assert laid.n_hot == (1 if hot_rows == 100 else 0)
    want = pit.latest_as_of(rows, key=KEY, posted="posted_at", tie="ingested_at", as_of=AS_OF)
    assert answers(laid.latest(KEY, as_of=AS_OF, extra=rows.filter(~old))) == answers(want)
    few = F.col("t") < F.lit("2024-01-01 03:00:00").cast("timestamp_ntz")
    some = pit.latest_as_of(rows.filter(old & few), key=KEY, posted="posted_at", tie="ingested_at", as_of=AS_OF)
    assert answers(laid.latest(KEY, as_of=AS_OF, where=few)) == answers(some)
    assert answers(laid.rows(rows.filter(~old))) == answers(rows)


def test_latest_is_planned_without_an_exchange(spark, rows):
    laid = LY.write(spark, rows, scratch_path(spark, "layout"), KEY, buckets=6)
    text = plan(laid.latest(KEY, as_of=AS_OF))
    assert "Exchange" not in text and "Bucketed: true" in text and "PushedFilters" in text
    with pytest.raises(ValueError, match="layout by"):
        laid.latest(["t"], as_of=AS_OF)
    with pytest.raises(ValueError, match="written once"):
        LY.write(spark, rows, laid.path, KEY)


def test_only_late_rows_are_shuffled(spark, rows):
    laid = LY.write(spark, rows.filter("v < 2500"), scratch_path(spark, "layout"), KEY, buckets=6)
    text = plan(laid.latest(KEY, as_of=AS_OF, extra=rows.filter("v >= 2500")))
    assert text.count("Exchange") == 1 and "REPARTITION_BY_NUM" in text


def test_a_layout_is_opened_by_another_session(spark, rows):
    laid = LY.write(spark, rows, scratch_path(spark, "layout"), KEY, buckets=6, hot_rows=100)
    spark.sql(f"DROP TABLE {laid.name}")
    again = LY.open_layout(spark, laid.path)
    assert answers(again.rows()) == answers(rows)
    assert again.by == KEY and again.n_hot == 1


@pytest.mark.parametrize("hot_rows", [(100, 10**9), (10**9, 100), (10**9, 10**9), (60, 100)])
def test_as_of_join(spark, rows, hot_rows):
    facts = rows.groupBy("k", "posted_at").agg(F.max("v").alias("v"))
    asks = rows.select("k", F.col("v").alias("ask"), F.col("ingested_at").alias("at"))
    d = LY.write(spark, asks, scratch_path(spark, "layout"), ["k"], sort=["at"], buckets=6, hot_rows=hot_rows[0])
    f = LY.write(spark, facts, scratch_path(spark, "layout"), ["k"], buckets=6, hot_rows=hot_rows[1])
    got = LY.as_of_join(d, f, decision_time="at", posted="posted_at", value_cols=["v"])
    want = pit.point_in_time_join(asks, facts, on="k", decision_time="at", posted="posted_at", value_cols=["v"])
    assert answers(got) == answers(want)
    if not d.n_hot and not f.n_hot:
        assert "Exchange" not in plan(got)


def test_an_empty_table(spark, rows):
    laid = LY.write(spark, rows.limit(0), scratch_path(spark, "layout"), KEY, buckets=6)
    assert answers(laid.rows()) == [] and answers(laid.latest(KEY, as_of=AS_OF, extra=rows)) == answers(
        pit.latest_as_of(rows, key=KEY, posted="posted_at", tie="ingested_at", as_of=AS_OF))
