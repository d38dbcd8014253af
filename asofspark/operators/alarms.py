"""Alarm rules over metric series (JOB18) and alarm-history rows (JOB13, FN27).

Datapoints are reduced to one row per (metric, bucket) first. The consecutive-bucket rule is a
window over ranges of ``RANGE`` buckets; the last ``points`` buckets of a range also go to
the next one as context, so every frame is whole and no task holds a long series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANGE = 4096


def alarm_states(metrics: DataFrame, *, period_minutes: int, points: int, threshold: float,
                 missing_breaching: bool, stat: str = "max", metric: str = "metric",
                 at: str = "at", value: str = "value", now=None) -> DataFrame:
    """Per metric and ``period_minutes`` bucket between its first and last datapoint (up to the last
    whole bucket before ``now``, so that a silent metric goes on breaching): the
    statistic, whether it breaches (``> threshold``; a bucket without data breaches when
    ``missing_breaching``), the state (ALARM when the last ``points`` buckets all breach; the
    first ``points - 1`` buckets are not a full window and stay OK) and whether it changed."""
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(period_minutes))
    sec = period_minutes * 60
    bucket = F.timestamp_seconds(F.floor(F.unix_seconds(F.col(at).cast("timestamp")) / sec) * sec).cast("timestamp_ntz")
    agg = {"max": F.max, "sum": F.sum, "min": F.min}[stat]
    per = metrics.groupBy(metric, bucket.alias("bucket")).agg(agg(value).alias("stat"))
    hi = F.max("bucket")
    if now is not None:
        until = F.floor(F.unix_seconds(F.lit(now).cast("timestamp_ntz").cast("timestamp")) / sec) * sec
        hi = F.greatest(hi, F.timestamp_seconds(until).cast("timestamp_ntz") - step)
    bounds = per.groupBy(metric).agg(F.min("bucket").alias("lo"), hi.alias("hi"))
    cal = bounds.select(metric, F.explode(F.sequence("lo", "hi", step)).alias("bucket"))
    series = cal.join(per, on=[metric, "bucket"], how="left")
    breach = F.when(F.col("stat").isNull(), F.lit(missing_breaching)).otherwise(F.col("stat") > threshold)
    index = F.floor(F.unix_seconds(F.col("bucket").cast("timestamp")) / sec)
    own = F.struct(F.floor(index / RANGE).alias("range"), F.lit(False).alias("context"))
    following = F.struct((F.floor(index / RANGE) + 1).alias("range"), F.lit(True).alias("context"))
    spread = F.when(F.pmod(index, F.lit(RANGE)) >= RANGE - points, F.array(own, following)).otherwise(F.array(own))
    rows = series.withColumn("breaching", breach).withColumn("__in", F.explode(spread)).select("*", "__in.*")
    ordered = Window.partitionBy(metric, "range").orderBy("bucket")
    frame = ordered.rowsBetween(-(points - 1), 0)
    alarm = (F.count(F.lit(1)).over(frame) == points) & F.bool_and("breaching").over(frame)
    rows = rows.withColumn("state", F.when(alarm, F.lit("ALARM")).otherwise(F.lit("OK")))
    changed = F.coalesce(F.lag("state").over(ordered) != F.col("state"), F.lit(False))
    return (rows.withColumn("changed", changed).filter(~F.col("context"))
            .select(metric, "bucket", "stat", "breaching", "state", "changed"))


HISTORY_SCHEMA = ("struct<oldState:struct<stateValue:string>,"
                  "newState:struct<stateValue:string,stateReason:string>>")


def alarm_transitions(history: DataFrame, prefix: str, since, now) -> DataFrame:
    """JOB13 + FN27: state changes of alarms named ``prefix*`` in ``(since, now]``, oldest first.
    ``history``: (alarm, at, data JSON with oldState/newState)."""
    h = history.filter(F.col("alarm").startswith(prefix)
                       & (F.col("at") > F.lit(since).cast("timestamp_ntz"))
                       & (F.col("at") <= F.lit(now).cast("timestamp_ntz")))
    d = F.from_json(F.col("data"), HISTORY_SCHEMA)
    return (h.select("at", "alarm", d.getField("oldState").getField("stateValue").alias("old"),
                     d.getField("newState").getField("stateValue").alias("new"),
                     d.getField("newState").getField("stateReason").alias("reason"))
            .orderBy("at", "alarm"))
