"""Calendar bitmaps: which minutes of a delivery day a product has a row for (AGG06, SET04, JN01).

A day's slots are bits, counted in minutes from the day's first UTC instant, so days of 23, 24 and 25 hours and
every cadence of whole minutes share one form: ``(product, delivery_date, word, bits)`` with 64 minutes a
word, at most 24 words a day however many rows the day has. Bitmaps of several runs merge by bitwise or, in any
order and any number of times, so a replayed run changes nothing. Missing slots are the expected bits that are
not present: coverage reads the bitmaps and never the rows.

Cases: rows without a product keep a NULL one; rows without an interval, or at one that is not on a whole minute, set no
bit. Empty inputs give no bitmaps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asofspark.functions import time as T

KEY = ["product", "delivery_date", "word"]
_MINUTE = 60_000_000


def _placed(df: DataFrame, interval: str) -> DataFrame:
    """``df`` with ``word`` and ``bit`` of the interval in its ``delivery_date``; whole minutes only."""
    micros = T.ntz_micros(interval) - T.ntz_micros(T.day_starts(F.col("delivery_date"))[0])
    at = df.withColumn("__us", micros).filter(F.col("__us") % _MINUTE == 0)
    minute = F.expr(f"__us div {_MINUTE}")
    return at.withColumn("__m", minute).withColumn("word", F.expr("cast(__m div 64 as int)")).withColumn(
        "bit", F.expr("shiftleft(1L, cast(__m % 64 as int))")).drop("__us", "__m")


def bitmaps(rows: DataFrame, *, product: str = "product", interval: str = "interval_start") -> DataFrame:
    """The bitmaps of ``rows``: one aggregate that combines before its shuffle, whatever the rows' number."""
    slim = rows.select(F.col(product).alias("product"), F.col(interval).alias("__at"),
                       T.delivery_date(interval).alias("delivery_date"))
    return _placed(slim, "__at").groupBy(*KEY).agg(F.bit_or("bit").alias("bits"))


def merged(a: DataFrame, b: DataFrame) -> DataFrame:
    """The bitmaps of both."""
    return a.select(*KEY, "bits").unionByName(b.select(*KEY, "bits")).groupBy(*KEY).agg(F.bit_or("bits").alias("bits"))


def coverage(expected: DataFrame, present: DataFrame) -> DataFrame:
    """Expected, present and missing slots per (product, delivery_date) of ``expected`` (product, delivery_date,
    interval_start, interval_minutes, one row per slot), from the bitmaps ``present``."""
    want = _placed(expected, "interval_start").groupBy(*KEY).agg(
        F.bit_or("bit").alias("want"), F.first("interval_minutes").alias("interval_minutes"))
    have = present.select(*[F.col(c).alias(f"h_{c}") for c in KEY], "bits")
    same = F.lit(True)
    for c in KEY:
        same = same & F.col(c).eqNullSafe(F.col(f"h_{c}"))
    j = want.join(have, same, "left").withColumn("bits", F.coalesce("bits", F.lit(0).cast("bigint")))
    gone = F.col("want").bitwiseAND(F.bitwise_not("bits"))
    # minutes of the word's missing bits
    minutes = F.transform(F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.getbit("__gone", i) == 1),
                          lambda i: F.col("word") * 64 + i)
    g = j.withColumn("__gone", gone).withColumn("__minutes", minutes).groupBy("product", "delivery_date").agg(
        F.first("interval_minutes").alias("interval_minutes"),
        F.sum(F.bit_count("want")).cast("bigint").alias("expected"),
        F.sum(F.bit_count(F.col("want").bitwiseAND(F.col("bits")))).cast("bigint").alias("present"),
        F.array_sort(F.flatten(F.collect_list("__minutes"))).alias("__missing"))
    start = T.day_starts(F.col("delivery_date"))[0]
    g = g.withColumn("__start", start).withColumn(
        "missing", F.transform("__missing", lambda m: F.col("__start") + F.make_dt_interval(mins=m)))
    return g.withColumn("n_missing", F.size("missing")).drop("__missing", "__start")
