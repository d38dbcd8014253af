"""Driver queries: each takes (spark, sf_dir) and returns a DataFrame built from the library.

Every query reads the driver's tables (whole tables; the only limits are those that are the
feature, e.g. a top-k report) and composes operators from ``asofspark``. The DuckDB oracle for
each lives in :mod:`asofspark.oracles` under the same name, with the same column names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asofspark.operators import pit
from asofspark.tables import event_log, read

AS_OF = "2024-01-15 00:00:00"
KEY = ("day", "user_id", "event_type")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# --- point-in-time reads (FLT01 FLT02 FLT03 FLT04 WIN01 SRT01 SRT02 JOB01-03) ----------------


@query
def pit_latest_as_of(spark, sf):
    log = event_log(spark, sf)
    return pit.latest_as_of(log, key=KEY, posted="posted_at", as_of=AS_OF)


@query
def pit_by_date(spark, sf):
    log = event_log(spark, sf).filter(F.col("day") == F.lit("2024-01-10").cast("date"))
    return pit.latest_as_of(log, key=KEY, posted="posted_at", as_of="2024-01-10 12:00:00")


@query
def pit_by_range_named(spark, sf):
    log = event_log(spark, sf).withColumn("interval_start", F.col("day").cast("timestamp_ntz"))
    log = pit.between_intervals(log, "2024-01-05 00:00:00", "2024-01-12 00:00:00")
    log = pit.named(log, "event_type", ["click", "purchase"])
    return pit.latest_as_of(log, key=KEY, posted="posted_at", as_of="2024-01-20 00:00:00")


@query
def pit_two_clocks(spark, sf):
    log = event_log(spark, sf).withColumn(
        "ingested_at", F.col("posted_at") + F.make_dt_interval(F.lit(0), F.col("event_id") % 7)
    )
    return pit.latest_as_of(log, key=KEY, posted="posted_at", tie="ingested_at", as_of=AS_OF,
                            ingested="ingested_at", system_as_of=AS_OF)


@query
def pit_postings(spark, sf):
    log = event_log(spark, sf).withColumn("interval_start", F.col("day").cast("timestamp_ntz"))
    log = pit.between_intervals(log, "2024-01-03 00:00:00", "2024-01-06 00:00:00")
    return pit.postings(log, key=KEY, posted="posted_at", as_of="2024-01-05 12:00:00")


@query
def pit_null_key(spark, sf):
    log = event_log(spark, sf).withColumn(
        "user_id", F.when(F.col("user_id") % 3 != 0, F.col("user_id"))
    )
    return pit.order_by_key(
        pit.latest_as_of(log, key=KEY, posted="posted_at", as_of="2024-01-20 00:00:00"), KEY
    )


@query
def pit_tie_break(spark, sf):
    log = event_log(spark, sf).select(
        *KEY, F.date_trunc("hour", "posted_at").cast("timestamp_ntz").alias("posted_at"),
        F.col("posted_at").alias("ingested_at"), "event_id", "value",
    )
    return pit.latest_as_of(log, key=KEY, posted="posted_at", tie="ingested_at", as_of=AS_OF)


def _purchases_and_views(spark, sf):
    e = read(spark, sf, "events")
    decisions = e.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("decision_id"), "user_id", F.col("ts").alias("decision_ts"))
    facts = e.filter(F.col("event_type") == "view").select(
        "user_id", F.col("ts").alias("posted_at"), F.col("value").alias("view_value"))
    return decisions, facts


@query
def pit_join(spark, sf):
    decisions, facts = _purchases_and_views(spark, sf)
    return pit.point_in_time_join(decisions, facts, on="user_id", decision_time="decision_ts",
                                  posted="posted_at", value_cols=["view_value"])


@query
def pit_join_bucketed(spark, sf):
    decisions, facts = _purchases_and_views(spark, sf)
    return pit.point_in_time_join(decisions, facts, on="user_id", decision_time="decision_ts",
                                  posted="posted_at", value_cols=["view_value"], bucket="1 hour")


@query
def pit_join_null_keys(spark, sf):
    """Keys and decision times that are NULL here and there: NULL keys match, no decision is lost."""
    decisions, facts = _purchases_and_views(spark, sf)
    lost = F.lit(None).cast("bigint")
    key = F.when(F.col("user_id") % 7 == 0, lost).otherwise(F.col("user_id"))
    at = F.when(F.col("decision_id") % 5 != 0, F.col("decision_ts"))
    decisions = decisions.withColumn("user_id", key).withColumn("decision_ts", at)
    facts = facts.withColumn("user_id", key).groupBy("user_id", "posted_at").agg(F.max("view_value").alias("view_value"))
    return pit.point_in_time_join(decisions, facts, on="user_id", decision_time="decision_ts",
                                  posted="posted_at", value_cols=["view_value"])


# --- zone-exact time rules (FN01-FN19, WIN02, PRJ09) ----------------------------------------

from asofspark.functions import parse as P  # noqa: E402
from asofspark.functions import time as T  # noqa: E402
from asofspark.operators.repeated import resolve_repeated_hour  # noqa: E402

SHIFT_DAYS = 304  # moves January events across the 2024-11-03 fall-back


def _shifted_events(spark, sf):
    e = read(spark, sf, "events")
    return e.select("event_id", (F.col("ts") + F.make_dt_interval(F.lit(SHIFT_DAYS))).alias("utc"))


@query
def delivery_date_split(spark, sf):
    e = _shifted_events(spark, sf)
    return e.select("event_id", "utc", T.utc_to_local("utc").alias("local_ts"),
                    T.delivery_date("utc").alias("delivery_date"))


def _order_days(spark, sf):
    o = read(spark, sf, "orders")
    return o.select("o_orderkey", F.to_date("o_orderdate").alias("day"))


@query
def hour_ending_to_utc(spark, sf):
    o = _order_days(spark, sf)
    text = o.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 2 == 0, F.date_format("day", "MM/dd/yyyy"))
        .otherwise(F.date_format("day", "yyyy-MM-dd")).alias("date_text"),
        F.concat(F.lpad((1 + F.col("o_orderkey") % 24).cast("string"), 2, "0"), F.lit(":00")).alias("he_text"),
        (F.col("o_orderkey") % 10 == 0).alias("flag"),
    )
    start, problem = T.hour_ending_start(T.parse_delivery_date("date_text"),
                                         T.parse_hour_ending("he_text"), 60, F.col("flag"))
    return text.select("o_orderkey", start.alias("interval_start"), problem.alias("problem"))


@query
def interval_to_utc(spark, sf):
    o = _order_days(spark, sf)
    hour = (1 + F.col("o_orderkey") % 24).cast("int")
    interval = (1 + F.floor(F.col("o_orderkey") / 24) % 4).cast("int")
    flag = F.col("o_orderkey") % 7 == 0
    start, problem = T.interval_start(F.col("day"), hour, interval, 15, flag)
    return o.select("o_orderkey", start.alias("interval_start"), problem.alias("problem"))


@query
def stamp_floor(spark, sf):
    o = read(spark, sf, "orders")
    local = F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                                       (F.col("o_orderkey") * 37) % 86400)
    text = F.date_format(local, "MM/dd/yyyy HH:mm:ss")
    start, problem = T.run_stamp_start(text, 5, F.col("o_custkey") % 9 == 0)
    return o.select("o_orderkey", start.alias("interval_start"), problem.alias("problem"))


@query
def repeated_hour_roundtrip(spark, sf):
    e = _shifted_events(spark, sf).withColumn("local_ts", T.utc_to_local("utc"))
    r = resolve_repeated_hour(e.select("event_id", "local_ts"), order="event_id", local="local_ts")
    return r.select("event_id", "local_ts", F.col("posted_utc").alias("utc"), "second_pass")


def _wall_clocks(spark, sf):
    days = _order_days(spark, sf).select("day").distinct()
    return days.select("day", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour")).withColumn(
        "local_ts", T.midnight("day") + F.make_dt_interval(F.lit(0), F.col("hour")))


@query
def strict_local_time(spark, sf):
    w = _wall_clocks(spark, sf)
    flag = F.col("hour") % 2 == 1
    return w.select("day", "hour", T.local_to_utc("local_ts", flag).alias("utc"),
                    T.local_problem("local_ts", flag).alias("problem"))


@query
def ambiguous_hours(spark, sf):
    w = _wall_clocks(spark, sf)
    return w.select("day", "hour", T.exists_local("local_ts").alias("exists_local"),
                    T.is_repeated("local_ts").alias("is_repeated"))


@query
def nearest_occurrence(spark, sf):
    w = _wall_clocks(spark, sf)
    listed = T.first_utc("local_ts") + F.make_dt_interval(F.lit(0), F.lit(0), 40 * (F.col("hour") % 3))
    return w.select("day", "hour", listed.alias("listed_utc"),
                    T.nearest_occurrence("local_ts", listed).alias("posted_utc"))


@query
def dst_day_intervals(spark, sf):
    days = _order_days(spark, sf).select("day").distinct()
    return days.select("day", F.size(T.day_interval_starts("day", 15)).alias("n15"),
                       F.size(T.day_interval_starts("day", 60)).alias("n60"))


@query
def month_edges(spark, sf):
    o = read(spark, sf, "orders")
    months = o.select(F.trunc(F.to_date("o_orderdate"), "month").alias("month")).distinct()
    start, end = T.month_edges("month")
    return months.select("month", start.alias("utc_start"), end.alias("utc_end"))


@query
def stamp_roundtrip(spark, sf):
    e = read(spark, sf, "events").select("event_id", F.date_trunc("second", "ts").cast("timestamp_ntz").alias("ts"))
    s = e.withColumn("stamp", T.stamp("ts"))
    return s.select("event_id", "stamp", T.parse_stamp("stamp").alias("parsed"))


@query
def time_styles(spark, sf):
    e = _shifted_events(spark, sf).select("event_id", F.date_trunc("hour", "utc").cast("timestamp_ntz").alias("u"))
    e = e.withColumn("local_ts", T.utc_to_local("u")).withColumn(
        "second", T.local_to_utc("local_ts", True) == F.col("u"))
    day = F.to_date("local_ts")
    he, _ = T.hour_ending_start(day, F.hour("local_ts") + 1, 60, F.col("second") & T.is_repeated("local_ts"))
    hi, _ = T.interval_start(day, F.hour("local_ts") + 1, F.lit(1), 60, F.col("second") & T.is_repeated("local_ts"))
    run_text = F.date_format(F.col("local_ts") + F.expr("INTERVAL '00:03:17' HOUR TO SECOND"), "MM/dd/yyyy HH:mm:ss")
    sc, _ = T.run_stamp_start(run_text, 5, F.col("second") & T.is_repeated("local_ts"))
    return e.select("event_id", "u", he.alias("he_utc"), hi.alias("hi_utc"), sc.alias("sced_utc"))


@query
def parse_numbers(spark, sf):
    li = read(spark, sf, "lineitem")
    q = F.col("l_quantity").cast("bigint").cast("string")
    k = F.col("l_linenumber") % 5
    text = (F.when(k == 0, F.concat(q, F.lit(".5"))).when(k == 1, F.concat(F.lit(" "), q, F.lit(" ")))
            .when(k == 2, F.concat(q, F.lit("d"))).when(k == 3, F.lit("")).otherwise(F.concat(F.lit("x"), q)))
    opt, opt_problem = P.to_number(text, required=False)
    whole, whole_problem = P.to_whole(text)
    return li.select("l_orderkey", "l_linenumber", text.alias("cell"), opt.alias("number"),
                     opt_problem.alias("number_problem"), whole.alias("whole"),
                     whole_problem.alias("whole_problem"))


@query
def parse_timestamps(spark, sf):
    e = read(spark, sf, "events")
    k = F.col("event_id") % 4
    ms = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    text = (F.when(k == 0, ms).when(k == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
            .when(k == 2, F.date_format("ts", "yyyy/MM/dd HH:mm")).otherwise(F.concat(F.lit("T"), ms)))
    return e.select("event_id", text.alias("cell"), T.parse_post_local(text).alias("posted_local"))


@query
def hour_ending_parse(spark, sf):
    o = read(spark, sf, "orders")
    k = F.col("o_orderkey") % 6
    h = (1 + F.col("o_orderkey") % 24).cast("string")
    d = F.to_date("o_orderdate")
    he_text = (F.when(k == 0, F.concat(F.lpad(h, 2, "0"), F.lit(":00"))).when(k == 1, F.concat(h, F.lit(":00")))
               .when(k == 2, h).when(k == 3, F.lit("25:00")).when(k == 4, F.lit("x")).otherwise(F.lit(" 7 ")))
    date_text = (F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, F.date_format(d, "MM/dd/yyyy"))
                 .when(k == 2, F.date_format(d, "M/d/yyyy")).when(k == 3, F.date_format(d, "yyyy-M-d"))
                 .when(k == 4, F.lit("13/45/2020")).otherwise(F.date_format(d, "dd.MM.yyyy")))
    flag_text = (F.when(k == 0, F.lit("Y")).when(k == 1, F.lit(" n ")).when(k == 2, F.lit("TRUE"))
                 .when(k == 3, F.lit("")).when(k == 4, F.lit("maybe")).otherwise(F.lit(None).cast("string")))
    flag, flag_problem = P.to_flag(flag_text)
    return o.select("o_orderkey", he_text.alias("he_text"), T.parse_hour_ending(he_text).alias("hour_ending"),
                    date_text.alias("date_text"), T.parse_delivery_date(date_text).alias("delivery_date"),
                    flag.alias("flag"), flag_problem.alias("flag_problem"))


# --- declared transforms (JOB05 EXT01 PRJ01-PRJ08 FN04) --------------------------------------

from asofspark.plans import transform as TR  # noqa: E402
from asofspark.plans.declare import Declaration  # noqa: E402

SPP_DECL = Declaration(
    product="li-prices", table="spp", interval_minutes=60, time_style="hour_ending",
    columns={"delivery_date": "DeliveryDate", "hour_ending": "HourEnding", "point": "SettlementPoint",
             "point_type": "SettlementPointType", "price": "SettlementPointPrice",
             "repeated_flag": "DSTFlag"},
    api_columns={"delivery_date": "deliveryDate", "hour_ending": "hourEnding", "point": "settlementPoint",
                 "point_type": "settlementPointType", "price": "settlementPointPrice", "repeated_flag": "DSTFlag"})

MCPC_DECL = Declaration(
    product="li-as-prices", table="mcpc", interval_minutes=15, time_style="hour_interval",
    columns={"delivery_date": "DeliveryDate", "hour_ending": "DeliveryHour", "interval": "DeliveryInterval",
             "repeated_flag": "RepeatedHourFlag", "as_type": "ASType", "mcpc": "MCPC"})

SERIES_DECL = Declaration(
    product="li-measures", table="series", interval_minutes=5, time_style="sced_timestamp",
    columns={"run_stamp": "SCEDTimestamp", "quantity": "Quantity", "price": "ExtendedPrice",
             "discount": "Discount", "tax": "Tax", "in_use": "InUseFlag"},
    series={"quantity": "quantity", "price": "price", "discount": "discount", "tax": "tax"})

SERIES_IN_USE = Declaration(
    product="li-measures", table="series", interval_minutes=5, time_style="sced_timestamp",
    columns=dict(SERIES_DECL.columns), series=dict(SERIES_DECL.series), keep_flag="in_use")

PREFIX_DECL = Declaration(
    product="part-prices", table="spp", interval_minutes=60, time_style="hour_ending",
    columns={"delivery_date": "DeliveryDate", "hour_ending": "HourEnding", "point": "SettlementPoint",
             "price": "SettlementPointPrice"},
    keep_point_prefixes=("Brand#1", "Brand#2"))

_SPP_HEADER = ["DeliveryDate", "HourEnding", "SettlementPoint", "SettlementPointType",
               "SettlementPointPrice", "DSTFlag"]


def _li_spp_records(spark, sf):
    """lineitem as CSV-like postings of an hourly price report; odd postings carry an extra
    column (drift); in postings divisible by 5, line 7 lost its last cell."""
    li = read(spark, sf, "lineitem")
    posting = (F.col("l_orderkey") % 400).cast("int")
    cells = [
        F.date_format("l_shipdate", "MM/dd/yyyy"),
        F.concat(F.lpad((1 + (F.col("l_linenumber") * 5 + F.col("l_partkey")) % 24).cast("string"), 2, "0"), F.lit(":00")),
        F.concat(F.lit("  P"), F.col("l_suppkey").cast("string")),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).otherwise(F.lit(" ")),
        F.concat(F.lit(" "), F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string")),
        F.when(F.col("l_partkey") % 997 == 0, F.lit("Y")).otherwise(F.lit("N")),
    ]
    full = F.array(*cells)
    short = F.slice(full, 1, 5)
    extra = F.concat(full, F.array(F.lit("x")))
    odd = posting % 2 == 1
    cut = (posting % 5 == 0) & (F.col("l_linenumber") == 7)
    # the full cell list is built once, then cut or extended per posting
    li = li.select("*", posting.alias("posting"), full.alias("__full"))
    full, posting = F.col("__full"), F.col("posting")
    short = F.slice(full, 1, 5)
    extra = F.concat(full, F.array(F.lit("x")))
    odd = posting % 2 == 1
    cut = (posting % 5 == 0) & (F.col("l_linenumber") == 7)
    return li.select(
        posting.alias("posting"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), posting)).alias("posted_at"),
        (F.lit("2024-01-01 00:02:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), posting)).alias("ingested_at"),
        F.when(odd, F.array(*[F.lit(h) for h in _SPP_HEADER + ["Extra"]]))
        .otherwise(F.array(*[F.lit(h) for h in _SPP_HEADER])).alias("header"),
        F.when(cut, short).when(odd, extra).otherwise(full).alias("cells"),
        "l_orderkey", "l_linenumber",
    )


def _blank_null(c):
    return F.when(F.trim(c) != "", F.trim(c))


@query
def declared_transform(spark, sf):
    rec = _li_spp_records(spark, sf)
    rows = TR.transform(rec, SPP_DECL).withColumn("settlement_point_type", _blank_null(F.col("settlement_point_type")))
    status = TR.posting_status(rows, TR.check_columns(rec, SPP_DECL))
    return TR.accepted(rows, status)


@query
def drift_report(spark, sf):
    rec = _li_spp_records(spark, sf)
    rows = TR.transform(rec, SPP_DECL)
    drift = TR.check_columns(rec, SPP_DECL)
    status = TR.posting_status(rows, drift)
    return drift.drop("problem").join(status.select("posting", "n_problems", "problem", "status"), on="posting")


@query
def spp_from_lineitem(spark, sf):
    rec = _li_spp_records(spark, sf)
    rows = TR.transform(rec, SPP_DECL)
    return rows.select("posting", "interval_start", "settlement_point",
                       _blank_null(F.col("settlement_point_type")).alias("settlement_point_type"),
                       "price_mwh", "dst_flag", "problem")


# Fixed values for the synthetic ancillary-type cells: five known spellings and one unknown.
_AS_SPELLINGS = (" regup", "REGDN ", "rrs", "Ecrs", "nspin", "other")


@query
def mcpc_domain(spark, sf):
    li = read(spark, sf, "lineitem")
    k = F.col("l_linenumber") % 6
    as_text = F.lit(_AS_SPELLINGS[5])
    for i in range(5, -1, -1):
        as_text = F.when(k == i, F.lit(_AS_SPELLINGS[i])).otherwise(as_text)
    header = F.array(*[F.lit(c) for c in MCPC_DECL.expected_header])
    cells = F.array(F.date_format("l_shipdate", "yyyy-MM-dd"), (1 + F.col("l_suppkey") % 24).cast("string"),
                    (1 + F.col("l_partkey") % 4).cast("string"), F.lit("N"), as_text,
                    F.col("l_quantity").cast("bigint").cast("string"))
    rec = li.select(F.col("l_orderkey").alias("posting"), F.lit(None).cast("timestamp_ntz").alias("posted_at"),
                    F.lit(None).cast("timestamp_ntz").alias("ingested_at"), header.alias("header"),
                    cells.alias("cells"), "l_linenumber")
    rows = TR.transform(rec, MCPC_DECL)
    return rows.select(F.col("posting").alias("l_orderkey"), "interval_start", "as_type", "mcpc_mw", "problem")


def _li_series_records(spark, sf, blanks: bool):
    li = read(spark, sf, "lineitem")
    stamp_ = F.date_format(F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("l_orderkey") % 1440).cast("int"),
                                                                    (F.col("l_partkey") % 60).cast("int")), "MM/dd/yyyy HH:mm:ss")

    def num(c):
        txt = F.round(F.col(c) * 100).cast("bigint").cast("string")
        return F.when(F.col(c) == 0, F.lit("  ")).otherwise(txt) if blanks else txt
    flag = F.when(F.col("l_returnflag") == "R", F.lit("Y")).when(F.col("l_returnflag") == "A", F.lit("n")).otherwise(F.lit(""))
    header = F.array(*[F.lit(c) for c in SERIES_DECL.expected_header])
    cells = F.array(stamp_, num("l_quantity"), num("l_extendedprice"), num("l_discount"), num("l_tax"), flag)
    return li.select(F.col("l_orderkey").alias("posting"), F.lit(None).cast("timestamp_ntz").alias("posted_at"),
                     F.lit(None).cast("timestamp_ntz").alias("ingested_at"), header.alias("header"),
                     cells.alias("cells"), "l_linenumber")


@query
def melt_series(spark, sf):
    rows = TR.transform(_li_series_records(spark, sf, False), SERIES_DECL, carry=["l_linenumber"])
    return rows.select(F.col("posting").alias("l_orderkey"), "l_linenumber", "interval_start", "series", "value")


@query
def melt_skip_blank(spark, sf):
    rows = TR.transform(_li_series_records(spark, sf, True), SERIES_DECL, carry=["l_linenumber"])
    return rows.select(F.col("posting").alias("l_orderkey"), "l_linenumber", "interval_start", "series", "value")


@query
def flag_filter(spark, sf):
    rows = TR.transform(_li_series_records(spark, sf, False), SERIES_IN_USE, carry=["l_linenumber"])
    return rows.select(F.col("posting").alias("l_orderkey"), "l_linenumber", "series", "value", "problem")


@query
def prefix_filter(spark, sf):
    p = read(spark, sf, "part")
    header = F.array(*[F.lit(c) for c in PREFIX_DECL.expected_header])
    cells = F.array(F.concat(F.lit("2024-03-"), F.lpad((1 + F.col("p_partkey") % 28).cast("string"), 2, "0")),
                    (1 + F.col("p_size") % 24).cast("string"), F.concat(F.lit(" "), F.col("p_brand")),
                    F.round(F.col("p_retailprice") * 100).cast("bigint").cast("string"))
    rec = p.select(F.col("p_partkey").alias("posting"), F.lit(None).cast("timestamp_ntz").alias("posted_at"),
                   F.lit(None).cast("timestamp_ntz").alias("ingested_at"), header.alias("header"), cells.alias("cells"))
    rows = TR.transform(rec, PREFIX_DECL)
    return rows.select(F.col("posting").alias("p_partkey"), "interval_start", "settlement_point", "price_mwh", "problem")


# --- checks, calendars and monitoring (AGG01-AGG12, SET02-SET04, JOB10-JOB18, WIN03-WIN05) ---

from asofspark.operators import alarms as AL  # noqa: E402
from asofspark.operators import checks as CK  # noqa: E402
from asofspark.operators import progress as PG  # noqa: E402
from asofspark.operators.sample import sample as sample_rows  # noqa: E402
from asofspark.plans import monitor as MO  # noqa: E402
from asofspark.plans import quality as QR  # noqa: E402

NOW = "2024-01-20 12:00:00"
END = "2024-01-31 00:00:00"


@query
def repeated_keys(spark, sf):
    li = read(spark, sf, "lineitem")
    return CK.repeated_keys(li, key=["l_orderkey", "l_linenumber"], by="l_returnflag")


@query
def duplicate_posting_keys(spark, sf):
    li = read(spark, sf, "lineitem")
    return CK.duplicate_keys(li, key=["l_orderkey", "l_linenumber"], posted="l_shipdate", limit=5)


@query
def zone_sum_findings(spark, sf):
    li = read(spark, sf, "lineitem").select(F.col("l_orderkey").alias("order_key"),
                                            F.col("l_extendedprice").alias("value"), F.lit("zone").alias("kind"))
    o = read(spark, sf, "orders").select(F.col("o_orderkey").alias("order_key"),
                                         F.col("o_totalprice").alias("value"), F.lit("total").alias("kind"))
    f = CK.sum_findings(li.unionByName(o), by="order_key", part=F.col("kind") == "zone",
                        total=F.col("kind") == "total", value="value", expected_parts=7)
    return f.select("order_key", F.round("parts_sum", 2).alias("parts_sum"), "total", "n_parts")


def _damaged_lineitem(spark, sf):
    li = read(spark, sf, "lineitem")
    return li.select(
        F.concat(F.lit("year="), F.year("l_shipdate").cast("string")).alias("file"),
        F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")).alias("l_returnflag"),
        F.when(F.col("l_discount") != 0.0, F.col("l_discount")).alias("l_discount"),
        F.when(F.col("l_tax") != 0.08, F.col("l_tax")).alias("l_tax"),
        "l_quantity",
    )


@query
def null_audit(spark, sf):
    return CK.null_audit(_damaged_lineitem(spark, sf), ["l_returnflag", "l_discount", "l_tax", "l_quantity"], by="file")


@query
def version_audit(spark, sf):
    e = read(spark, sf, "events").select(
        F.to_date("ts").cast("string").alias("file"),
        (1 + (F.col("event_id") % 50 == 0).cast("int")).alias("schema_version"))
    return CK.version_audit(e, supported=(1,), by="file")


@query
def calendar_gaps(spark, sf):
    o = read(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day"))
    return CK.calendar_gaps(o, day="day")


def _events_present(spark, sf, minutes=15):
    e = read(spark, sf, "events")
    sec = minutes * 60
    slot = F.timestamp_seconds(F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / sec) * sec).cast("timestamp_ntz")
    return e.select(F.lit("events").alias("product"), slot.alias("interval_start"), "event_type", "ts")


def _coverage_15min(spark, sf):
    present = _events_present(spark, sf)
    days = present.select(T.delivery_date("interval_start").alias("d")).agg(
        F.min("d").alias("lo"), F.max("d").alias("hi"))
    days = days.select(F.lit("events").alias("product"), F.lit(15).alias("interval_minutes"),
                       F.explode(F.sequence("lo", "hi")).alias("delivery_date"))
    return MO.coverage(MO.calendar(days), present)


@query
def coverage_15min(spark, sf):
    return _coverage_15min(spark, sf).select("product", "delivery_date", "expected", "present", "n_missing")


@query
def missing_text(spark, sf):
    c = _coverage_15min(spark, sf)
    return c.select("delivery_date", MO.missing_text("missing", 8).alias("missing_text"))


@query
def findings_limit(spark, sf):
    c = _coverage_15min(spark, sf).filter(F.col("n_missing") > 0)
    return c.orderBy("delivery_date").limit(5).select("delivery_date", "n_missing",
                                                      MO.missing_text("missing", 4).alias("missing_text"))


# The coverage configuration of the event "products" (name, cadence, grain).
_EVENT_PRODUCTS = [("click", "intraday", 15), ("view", "hourly", 60), ("purchase", "daily_after", 60),
                   ("signup", "daily_ahead", 60), ("error", "intraday", 5)]


@query
def coverage_actionable(spark, sf):
    cfg = spark.createDataFrame(_EVENT_PRODUCTS, "product string, cadence string, interval_minutes int")
    days = cfg.select("*", F.explode(F.array(*MO.report_days(NOW))).alias("delivery_date"))
    expected = MO.expected_slots(MO.calendar(days), NOW)
    e = read(spark, sf, "events")
    minutes = cfg.select(F.col("product").alias("event_type"), "interval_minutes")
    sec = F.col("interval_minutes") * 60
    present = e.join(F.broadcast(minutes), on="event_type").select(  # the config is a handful of rows
        F.col("event_type").alias("product"),
        F.timestamp_seconds(F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / sec) * sec).cast("timestamp_ntz").alias("interval_start"))
    c = MO.coverage(expected, present, now=NOW)
    return c.select("product", "delivery_date", "unit", "expected", "present", "n_missing",
                    F.size("actionable").alias("n_actionable"),
                    MO.missing_text("actionable", 4).alias("actionable_text"))


@query
def posting_hours(spark, sf):
    e = read(spark, sf, "events")
    return MO.posting_hours(e, at="ts", by="event_type").withColumnRenamed("event_type", "product")


# Freshness thresholds in minutes (one configured name has no data at all).
_THRESHOLDS = [("click", 60), ("view", 120), ("purchase", 30), ("signup", 1440), ("error", 15), ("refund", 60)]


def _freshness(spark, sf):
    cfg = spark.createDataFrame(_THRESHOLDS, "name string, stale_after_min int").withColumn("kind", F.lit("product"))
    e = read(spark, sf, "events")
    seen = e.groupBy(F.col("event_type").alias("name")).agg(F.max("ts").alias("last_seen")).withColumn(
        "problem", F.lit(None).cast("string"))
    return MO.freshness(cfg, seen, END)


@query
def freshness(spark, sf):
    return _freshness(spark, sf)


def _state_objects(spark, sf):
    """Manifest and heartbeat objects as text: one per event type, some broken, without a time, or absent."""
    e = read(spark, sf, "events").groupBy(F.col("event_type").alias("name")).agg(F.max("ts").alias("ts"), F.count(F.lit(1)).alias("n"))
    at = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = (F.when(F.col("name") == "view", F.concat(F.lit('{"last_posted_at": "'), at, F.lit('"')))
            .when(F.col("name") == "error", F.lit('{"last_posted_at": "yesterday"}'))
            .when(F.col("name") == "signup", F.concat(F.lit('{"docs": '), F.col("n").cast("string"), F.lit("}")))
            .otherwise(F.concat(F.lit('{"last_posted_at": "'), at, F.lit('+00:00"}'))))
    return e.select("name", text.alias("value"))


@query
def freshness_objects(spark, sf):
    cfg = spark.createDataFrame(_THRESHOLDS, "name string, stale_after_min int").withColumn("kind", F.lit("product"))
    seen = MO.seen_from_objects(_state_objects(spark, sf))
    return MO.freshness(cfg, seen, END)


@query
def stale_count(spark, sf):
    return MO.freshness_metrics(_freshness(spark, sf))


def _postings(spark, sf):
    e = read(spark, sf, "events")
    return e.select(F.col("event_type").alias("product"), F.col("event_id").alias("doc_id"),
                    F.col("ts").alias("posted_at"), (F.col("event_id") % 997 == 0).alias("bad"),
                    F.get_json_object("props", "$.k").cast("bigint").alias("n_rows"),
                    T.delivery_date("ts").alias("date"),
                    F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("interval_start"))


@query
def run_summary(spark, sf):
    return PG.run_summary(_postings(spark, sf), n_rows="n_rows")


@query
def safe_progress(spark, sf):
    return PG.safe_progress(_postings(spark, sf))


def _nation_state(spark, sf):
    n = read(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("product"))
    c = read(spark, sf, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("nc"))
    s = read(spark, sf, "supplier").groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("ns"))
    base = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    prev = n.join(c, n.n_nationkey == c.c_nationkey).select(
        "product", (base + F.make_dt_interval(F.lit(0), F.lit(0), F.col("nc").cast("int"))).alias("last_posted_at"),
        (base + F.make_dt_interval(F.lit(0), F.lit(1))).alias("last_run_at"),
        F.when(F.col("nc") % 5 == 0, F.lit("error")).otherwise(F.lit("ok")).alias("status"),
        F.when(F.col("nc") % 5 == 0, F.concat(F.lit("failed after "), F.col("nc").cast("string"))).alias("error"),
        "n_nationkey")
    run = n.join(s, n.n_nationkey == s.s_nationkey).select(
        "product",
        F.when(F.col("n_nationkey") % 4 == 0, F.lit(None).cast("timestamp_ntz"))
        .otherwise(base + F.make_dt_interval(F.lit(0), F.col("ns").cast("int"))).alias("last_posted_at"),
        (base + F.make_dt_interval(F.lit(1))).alias("run_at"),
        F.when(F.col("n_nationkey") % 3 == 0, F.lit("error")).otherwise(F.lit("ok")).alias("status"),
        F.when(F.col("n_nationkey") % 3 == 0, F.lit("drift")).alias("error"),
        F.col("ns").alias("docs"), "n_nationkey")
    return prev, run


@query
def watermark_merge(spark, sf):
    prev, run = _nation_state(spark, sf)
    return PG.merge_watermarks(prev, run)


@query
def manifest_carry(spark, sf):
    prev, run = _nation_state(spark, sf)
    p = prev.select("product", "last_posted_at",
                    F.col("last_run_at").alias("latest_interval_start"),
                    F.col("n_nationkey").cast("string").alias("partitions"))
    r = run.select("product", "run_at", F.when(F.col("n_nationkey") % 2 == 0, F.lit(0)).otherwise(F.col("docs")).alias("docs"),
                   (F.col("docs") * 10).alias("rows"), "last_posted_at",
                   F.col("run_at").alias("latest_interval_start"), F.lit("new").alias("partitions"))
    return PG.carry_manifest(p, r)


@query
def catalog_retire(spark, sf):
    n = read(spark, sf, "nation")
    config = n.filter(F.col("n_regionkey") != 0).select(F.col("n_name").alias("product"), F.lit("series").alias("table"))
    manifests = n.filter(F.col("n_nationkey") % 2 == 0).select(F.col("n_name").alias("product"))
    previous = n.filter(F.col("n_nationkey") < 10).select(F.col("n_name").alias("product"), F.lit("spp").alias("table"))
    return PG.build_catalog(config, manifests, previous)


@query
def sample_rule(spark, sf):
    li = read(spark, sf, "lineitem").select(
        "l_suppkey", "l_orderkey", "l_linenumber",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("interval_key"),
        F.when(F.col("l_partkey") % 10 == 0, F.concat(F.lit("HB_"), F.col("l_partkey").cast("string")))
        .when(F.col("l_partkey") % 10 == 1, F.concat(F.lit("LZ_"), F.col("l_partkey").cast("string")))
        .otherwise(F.concat(F.lit("N"), F.col("l_partkey").cast("string"))).alias("point"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line_no"))
    return sample_rows(li, file="l_suppkey", order="line_no", interval="interval_key", point="point")


@query
def sample_complete(spark, sf):
    """The sample job over a file per part: which of its samples are known to be whole."""
    from asofspark.operators.sample import sample_job

    li = read(spark, sf, "lineitem").select(
        "l_partkey", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line_no"), F.date_format("l_shipdate", "yyyy").alias("year"),
        F.concat(F.lit("N"), F.col("l_suppkey").cast("string")).alias("point"))
    first = li.groupBy("l_partkey", "line_no").agg(F.min(F.struct("year", "point")).alias("r")).select("l_partkey", "line_no", "r.*")
    return sample_job(first, file="l_partkey", order="line_no", interval="year", point="point", others=1)


def _error_log(spark, sf):
    e = read(spark, sf, "events").filter(F.col("event_type") == "error")
    raw = F.when(F.col("event_id") % 2 == 0,
                 F.concat(F.lit('{"level": "ERROR", "message": "run   failed\\tk='),
                          F.get_json_object("props", "$.k"), F.lit(' for user '), F.col("user_id").cast("string"), F.lit('"}'))
                 ).otherwise(F.concat(F.lit("plain  error line "), F.col("props")))
    return e.select(F.col("ts").alias("at"), raw.alias("raw"), "event_id")


@query
def error_digest(spark, sf):
    return MO.error_digest(_error_log(spark, sf), "2024-01-29 00:00:00", END)


def _metrics(spark, sf):
    e = read(spark, sf, "events")
    return e.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("at")).agg(
        F.count(F.lit(1)).alias("invocations"), F.count_if(F.col("event_type") == "error").alias("errors"))


@query
def error_rate(spark, sf):
    return MO.run_stats(_metrics(spark, sf), "2024-01-24 00:00:00", END)


@query
def closest_to_limit(spark, sf):
    e = read(spark, sf, "events")
    peaks = e.groupBy(F.col("event_type").alias("name")).agg(F.max("value").alias("peak"))
    th = spark.createDataFrame(_THRESHOLDS, "name string, stale_after_min int")
    return MO.closest_to_limit(peaks, th).select("name", "peak", "stale_after_min", F.round("ratio", 6).alias("ratio"))


@query
def kpis(spark, sf):
    yesterday = F.date_sub(T.delivery_date(F.lit(NOW).cast("timestamp_ntz")), 1)
    st = MO.run_stats(_metrics(spark, sf), "2024-01-19 12:00:00", NOW)
    hourly = _coverage_15min(spark, sf).select(  # posting hours, which the percentage leaves out
        F.lit("hourly").alias("product"), "delivery_date", F.lit("postings").alias("unit"), "expected", "n_missing")
    rows = _coverage_15min(spark, sf).select("product", "delivery_date", F.lit("intervals").alias("unit"), "expected", "n_missing")
    peaks = read(spark, sf, "events").groupBy(F.col("event_type").alias("name")).agg(F.max("value").alias("peak"))
    closest = MO.closest_to_limit(peaks, spark.createDataFrame(_THRESHOLDS, "name string, stale_after_min int"))
    fired = AL.alarm_transitions(_alarm_history(spark, sf), "ingest-", "2024-01-19 12:00:00", NOW)
    return MO.kpis(rows.unionByName(hourly), st, yesterday, transitions=fired, closest=closest, sections=_sections(spark, sf))


@query
def alarm_states(spark, sf):
    e = read(spark, sf, "events").filter(F.col("event_type") == "error")
    m = e.select(F.lit("ingest-errors").alias("metric"), F.col("ts").alias("at"), "value")
    return AL.alarm_states(m, period_minutes=5, points=3, threshold=25.0, missing_breaching=True)


@query
def alarm_states_silent(spark, sf):
    """The second rule: few purchases in an hour, judged up to now, long after the last datapoint."""
    e = read(spark, sf, "events").filter(F.col("event_type") == "purchase")
    m = e.select(F.concat(F.lit("no-sales-"), (F.col("user_id") % 3).cast("string")).alias("metric"), F.col("ts").alias("at"),
                 (-F.lit(1.0)).alias("value"))
    return AL.alarm_states(m, period_minutes=60, points=2, threshold=-3.5, missing_breaching=True, stat="sum",
                           now="2024-02-03 10:30:00")


@query
def alarm_transitions(spark, sf):
    e = read(spark, sf, "events").filter(F.col("event_type") == "error")
    k = F.get_json_object("props", "$.k")
    data = F.concat(F.lit('{"oldState": {"stateValue": "'),
                    F.when(F.col("event_id") % 2 == 0, F.lit("OK")).otherwise(F.lit("ALARM")),
                    F.lit('"}, "newState": {"stateValue": "'),
                    F.when(F.col("event_id") % 2 == 0, F.lit("ALARM")).otherwise(F.lit("OK")),
                    F.lit('", "stateReason": "k='), k, F.lit('"}}'))
    hist = e.select(F.concat(F.when(F.col("user_id") % 3 == 0, F.lit("other-")).otherwise(F.lit("ingest-")),
                             F.col("user_id").cast("string")).alias("alarm"), F.col("ts").alias("at"), data.alias("data"))
    return AL.alarm_transitions(hist, "ingest-", "2024-01-10 00:00:00", "2024-01-20 00:00:00")


@query
def newest_batch(spark, sf):
    e = read(spark, sf, "events").select(
        T.delivery_date("ts").alias("date"),
        F.concat(F.lit("part-"), F.date_format(F.date_trunc("hour", "ts"), "yyyyMMdd'T'HHmmss'Z'")).alias("batch")).distinct()
    w = __import__("pyspark.sql", fromlist=["Window"]).Window.partitionBy("date")
    return e.withColumn("newest", F.col("batch") == F.max("batch").over(w))


@query
def union_by_name(spark, sf):
    s = read(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
                                           F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"))
    c = read(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
                                           F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nationkey"))
    return s.unionByName(c, allowMissingColumns=True)


# The contract the derived file schemas are checked against, in column order.
_FILE_CONTRACT = [("c1", "double"), ("c2", "double"), ("c3", "double"), ("c4", "double"),
                  ("c5", "double"), ("c6", "double"), ("c7", "double")]


@query
def symmetric_diff(spark, sf):
    """SET03: every order is a "file" whose columns are its line items (name, type and
    position derived from the row), checked against a seven-column contract."""
    li = read(spark, sf, "lineitem")
    n = F.col("l_linenumber").cast("string")
    cols = li.select(
        F.col("l_orderkey").alias("file"),
        F.when(F.col("l_quantity") > 48, 8 - F.col("l_linenumber")).otherwise(F.col("l_linenumber")).alias("position"),
        F.when(F.col("l_discount") >= 0.09, F.concat(F.lit("extra_"), n)).otherwise(F.concat(F.lit("c"), n)).alias("column"),
        F.when(F.col("l_tax") > 0.07, F.lit("string")).otherwise(F.lit("double")).alias("type"))
    return CK.schema_diff(cols, _FILE_CONTRACT, by="file")


@query
def delivery_range(spark, sf):
    log = event_log(spark, sf).withColumnRenamed("day", "date")
    return pit.delivery_between(log, "2024-01-07", "2024-01-09", col="date")


@query
def version_gate(spark, sf):
    e = read(spark, sf, "events").select((1 + (F.col("event_id") % 50 == 0).cast("int")).alias("schema_version"))
    return pit.version_counts(e, supported=(1,))


@query
def typed_empty(spark, sf):
    log = event_log(spark, sf)
    return pit.latest_as_of(log, key=KEY, posted="posted_at", as_of="2023-12-31 00:00:00")


@query
def quality_rules(spark, sf):
    """JOB17 over events snapped to the 15-minute grid and orders against their line items."""
    grid = QR.on_grid(_events_present(spark, sf), 15)
    li = read(spark, sf, "lineitem").select("l_orderkey", "l_shipdate", "l_extendedprice")
    o = read(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    plaus = QR.delivery_after_posting(j, "l_shipdate", "o_orderdate")
    per = j.groupBy("o_orderkey").agg(F.sum("l_extendedprice").alias("s"), F.first("o_totalprice").alias("t"))
    e = read(spark, sf, "events").select(
        F.concat(F.when(F.col("user_id") % 3 == 0, F.lit("HB_")).otherwise(F.lit("N")), F.col("user_id").cast("string")).alias("point"), "event_id")
    formats = {"archive": e.filter("event_id % 5 < 3"), "api": e.filter("event_id % 5 > 1")}
    return (grid.unionByName(plaus).unionByName(QR.total_within_tolerance(per, "s", "t"))
            .unionByName(QR.same_names(formats, "point", ("HB_", "LZ_"))))


# --- archives, raw landing, curated lake, compaction (SRC01-SRC12, SNK01-SNK02, JOB08) -------

from asofspark import fixtures as FX  # noqa: E402
from asofspark.session import scratch_path  # noqa: E402
from asofspark.sources import archive as AR  # noqa: E402
from asofspark.sources import members as MB  # noqa: E402


def _landed_zips(spark, sf, bundles: bool = False) -> str:
    """Write the event postings (or their monthly bundles) as zip files; return the folder."""
    root = scratch_path(spark, "zips")
    z = FX.posting_zips(spark, sf)
    if bundles:
        z = FX.bundle_zips(z)
    AR.export_files(z, root).write.format("noop").mode("overwrite").save()
    return root


@query
def posting_zip_scan(spark, sf):
    root = _landed_zips(spark, sf)
    rec = AR.member_posting(AR.csv_records(AR.read_archives(spark, root)))
    return FX.typed_events(rec).select("event_id", "ts", "user_id", "event_type", "value", "posted_local")


def _bundle_records(spark, root):
    """The data lines of all bundles, read member by member in slices of 32 KB: several tasks a bundle."""
    rec = MB.read_members(spark, root, size=32 << 10)
    return rec.filter(F.col("cells").isNotNull()).drop("problem")


@query
def bundle_scan(spark, sf):
    root = _landed_zips(spark, sf, bundles=True)
    rec = AR.member_posting(_bundle_records(spark, root))
    rec = rec.filter(F.col("posted_local").isNotNull())
    return FX.typed_events(rec).select("event_id", "ts", "user_id", "event_type", "value", "posted_local", "doc_id")


@query
def bundle_window(spark, sf):
    """The postings of all bundles published in ten days."""
    root = _landed_zips(spark, sf, bundles=True)
    rec = AR.member_posting(_bundle_records(spark, root))
    return AR.bundle_postings(rec, "2024-01-10 00:00:00", "2024-01-20 00:00:00").select("doc_id", "posted_at", "n_lines")


from asofspark.plans import compact as CP  # noqa: E402
from asofspark.sources import lake as LK  # noqa: E402


def _curated_events(spark, sf):
    """events as a curated ``series`` table: one series per user, hourly intervals, each event a
    posting of its hour's value; postings of one type and UTC day form one batch."""
    e = read(spark, sf, "events")
    rows = e.select(
        F.concat(F.lit("ev-"), F.col("event_type")).alias("product"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("interval_start"),
        F.lit(60).alias("interval_minutes"),
        F.col("ts").alias("posted_at"),
        (F.col("ts") + F.expr("INTERVAL 2 MINUTES")).alias("ingested_at"),
        F.lit("archive").alias("source"), F.lit(1).alias("schema_version"), F.lit(False).alias("dst_flag"),
        F.concat(F.lit("user:"), F.col("user_id").cast("string")).alias("series"), "value")
    return LK.with_batch(rows).withColumn(
        "batch", F.concat(F.lit("part-"), T.stamp(F.date_trunc("day", "posted_at").cast("timestamp_ntz"))))


def _written_lake(spark, sf, twice=False):
    root = scratch_path(spark, "lake")
    rows = _curated_events(spark, sf)
    LK.write_curated(rows, root)
    if twice:
        LK.write_curated(rows, root)
    return root


@query
def curated_roundtrip(spark, sf):
    root = _written_lake(spark, sf, twice=True)
    return spark.read.parquet(f"{root}/curated").select(
        "product", "date", "batch", "interval_start", "posted_at", "series", "value")


@query
def raw_roundtrip(spark, sf):
    root = scratch_path(spark, "raw")
    z = FX.posting_zips(spark, sf).select(
        F.concat(F.lit("ev-"), F.col("event_type")).alias("product"),
        T.local_to_utc("posted_local").alias("posted_at"), F.col("member").alias("name"), "content")
    LK.land_raw(z, root)
    LK.land_raw(z, root)  # a replay replaces its own directories
    raw = LK.read_raw(spark, root)
    rec = AR.csv_records(raw.select(F.col("name").alias("path"), "content"))
    return FX.typed_events(rec).select("event_id", "ts", "user_id", "event_type", "value")


@query
def scan_days(spark, sf):
    import datetime as _dt
    root = _written_lake(spark, sf)
    df = LK.scan_days(spark, root, "ev-click", _dt.date(2024, 1, 7), _dt.date(2024, 1, 9))
    return pit.latest_as_of(df, key=["interval_start", "series"], posted="posted_at", tie="ingested_at",
                            as_of="2024-01-09 12:00:00").select("date", "interval_start", "series", "posted_at", "value")


import datetime as _datetime  # noqa: E402

from asofspark.plans.read import Lake, read_curated  # noqa: E402

_UTC = _datetime.UTC
_DT = _datetime.datetime
_MONTH = (_DT(2024, 1, 1, 6, tzinfo=_UTC), _DT(2024, 2, 1, 6, tzinfo=_UTC))  # January in Central time


def _event_lake_reads(spark, sf, read):
    root = _written_lake(spark, sf)
    lake = Lake(spark, root, {f"ev-{t}": "series" for t in FX.EVENT_TYPES})
    parts = [read(lake, f"ev-{t}").withColumn("product", F.lit(f"ev-{t}")) for t in FX.EVENT_TYPES]
    return reduce(DataFrame.unionByName, parts)


@query
def lake_by_range(spark, sf):
    """JOB02 through the reader: each product's January (CT) as known on 2024-01-20."""
    as_of = _DT(2024, 1, 20, tzinfo=_UTC)
    df = _event_lake_reads(spark, sf, lambda lake, p: lake.by_range(p, *_MONTH, as_of=as_of))
    return df.select("product", "interval_start", "series", "posted_at", "value")


@query
def lake_postings(spark, sf):
    """JOB03 through the reader: every version known on 2024-01-20, no dedupe."""
    as_of = _DT(2024, 1, 20, tzinfo=_UTC)
    df = _event_lake_reads(spark, sf, lambda lake, p: lake.postings(p, *_MONTH, as_of=as_of))
    return df.select("product", "interval_start", "series", "posted_at", "ingested_at", "value")


@query
def file_listing(spark, sf):
    root = _written_lake(spark, sf)
    files = LK.list_files(spark, f"{root}/curated").select(*LK.path_parts("path"))
    return files.groupBy("product", "date").agg(F.count_distinct("batch").alias("n_batches"))


@query
def path_parts(spark, sf):
    root = _written_lake(spark, sf)
    files = LK.list_files(spark, f"{root}/curated").select(*LK.path_parts("path"))
    return files.select("product", "date", "batch", "kind", "stamp").distinct()


_COMPACT_NOW = "2100-01-01 00:00:00"  # every written file is older than an hour by then


@query
def compaction_summary(spark, sf):
    root = _written_lake(spark, sf)
    return CP.compact(spark, root, now=_COMPACT_NOW, key=["interval_start", "series"])


@query
def compaction_identity(spark, sf):
    root = _written_lake(spark, sf)
    CP.compact(spark, root, now=_COMPACT_NOW, key=["interval_start", "series"])
    lake = spark.read.parquet(f"{root}/curated")
    return pit.latest_as_of(lake, key=["product", "interval_start", "series"], posted="posted_at",
                            tie="ingested_at", as_of="2024-01-20 00:00:00").select(
        "product", "interval_start", "series", "posted_at", "value")


@query
def compaction_off_contract(spark, sf):
    """A lake in which the clicks of one day have a column more and the views of one day another type:
    those partitions are skipped and reported, all other products are merged."""
    root = scratch_path(spark, "lake")
    rows = _curated_events(spark, sf)
    day = F.col("date") == F.lit("2024-01-05").cast("date")
    first = F.col("batch") == F.lit("part-20240105T000000Z")
    more, other = day & first & (F.col("product") == "ev-click"), day & first & (F.col("product") == "ev-view")
    LK.write_curated(rows.filter(~more & ~other), root)
    LK.write_curated(rows.filter(more).withColumn("note", F.lit("x")), root)
    LK.write_curated(rows.filter(other).withColumn("value", F.col("value").cast("string")), root)
    return CP.compact(spark, root, now=_COMPACT_NOW, key=["interval_start", "series"])


@query
def snapshot_reads(spark, sf):
    """One lake with a snapshot log, read before a compaction, while its batches are written and not
    committed, after the commit by a reader pinned before it and by a new one, and after a vacuum."""
    from asofspark.sources import snapshots as SN

    root = _written_lake(spark, sf)
    SN.start(spark, root)
    lake = Lake(spark, root, {f"ev-{t}": "series" for t in FX.EVENT_TYPES})
    as_of, seen = _DT(2024, 1, 20, tzinfo=_UTC), scratch_path(spark, "snapshot-reads")

    def look(phase: str, at: Lake) -> None:
        parts = [at.postings(p, *_MONTH, as_of=as_of).withColumn("product", F.lit(p)) for p in at.tables]
        found = reduce(DataFrame.unionByName, parts).groupBy("product").agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum(F.floor("value")).alias("value_sum"))
        found.write.parquet(f"{seen}/phase={phase}")

    pinned = lake.pinned()
    look("before", lake)
    CP.compact(spark, root, now=_COMPACT_NOW, key=["interval_start", "series"], before_commit=lambda: look("during", lake))
    look("pinned", pinned)
    look("after", lake)
    SN.vacuum(spark, root, now=_COMPACT_NOW)
    look("vacuumed", lake)
    return spark.read.parquet(seen).select("phase", "product", "n_rows", "value_sum")


@query
def indexed_reads(spark, sf):
    """Reads of two days as known early on the second, of some series and of all, through the zone maps of a
    lake's files; each with whether fewer files were opened than are live on those days."""
    from asofspark.sources import fileindex as FI
    from asofspark.sources import snapshots as SN

    root = _written_lake(spark, sf)
    SN.start(spark, root)
    FI.update(spark, root)
    lake = Lake(spark, root, {f"ev-{t}": "series" for t in FX.EVENT_TYPES})
    span = (_DT(2024, 1, 10, 6, tzinfo=_UTC), _DT(2024, 1, 12, 0, tzinfo=_UTC))
    as_of, few = _DT(2024, 1, 11, 0, tzinfo=_UTC), ["user:7", "user:11", "user:404"]
    parts = []
    for p in lake.tables:
        for label, names in (("all", None), ("few", few)):
            opened, live = lake.files(p, *span, as_of=as_of, names=names)
            parts.append(lake.by_range(p, *span, as_of=as_of, names=names).select(
                F.lit(p).alias("product"), F.lit(label).alias("names"), "interval_start", "series", "posted_at", "value",
                F.lit(opened < live).alias("fewer")))
    return reduce(DataFrame.unionByName, parts)


@query
def lake_difference(spark, sf):
    """Two lakes of the same events, the second with a value changed on one day, a batch left out and one more:
    the batches that differ, and their rows in both."""
    a, b = (scratch_path(spark, n) for n in ("lake", "other"))
    rows = _curated_events(spark, sf)
    LK.write_curated(rows, a)
    day = F.col("date") == F.lit("2024-01-12").cast("date")
    one = rows.filter(day & (F.col("product") == "ev-view")).agg(F.min("posted_at")).first()[0]
    changed = F.when((F.col("product") == "ev-view") & (F.col("posted_at") == F.lit(one)), F.col("value") + 1).otherwise(F.col("value"))
    gone = (F.col("product") == "ev-click") & (F.col("batch") == "part-20240108T000000Z")
    again = rows.filter((F.col("product") == "ev-error") & day).withColumn("batch", F.lit("part-20240201T000000Z"))
    LK.write_curated(rows.withColumn("value", changed).filter(~gone).unionByName(again), b)
    return IN.lake_difference(spark, a, b)


@query
def leftover_files(spark, sf):
    li = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_suppkey")
    batches = li.withColumn("batch", F.concat(F.lit("part-"), (F.col("l_suppkey") % 5).cast("string")))
    merged = li.filter(F.col("l_suppkey") % 5 < 3).withColumn("batch", F.lit("merged-x"))
    both = batches.unionByName(merged).drop("l_suppkey").withColumn("newest_merged", F.lit("merged-x"))
    return CP.held_batches(both, batch="batch", merged="newest_merged")


# --- ingestion, backfill, rebuild (JOB06 JOB07 JOB16 WIN05 AGG01 AGG08 SNK03 SNK05) ----------

from asofspark.plans import ingest as IN  # noqa: E402

_INGESTED = "2024-02-01 00:00:00"
_CURATED_COLS = ["product", "interval_start", "settlement_point", "settlement_point_type", "price_mwh",
                 "posted_at", "date", "batch"]


def _ingested_lake(spark, sf):
    root = scratch_path(spark, "ingest")
    LK.land_raw(FX.raw_postings(spark, sf), root)  # postings land first, then are ingested
    raw = LK.read_raw(spark, root).select("product", "posted_at", "doc_id", "name", "content")
    summary = IN.ingest(spark, raw, FX.event_declarations(), root, ingested_at=_INGESTED, land=False)
    return root, raw, summary


@query
def ingest_end_to_end(spark, sf):
    root, _, _ = _ingested_lake(spark, sf)
    return read_curated(spark, root, "spp").select(*_CURATED_COLS)


@query
def ingest_summary(spark, sf):
    _, _, summary = _ingested_lake(spark, sf)
    return summary.select("product", "docs", "rows", "partitions", "last_posted_at", "failed", "stopped_at")


@query
def ingest_manifests(spark, sf):
    root, _, _ = _ingested_lake(spark, sf)
    return IN.read_state(spark, root, "manifests").select(
        "product", F.col("docs").cast("bigint").alias("docs"), F.col("rows").cast("bigint").alias("rows"), "last_posted_at",
        "latest_interval_start")


@query
def ingest_corrupt_posting(spark, sf):
    """One day's postings are cut short (clicks), empty (views) or not zips (errors): those products stop
    there, the others go on."""
    raw = FX.raw_postings(spark, sf)
    day = T.delivery_date("posted_at") == F.lit("2024-01-08").cast("date")
    bad = F.when(F.col("product") == "ev-click", F.expr("substring(content, 1, length(content) div 2)")).when(
        F.col("product") == "ev-view", F.lit(AR.zip_members([("empty.csv", b"")]))).when(
        F.col("product") == "ev-error", F.lit(b"not a zip"))
    raw = raw.withColumn("content", F.when(day, F.coalesce(bad, F.col("content"))).otherwise(F.col("content")))
    summary = IN.ingest(spark, raw, FX.event_declarations(), scratch_path(spark, "ingest"), ingested_at=_INGESTED)
    return summary.select("product", "docs", "rows", "failed", "stopped_at", "last_posted_at")


@query
def backfill_no_watermark(spark, sf):
    root, raw, _ = _ingested_lake(spark, sf)
    before = IN.read_state(spark, root, "watermarks").collect()
    IN.ingest(spark, raw.filter(F.col("posted_at") < F.lit("2024-01-10").cast("timestamp_ntz")),
              FX.event_declarations(), root, ingested_at="2024-02-02 00:00:00", update_progress=False,
              land=False)  # the raw postings are already landed (and are being read)
    after = IN.read_state(spark, root, "watermarks")
    assert sorted(map(tuple, before)) == sorted(map(tuple, after.collect())), "a backfill moved a watermark"
    return after.select("product", "last_posted_at", "status")


@query
def backfill_rows(spark, sf):
    """A lake that has lost its days before 2024-01-08 and gets them back by a backfill of the postings of
    these days: all rows that are there afterwards."""
    root, raw, _ = _ingested_lake(spark, sf)
    kept = scratch_path(spark, "backfill")
    whole = read_curated(spark, root, "spp")
    lost = F.col("date") < F.lit("2024-01-08").cast("date")
    LK.write_curated(whole.filter(~lost), kept)
    window = {"now": END, "explicit": ("2024-01-01 00:00:00", "2024-01-09 12:00:00")}
    IN.ingest(spark, raw, FX.event_declarations(), kept, ingested_at="2024-02-02 00:00:00", update_progress=False, land=False,
              delivery_range=("2024-01-01", "2024-01-07"), window=window)
    assert IN.read_state(spark, kept, "watermarks") is None, "a backfill wrote watermarks"
    return read_curated(spark, kept, "spp").select(*_CURATED_COLS)


@query
def catalog_publish(spark, sf):
    """Two configurations published over the manifests of all event types: one product retires, one is
    new; publishing the second again writes nothing."""
    root = scratch_path(spark, "catalog")
    types = read(spark, sf, "events").select("event_type").distinct()
    IN.write_state(spark, types.select(F.col("event_type").alias("product")), root, "manifests")
    config = types.filter("event_type <> 'signup'").select(F.col("event_type").alias("product"), F.lit("series").alias("table"))
    wrote = [IN.publish_catalog(spark, root, config, generated_at="2024-01-01 00:00:00")]
    config = config.filter("product <> 'view'").unionByName(spark.createDataFrame([("refund", "spp")], "product string, table string"))
    wrote += [IN.publish_catalog(spark, root, config, generated_at=f"2024-01-0{d} 00:00:00") for d in (2, 3)]
    assert wrote == [True, True, False], wrote
    return IN.read_state(spark, root, "catalog")


@query
def rebuild_identity(spark, sf):
    root, _, _ = _ingested_lake(spark, sf)
    target = scratch_path(spark, "rebuild")
    IN.rebuild(spark, root, FX.event_declarations(), target, ingested_at=_INGESTED)
    return read_curated(spark, target, "spp").select(*_CURATED_COLS)


# --- Structured Streaming (STR01-STR07) -------------------------------------------------------

from asofspark.streaming import stream as ST  # noqa: E402


def _drop_zips(spark, sf, landing, before=None, after=None):
    z = FX.posting_zips(spark, sf)
    if before is not None:
        z = z.filter(F.col("day") < F.lit(before).cast("date"))
    if after is not None:
        z = z.filter(F.col("day") >= F.lit(after).cast("date"))
    AR.export_files(z, landing).write.format("noop").mode("overwrite").save()


@query
def stream_ingest(spark, sf):
    landing, root, ckpt = scratch_path(spark, "landing"), scratch_path(spark, "lake"), scratch_path(spark, "ckpt")
    decls = FX.event_declarations()
    _drop_zips(spark, sf, landing, before="2024-01-15")
    ST.stream_ingest(spark, landing, decls, root, ckpt, ingested_at=_INGESTED, product=FX.event_product).awaitTermination()
    _drop_zips(spark, sf, landing, after="2024-01-15")  # the second drop resumes from the checkpoint
    ST.stream_ingest(spark, landing, decls, root, ckpt, ingested_at=_INGESTED, product=FX.event_product).awaitTermination()
    return read_curated(spark, root, "spp").select(*_CURATED_COLS)


def _event_stream(spark, sf):
    schema = read(spark, sf, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


@query
def stream_latest(spark, sf):
    s = _event_stream(spark, sf).select(F.to_date("ts").alias("day"), "user_id", "event_type",
                                        F.col("ts").alias("posted_at"), "event_id", "value")
    out, ckpt = scratch_path(spark, "latest"), scratch_path(spark, "ckpt")
    ST.run_to_table(ST.stream_latest(s, key=list(KEY), posted="posted_at", values=["event_id", "value"]),
                    out, ckpt, "complete")
    return ST.read_table(spark, out, "complete")


@query
def stream_current(spark, sf):
    """Current values per (user, event type) over two triggers: what the first brought in, then everything, of
    which only the keys with newer rows are written."""
    from asofspark.streaming import current as CU

    landing, out, ckpt = (scratch_path(spark, n) for n in ("events", "current", "ckpt"))
    e = read(spark, sf, "events").select("user_id", "event_type", F.col("ts").alias("posted_at"), "event_id", "value")
    early = F.col("posted_at") < F.lit("2024-01-12").cast("timestamp_ntz")
    how = {"key": ["user_id", "event_type"], "posted": "posted_at", "tie": "event_id"}
    for part in (e.filter(early), e.filter(~early)):
        part.write.mode("append").parquet(landing)
        CU.run_current(spark.readStream.schema(e.schema).parquet(landing), out, ckpt, **how)
    return CU.read_current(spark, out, e.schema, **how)


@query
def listing_stream(spark, sf):
    """A listing streamed over two polls: each document once, with the run that took it, and whether the
    second run opened fewer pages than the listing has."""
    from asofspark.sources import listing as LS

    root, out, ckpt = (scratch_path(spark, n) for n in ("listing", "listed", "ckpt"))
    docs = _listing(spark, sf).select("doc_id", "post_local_text", "friendly_name")
    cut = docs.agg(F.expr("max(doc_id) * 3 div 4")).first()[0]
    pages = 0
    for run, part in enumerate((docs.filter(F.col("doc_id") <= cut), docs), 1):
        pages = LS.write_poll(part, root, run, size=100)

        def write(batch, batch_id, run=run):
            batch.withColumn("run", F.lit(run)).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

        LS.stream_listing(spark, root).writeStream.foreachBatch(write).option("checkpointLocation", ckpt).trigger(
            availableNow=True).start().awaitTermination()
    found = spark.read.option("basePath", out).parquet(f"{out}/batch_id=*")
    fewer = found.filter("run = 2").select((F.count_distinct("page") < pages).alias("fewer")).first()[0]
    return found.select("doc_id", "post_local_text", "friendly_name", "run", F.lit(fewer).alias("fewer"))


@query
def stream_hourly_counts(spark, sf):
    s = _event_stream(spark, sf).select("ts", "event_type")
    out, ckpt = scratch_path(spark, "hours"), scratch_path(spark, "ckpt")
    ST.run_to_table(ST.stream_posting_hours(s, at="ts", by="event_type", lateness="1 hour"), out, ckpt, "append")
    return ST.read_table(spark, out, "append")


from asofspark.plans import verify as VF  # noqa: E402


@query
def verify_findings(spark, sf):
    """A curated lake written from events with seeded damage: a missing day, a batch that
    repeats keys, NULLs in a required column, rows at an unknown schema version."""
    rows = _curated_events(spark, sf)
    e_id = F.col("posted_at")  # the event's own time identifies it in the damage rules below
    base = rows.filter(~((F.col("product") == "ev-click") & (F.col("date") == F.lit("2024-01-05").cast("date"))))
    base = base.withColumn("source", F.when((F.col("product") == "ev-error") & (F.second(e_id) % 17 == 0),
                                            F.lit(None).cast("string")).otherwise(F.col("source")))
    base = base.withColumn("schema_version", F.when((F.col("product") == "ev-signup") & (F.second(e_id) % 13 == 0),
                                                    F.lit(2)).otherwise(F.col("schema_version")))
    dup = rows.filter((F.col("product") == "ev-view") & (F.second(e_id) % 11 == 0)).withColumn(
        "batch", F.lit("part-20240201T000000Z"))
    root = scratch_path(spark, "verify")
    LK.write_curated(base.unionByName(dup), root)
    lake = spark.read.parquet(f"{root}/curated")
    return VF.verify(lake, ["interval_start", "series"])


def _product_document() -> str:
    """Products of two table families in the file form: series without a total and one with, and prices."""
    import json

    cells = {"day": "Day", "hour": "Hour", "a": "A", "b": "B", "t": "T", "dst_flag": "DST"}
    base = {"interval_minutes": 60, "time_style": "hour_ending", "cadence": "hourly", "lookback_hours": 24, "stale_after_min": 90}
    series = {"delivery_date": "Day", "hour_ending": "Hour", "a": "A", "b": "B", "t": "T", "repeated_flag": "DST"}
    prices = {"delivery_date": "Day", "hour_ending": "Hour", "point": "P", "point_type": "K", "price": "V", "repeated_flag": "DST"}
    return json.dumps({"products": [
        *({"product": f"ev-{t}", "table": "series", "columns": series, "series": {"a": "z:a", "b": "z:b"}, **base} for t in ("click", "error", "signup", "view")),
        {"product": "zones", "table": "series", "columns": series, "series": {"a": "z:a", "b": "z:b", "t": "z:total"}, "total": "z:total",
         "collected_from": "2024-01-04T06:00:00+00:00", **base},
        {"product": "prices", "table": "spp", "columns": prices, **base}]})


@query
def verify_products(spark, sf):
    """A lake of two table families, verified product by product: a missing day, repeated keys, NULLs, an unknown version,
    a column too many in one batch of prices, zones that do not sum to their total, and zones without one."""
    from asofspark.plans import products as PR
    from asofspark.plans.verify_lake import verify_lake

    rows = _curated_events(spark, sf)
    second = F.second("posted_at")
    base = rows.filter("product <> 'ev-purchase'").filter(~((F.col("product") == "ev-click") & (F.col("date") == F.lit("2024-01-05").cast("date"))))
    base = base.withColumn("source", F.when((F.col("product") != "ev-error") | (second % 17 != 0), F.col("source")))
    base = base.withColumn("schema_version", F.when((F.col("product") == "ev-signup") & (second % 13 == 0), 2).otherwise(F.col("schema_version")))
    dup = rows.filter((F.col("product") == "ev-view") & (second % 11 == 0)).withColumn("batch", F.lit("part-20240201T000000Z"))
    order = ["interval_start", "interval_minutes", "posted_at", "ingested_at", "source", "schema_version"]
    place = ["product", "date", "batch"]
    series = [*order, "series", "value", "dst_flag", *place]
    # hourly counts of clicks and views as zones, their sum as the total; some totals wrong, some not there
    hour = F.unix_seconds(F.col("interval_start").cast("timestamp")) / 3600
    per = (rows.filter("product in ('ev-click', 'ev-view')").groupBy("interval_start", "date").agg(
        F.count_if(F.col("product") == "ev-click").cast("double").alias("a"), F.count_if(F.col("product") == "ev-view").cast("double").alias("b"))
        .withColumn("h", hour.cast("bigint")))
    zone = F.array(F.struct(F.lit("z:a").alias("series"), F.col("a").alias("value")),
                   F.struct(F.lit("z:b").alias("series"), F.col("b").alias("value")),
                   F.struct(F.lit("z:total").alias("series"), (F.col("a") + F.col("b") + F.when(F.col("h") % 50 == 0, 500.0).otherwise(0.0)).alias("value")))
    z = per.select("*", F.inline(zone)).filter(~((F.col("h") % 70 == 0) & (F.col("series") == "z:a"))
                                               & ~((F.col("h") % 3 == 0) & (F.col("series") == "z:total"))
                                               & ~F.col("date").isin(_datetime.date(2024, 1, 3), _datetime.date(2024, 1, 9)))
    z = z.select("interval_start", F.lit(60).alias("interval_minutes"), F.col("interval_start").alias("posted_at"),
                 F.col("interval_start").alias("ingested_at"), F.lit("archive").alias("source"), F.lit(1).alias("schema_version"), "series",
                 "value", F.lit(False).alias("dst_flag"), F.lit("zones").alias("product"), "date", F.lit("part-20240201T000000Z").alias("batch"))
    price = rows.filter("product = 'ev-purchase'").select(
        *order, F.col("series").alias("settlement_point"), F.lit("N").alias("settlement_point_type"), F.col("value").alias("price_mwh"), "dst_flag",
        F.lit("prices").alias("product"), "date", "batch")
    odd = F.col("batch") == "part-20240110T000000Z"
    root = scratch_path(spark, "verify")
    LK.write_curated(base.unionByName(dup).select(*series), root)
    LK.write_curated(z.select(*series), root)
    LK.write_curated(price.filter(~odd), root)
    LK.write_curated(price.filter(odd).withColumn("note", F.lit("x")), root)
    return verify_lake(spark, root, PR.parse_products(_product_document()))


# --- API pages, JSON objects, listings, source planning, workbook rows -----------------------

import io as _io  # noqa: E402
import json as _json  # noqa: E402

from asofspark.sources import documents as DOC  # noqa: E402


def _page(key: tuple, rows) -> dict:
    """An API page, its data rows written as they come."""
    event_type, day = key
    fields = [{"name": n} for n in ("eventId", "timestamp", "userId", "eventType", "value")]
    out = _io.BytesIO()
    out.write(b'{"fields": %s, "data": [' % _json.dumps(fields).encode())
    for n, (event_id, ts, user_id, value) in enumerate(rows):
        out.write(b", " if n else b"")
        out.write(_json.dumps([event_id, ts, user_id, event_type, value]).encode())
    out.write(b"]}")
    return {"name": f"{event_type}/{day}.json", "content": out.getvalue()}


@query
def api_json_pages(spark, sf):
    root = scratch_path(spark, "pages")
    e = read(spark, sf, "events").withColumn("day", T.delivery_date("ts"))
    rows = e.select("event_type", "day", "event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"), "user_id", "value")
    pages = FX.documents_of(rows, ["event_type", "day"], "event_id", _page, "name string, content binary")
    AR.export_files(pages, root).write.format("noop").mode("overwrite").save()
    rows = DOC.read_api_pages(spark, root)
    c = F.col("cells")
    pos = {n: F.array_position("header", n).cast("int") - 1 for n in ("eventId", "timestamp", "userId", "eventType", "value")}
    return rows.select(F.get(c, pos["eventId"]).cast("bigint").alias("event_id"),
                       F.to_timestamp_ntz(F.get(c, pos["timestamp"]), F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).alias("ts"),
                       F.get(c, pos["userId"]).cast("bigint").alias("user_id"),
                       F.get(c, pos["eventType"]).alias("event_type"),
                       F.get(c, pos["value"]).cast("double").alias("value"))


@query
def api_transform(spark, sf):
    """One page of an hourly price report per order, through the same transform as its archive form."""
    li = read(spark, sf, "lineitem")
    text = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    hour = F.lpad((1 + (F.col("l_linenumber") * 5 + F.col("l_partkey")) % 24).cast("string"), 2, "0")
    cells = [text(F.date_format("l_shipdate", "yyyy-MM-dd")), text(F.concat(hour, F.lit(":00"))),
             text(F.concat(F.lit("P"), F.col("l_suppkey").cast("string"))),
             F.when(F.col("l_returnflag") != "N", text(F.col("l_returnflag"))).otherwise("null"),
             F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string"), (F.col("l_partkey") % 997 == 0).cast("string")]
    row = F.concat(F.lit("["), F.concat_ws(",", *cells), F.lit("]"))
    decl = SPP_DECL.in_format("api")
    fields = ",".join(f'{{"name":"{n}"}}' for n in decl.expected_header)
    pages = li.groupBy("l_orderkey").agg(F.concat(
        F.lit(f'{{"fields":[{fields}],"data":['), F.array_join(F.array_sort(F.collect_list(row)), ","), F.lit("]}")).alias("page"))
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    rec = DOC.parse_api_pages(pages, "page").withColumn("posting", F.col("l_orderkey")).withColumn("posted_at", at).withColumn("ingested_at", at)
    return TR.transform(rec, decl).select("posting", "interval_start", "settlement_point", "settlement_point_type", "price_mwh",
                                          "dst_flag", "source", "problem")


@query
def json_objects(spark, sf):
    e = read(spark, sf, "events").select(
        "event_id", F.when(F.col("event_id") % 97 == 0, F.concat(F.lit("{broken "), F.col("props")))
        .when(F.col("event_id") % 89 == 0, F.lit(None).cast("string")).otherwise(F.col("props")).alias("raw"))
    p = DOC.parse_json_objects(e, "raw", "k bigint")
    return p.select("event_id", F.when(F.col("status") == "ok", F.col("obj.k")).alias("k"), "status")


@query
def json_object_files(spark, sf):
    """State objects as files of their own, some of them broken, against the list of those expected."""
    root = scratch_path(spark, "objects")
    e = read(spark, sf, "events").filter("event_type = 'signup'")
    name = F.concat(F.lit("user-"), F.col("user_id").cast("string"), F.lit(".json"))
    newest = e.groupBy("user_id").agg(F.max_by("props", F.struct("ts", "event_id")).alias("props"))
    content = F.when(F.col("user_id") % 13 == 0, F.concat(F.lit("{broken "), "props")).otherwise(F.col("props"))
    files = newest.filter("user_id % 5 <> 0").select(name.alias("name"), content.cast("binary").alias("content"))
    AR.export_files(files, root).write.format("noop").mode("overwrite").save()
    folder = root.removeprefix("file:") if root.startswith("file:") else root
    path = F.concat(F.lit(("file://" if root.startswith(("file:", "/")) else "") + folder + "/"), name)
    found = DOC.read_json_objects(spark, root, "k bigint", expected=newest.select(path.alias("path")))
    return found.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"),
                        F.when(F.col("status") == "ok", F.col("obj.k")).alias("k"), "status")


def _listing(spark, sf):
    e = read(spark, sf, "events")
    u = e.select("event_id", (F.col("ts") + F.make_dt_interval(F.lit(SHIFT_DAYS))).alias("utc"), "event_type")
    return u.select(F.col("event_id").alias("doc_id"),
                    F.date_format(T.utc_to_local("utc"), "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("post_local_text"),
                    F.when(F.col("doc_id") % 5 != 0, F.concat(F.lit("ev_"), F.col("event_type"))).alias("friendly_name"),
                    F.when(F.col("doc_id") % 2 == 0, F.lit("live")).otherwise(F.lit("history")).alias("archive_id"))


@query
def listing_window(spark, sf):
    return DOC.listing_docs(_listing(spark, sf), "2024-11-03 05:00:00", "2024-11-04 00:00:00")


@query
def listing_broken_stamps(spark, sf):
    """A listing in which some stamps cannot be read or are not there: their documents are reported, none is lost."""
    text = (F.when(F.col("doc_id") % 61 == 0, F.lit(None).cast("string"))
            .when(F.col("doc_id") % 53 == 0, F.concat(F.lit("at "), F.col("doc_id").cast("string"))).otherwise(F.col("post_local_text")))
    broken = _listing(spark, sf).withColumn("post_local_text", text)
    return DOC.listing_docs(broken, "2024-11-03 08:00:00", "2024-11-04 00:00:00")


@query
def history_window(spark, sf):
    products = spark.createDataFrame([("ev-live", "history"), ("ev-other", None)], "product string, history_archive string")
    return DOC.history_docs(_listing(spark, sf), products, "ev-live", "2024-11-01 00:00:00", "2024-11-10 00:00:00")


@query
def source_plan(spark, sf):
    o = read(spark, sf, "orders")
    listing = o.select(F.col("o_orderkey").alias("doc_id"),
                       (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("o_orderkey") % 86400)).alias("posted_at"))
    months = o.select(F.trunc(F.to_date("o_orderdate"), "month").alias("month")).distinct().filter(F.month("month") % 2 == 0)
    bundles = months.select("month", F.explode(F.array(F.lit(1), F.lit(2))).alias("n")).select(
        "month", F.concat(F.lit("bundle-"), F.date_format("month", "yyyyMM"), F.lit("-"), F.col("n").cast("string")).alias("bundle_id"),
        (F.col("month").cast("timestamp_ntz") + F.make_dt_interval(F.col("n"))).alias("listed_at"))
    return DOC.plan_sources("1996-01-01 00:00:00", "1997-06-30 00:00:00", bundles, listing)


@query
def workbook_rows(spark, sf):
    li = read(spark, sf, "lineitem")
    sheet = F.date_format("l_shipdate", "yyyy-MM")
    data = li.select(F.lit("year.xlsx").alias("file"), sheet.alias("sheet"),
                     (F.col("l_orderkey") * 8 + F.col("l_linenumber") + 10).alias("row_no"),
                     F.date_format("l_shipdate", "M/d/yyyy").alias("c0"), F.col("l_linenumber").cast("string").alias("c1"),
                     F.col("l_returnflag").alias("c2"), F.col("l_quantity").cast("bigint").cast("string").alias("c3"),
                     F.col("l_linestatus").alias("c4"), F.col("l_orderkey").cast("string").alias("c5"))
    sheets = data.select("file", "sheet").distinct()
    extra = (sheets.select("file", "sheet", F.lit(1).alias("row_no"), F.lit("Yearly report").alias("c0"),
                           *[F.lit(None).cast("string").alias(f"c{i}") for i in range(1, 6)])
             .unionByName(sheets.select("file", "sheet", F.lit(2).alias("row_no"), F.lit("Delivery Date").alias("c0"),
                                        *[F.lit(h).alias(f"c{i}") for i, h in enumerate(["Line", "Flag", "Qty", "Status", "Order"], 1)]))
             .unionByName(sheets.select("file", "sheet", F.lit(10 ** 9).alias("row_no"), F.lit("Note: provisional").alias("c0"),
                                        *[F.lit(None).cast("string").alias(f"c{i}") for i in range(1, 6)])))
    cells = data.unionByName(extra.withColumn("row_no", F.col("row_no").cast("bigint")))
    return DOC.workbook_rows(cells, order=(0, 5, 1, 2, 3, 4))


def _sections(spark, sf):
    e = read(spark, sf, "events").filter(F.col("event_type") == "signup")
    k = F.get_json_object("props", "$.k")
    raw = (F.when(F.col("event_id") % 7 == 0, F.concat(F.lit('{"title": "sec'), F.col("user_id").cast("string"),
                                                       F.lit('", "problems": [1, 2], "kpis": []}')))
           .when(F.col("event_id") % 11 == 0, F.lit("{not json"))
           .otherwise(F.concat(F.lit('{"title": "sec'), F.col("user_id").cast("string"), F.lit('", "problems": ["k='), k,
                               F.lit('"], "kpis": ["n=1", "n=2"]}'))))
    return MO.read_sections(e.select("event_id", raw.alias("raw")))


@query
def section_lists(spark, sf):
    s = _sections(spark, sf)
    return s.select("event_id", "title", F.size("problems").alias("n_problems"), F.size("kpis").alias("n_kpis"), "error")


def _alarm_history(spark, sf):
    e = read(spark, sf, "events").filter(F.col("event_type") == "error")
    data = F.concat(F.lit('{"oldState": {"stateValue": "'),
                    F.when(F.col("event_id") % 2 == 0, F.lit("OK")).otherwise(F.lit("ALARM")),
                    F.lit('"}, "newState": {"stateValue": "'),
                    F.when(F.col("event_id") % 2 == 0, F.lit("ALARM")).otherwise(F.lit("OK")), F.lit('"}}'))
    return e.select(F.concat(F.lit("ingest-"), (F.col("user_id") % 40).cast("string")).alias("alarm"),
                    F.col("ts").alias("at"), data.alias("data"))


@query
def report_problems(spark, sf):
    cov = coverage_actionable_rows(spark, sf)
    alarming = MO.in_alarm(_alarm_history(spark, sf), "ingest-", NOW)
    sections = _sections(spark, sf)
    return MO.problems(cov, alarming, sections)


def coverage_actionable_rows(spark, sf):
    cfg = spark.createDataFrame(_EVENT_PRODUCTS, "product string, cadence string, interval_minutes int")
    days = cfg.select("*", F.explode(F.array(*MO.report_days(NOW))).alias("delivery_date"))
    expected = MO.expected_slots(MO.calendar(days), NOW)
    e = read(spark, sf, "events")
    minutes = cfg.select(F.col("product").alias("event_type"), "interval_minutes")
    sec = F.col("interval_minutes") * 60
    present = e.join(F.broadcast(minutes), on="event_type").select(
        F.col("event_type").alias("product"),
        F.timestamp_seconds(F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / sec) * sec).cast("timestamp_ntz").alias("interval_start"))
    return MO.coverage(expected, present, now=NOW)


@query
def stream_replay(spark, sf):
    """STR04: the same landing replayed by a second stream with a fresh checkpoint rewrites the
    same batch directories; the lake is unchanged."""
    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "lake")
    decls = FX.event_declarations()
    _drop_zips(spark, sf, landing)
    for _ in range(2):
        ST.stream_ingest(spark, landing, decls, root, scratch_path(spark, "ckpt"), ingested_at=_INGESTED,
                         product=FX.event_product).awaitTermination()
    return read_curated(spark, root, "spp").select(*_CURATED_COLS)


def _stream_drops(spark, drops) -> str:
    """Feed the landing folder in drops (one folder each); after each drop an ``availableNow``
    stream run resumes from the same checkpoint. Returns the lake root."""
    landing, root, ckpt = scratch_path(spark, "landing"), scratch_path(spark, "lake"), scratch_path(spark, "ckpt")
    decls = FX.event_declarations()
    for i, z in enumerate(drops):
        AR.export_files(z, f"{landing}/drop{i}").write.format("noop").mode("overwrite").save()
        ST.stream_ingest(spark, landing, decls, root, ckpt, ingested_at=_INGESTED, product=FX.event_product).awaitTermination()
    return root


@query
def stream_resume(spark, sf):
    """STR02: postings that repeat a business key fail and stop their product; the next drop
    redelivers them corrected and the product resumes at the failed posting."""
    rows = FX.zip_rows(spark, sf)
    root = _stream_drops(spark, [FX.zips_of(rows), FX.zips_of(FX.corrected(rows))])
    return read_curated(spark, root, "spp").select(*_CURATED_COLS)


DEFERRED_DAY = "2024-01-02"


@query
def stream_defer(spark, sf):
    """STR03: the first drop lists one day's postings before their files exist (``.listed``
    markers): each product holds back there, cleanly; the second drop brings the files."""
    z = FX.posting_zips(spark, sf)
    late = F.col("day") == F.lit(DEFERRED_DAY).cast("date")
    first = z.filter(~late).unionByName(FX.placeholders(z.filter(late)))
    root = _stream_drops(spark, [first, z.filter(late)])
    return read_curated(spark, root, "spp").select(*_CURATED_COLS)


@query
def stream_repost(spark, sf):
    """STR05: a second drop reposts every posting later with revised values; reposts are newer
    postings, never dropped as late, and win the point-in-time read."""
    rows = FX.zip_rows(spark, sf)
    root = _stream_drops(spark, [FX.zips_of(rows), FX.zips_of(FX.reposts(rows))])
    lake = read_curated(spark, root, "spp")
    return pit.latest_as_of(lake, key=["product", "interval_start", "settlement_point", "settlement_point_type"],
                            posted="posted_at", tie="ingested_at", as_of="2100-01-01 00:00:00").select(
        "product", "interval_start", "settlement_point", "settlement_point_type", "price_mwh", "posted_at")


# --- calendar bitmaps and the pre-shuffled layout (AGG06 SET04 JN01, WIN01 JOB02 JN06) --------


@query
def coverage_bitmaps(spark, sf):
    """Coverage from the bitmaps of three runs, one of them recorded twice; rows are not read for it."""
    root = scratch_path(spark, "slots")
    present = _events_present(spark, sf)
    for k in (0, 1, 2, 1):
        IN.record_slots(spark, root, present.filter(F.pmod(F.dayofyear("interval_start") + F.hour("interval_start"), F.lit(3)) == k))
    days = present.select(T.delivery_date("interval_start").alias("d")).agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    days = days.select(F.lit("events").alias("product"), F.lit(15).alias("interval_minutes"),
                       F.explode(F.sequence("lo", "hi")).alias("delivery_date"))
    c = IN.slot_coverage(spark, root, MO.calendar(days))
    return c.select("product", "delivery_date", "expected", "present", "n_missing", MO.missing_text("missing", 8).alias("missing_text"))


@query
def layout_by_range(spark, sf):
    """``lake_by_range`` on a pre-shuffled layout of the rows posted until mid-month, and the later rows beside it."""
    from asofspark.sources import layout as LY

    rows = _curated_events(spark, sf)
    old = F.col("posted_at") < F.lit("2024-01-15").cast("timestamp_ntz")
    key = ["product", "interval_start", "series"]
    laid = LY.write(spark, rows.filter(old), scratch_path(spark, "layout"), key, sort=["posted_at", "ingested_at"])
    lo, hi = (F.lit(f"2024-0{m}-01 06:00:00").cast("timestamp_ntz") for m in (1, 2))
    df = laid.latest(key, as_of="2024-01-20 00:00:00", extra=rows.filter(~old),
                     where=(F.col("interval_start") >= lo) & (F.col("interval_start") < hi))
    return df.select("product", "interval_start", "series", "posted_at", "value")


@query
def layout_pit_join(spark, sf):
    """``pit_join`` on two pre-shuffled layouts by user; users with over 150 rows of a side lie outside the buckets."""
    from asofspark.sources import layout as LY

    decisions, facts = _purchases_and_views(spark, sf)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = LY.write(spark, decisions, scratch_path(spark, "layout"), ["user_id"], sort=["decision_ts"], buckets=buckets, hot_rows=150)
    f = LY.write(spark, facts, scratch_path(spark, "layout"), ["user_id"], buckets=buckets, hot_rows=150)
    return LY.as_of_join(d, f, decision_time="decision_ts", posted="posted_at", value_cols=["view_value"])
