"""Declared, drift-strict transform from source records to a curated table (JOB05, PRJ01-08).

Input: one row per source line, ``(posting, posted_at, ingested_at, header ARRAY<STRING>,
cells ARRAY<STRING>)`` (``line_no`` optional). Columns are found by name in each posting's own
header, so source column order does not matter. Every rule is a Column expression; a cell
that cannot be read becomes a ``problem`` string on its row, and :func:`posting_status`
refuses a whole posting when any of its rows (or its header) has one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asofspark.functions import parse as P
from asofspark.functions import time as T
from asofspark.plans.declare import AS_TYPES, SCHEMA_VERSION, Declaration


def cell(decl: Declaration, canonical: str, header: str = "header", cells: str = "cells") -> Column:
    """PRJ01: the cell of ``canonical``'s source column, looked up in the posting's header."""
    source = decl.columns[canonical]
    return F.get(F.col(cells), F.array_position(F.col(header), F.lit(source)).cast("int") - 1)


def _cell(canonical: str) -> Column:
    """The looked-up cell of ``canonical`` (a column added once by :func:`transform`)."""
    return F.col(f"__cell_{canonical}")


def check_columns(records: DataFrame, decl: Declaration | dict, by: str = "posting",
                  product: str = "product") -> DataFrame:
    """PRJ02: per posting, missing and unexpected header columns (sorted, comma-joined), repeated
    header names, members that disagree on the header, and rows whose cell count differs from
    the header. ``decl`` may be a mapping product -> declaration: then one aggregate checks the
    postings of every product.

    The headers are gathered with ``collect_set`` (a hash aggregate; the set holds one header
    per posting, at most one per member), so the check never sorts the records."""
    agg = [F.collect_set("header").alias("__headers"),
           F.sum(F.when(F.size("cells") != F.size("header"), 1).otherwise(0)).cast("bigint").alias("bad_rows"),
           F.count("cells").alias("n_rows")]
    if isinstance(decl, dict):
        headers = records.sparkSession.createDataFrame(
            [(p, sorted(d.expected_header)) for p, d in decl.items()], f"{product} string, __expected array<string>")
        per = records.groupBy(product, by).agg(*agg)
        per = per.join(F.broadcast(headers), on=product, how="inner").drop(product)  # one row per product
        return _drift(per, F.col("__expected"), by)
    expected = F.array(*[F.lit(c) for c in sorted(decl.expected_header)])
    return _drift(records.groupBy(by).agg(*agg), expected, by)


def _drift(per: DataFrame, expected, by: str) -> DataFrame:
    header = F.when(F.size("__headers") == 1, F.col("__headers")[0])
    per = per.withColumn("header", header)
    missing = F.array_join(F.array_sort(F.array_except(expected, F.col("header"))), ",")
    unexpected = F.array_join(F.array_sort(F.array_except(F.col("header"), expected)), ",")
    repeated = F.size(F.col("header")) != F.size(F.array_distinct(F.col("header")))
    out = per.select(by, "n_rows", "bad_rows", missing.alias("missing"), unexpected.alias("unexpected"),
                     repeated.alias("repeated_header"), (F.size("__headers") > 1).alias("__disagree"))
    problem = (
        F.when(F.col("__disagree"), F.lit("column drift: members disagree on the header"))
        .when((F.col("missing") != "") | (F.col("unexpected") != ""),
              F.concat(F.lit("column drift: missing ["), F.col("missing"), F.lit("] unexpected ["),
                       F.col("unexpected"), F.lit("]")))
        .when(F.col("repeated_header"), F.lit("column drift: repeated header name"))
        .when(F.col("bad_rows") > 0, F.concat(F.lit("cell count differs from header on "),
                                              F.col("bad_rows").cast("string"), F.lit(" rows")))
    )
    return out.withColumn("problem", problem).drop("__disagree")


def reads(*cells: str):
    """Marks a builder with the canonical cells that it reads: a declaration must name them all."""

    def mark(fn):
        fn.reads = cells
        return fn

    return mark


# Time styles: (rows, interval minutes) -> rows with ``__local`` (the wall clock of the interval's
# start) and the problem of reading it. Each step is its own column, so every parse runs once a row.


@reads("run_stamp")
def _from_run_stamp(df: DataFrame, m: int) -> tuple[DataFrame, Column]:
    df = df.withColumn("__raw", T.parse_run_stamp(_cell("run_stamp"))).withColumn(
        "__local", F.date_trunc("hour", F.col("__raw")).cast("timestamp_ntz")
        + F.make_dt_interval(F.lit(0), F.lit(0), F.minute("__raw") - F.minute("__raw") % F.lit(m)))
    return df, F.when(F.col("__raw").isNull(), F.lit("unrecognised run timestamp"))


def _day_and_hour(df: DataFrame) -> tuple[DataFrame, Column]:
    df = df.withColumn("__day", T.parse_delivery_date(_cell("delivery_date"))).withColumn(
        "__hour", T.parse_hour_ending(_cell("hour_ending")))
    return df, (F.when(F.col("__day").isNull(), F.lit("unrecognised delivery date"))
                .when(F.col("__hour").isNull(), F.lit("hour out of range")))


def _start_of_interval(df: DataFrame, m: int) -> DataFrame:
    return df.withColumn("__local", T.interval_local(F.col("__day"), F.col("__hour"), F.col("__interval"), m))


@reads("delivery_date", "hour_ending")
def _from_hour(df: DataFrame, m: int) -> tuple[DataFrame, Column]:
    df, problem = _day_and_hour(df)
    two_am = T.midnight(F.col("__day")) + F.expr("INTERVAL 2 HOURS")
    hour = F.when((F.col("__hour") == 3) & ~T.exists_local(two_am), F.lit(2)).otherwise(F.col("__hour"))
    return _start_of_interval(df.withColumn("__interval", F.lit(1)).withColumn("__hour", hour), m), problem


@reads("delivery_date", "hour_ending", "interval")
def _from_hour_and_interval(df: DataFrame, m: int) -> tuple[DataFrame, Column]:
    df, problem = _day_and_hour(df)
    df = df.withColumn("__interval", P.to_whole(_cell("interval"))[0])
    outside = F.col("__interval").isNull() | ~F.col("__interval").between(1, 60 // m)
    return _start_of_interval(df, m), problem.when(outside, F.lit(f"interval out of range for {m}-minute product"))


TIME_BUILDERS = {"hour_ending": _from_hour, "hour_interval": _from_hour_and_interval, "sced_timestamp": _from_run_stamp}


def _with_time(df: DataFrame, decl: Declaration, rep: Column) -> DataFrame:
    """Add ``__start`` and ``__time_problem``. FN14: the time style is chosen here, in Python,
    once per declaration, so rows never branch on it."""
    df, unread = TIME_BUILDERS[decl.time_style](df.withColumn("__rep", rep), decl.interval_minutes)
    df = T.resolve_local(df, "__local", F.col("__rep"), out="__start", problem="__zone_problem")
    return df.withColumn("__time_problem", F.coalesce(unread, F.col("__zone_problem")))


# Tables: (rows, declaration, leading columns, problem so far) -> curated rows with ``problem``.


@reads("point", "price")
def _spp(df: DataFrame, decl: Declaration, base: list[Column], common: Column) -> DataFrame:
    """PRJ05: trimmed point, trimmed type or NULL, required price."""
    price, price_problem = P.to_number(_cell("price"))
    point = F.trim(_cell("point"))
    ptype = F.trim(_cell("point_type")) if "point_type" in decl.columns else F.lit(None).cast("string")
    return df.select(*base, point.alias("settlement_point"), ptype.alias("settlement_point_type"),
                     price.alias("price_mwh"),
                     F.coalesce(common, F.when(point.isNull() | (point == ""), F.lit("missing settlement point")),
                                price_problem).alias("problem"))


@reads("as_type", "mcpc")
def _mcpc(df: DataFrame, decl: Declaration, base: list[Column], common: Column) -> DataFrame:
    """PRJ06: upper(trim) type in the closed domain, else a problem."""
    as_type = F.upper(F.trim(_cell("as_type")))
    value, value_problem = P.to_number(_cell("mcpc"))
    unknown = F.when(~as_type.isin(*AS_TYPES) | as_type.isNull(),
                     F.concat(F.lit("unknown ancillary type "), F.coalesce(as_type, F.lit("NULL"))))
    return df.select(*base, as_type.alias("as_type"), value.alias("mcpc_mw"),
                     F.coalesce(common, unknown, value_problem).alias("problem"))


@reads()
def _series(df: DataFrame, decl: Declaration, base: list[Column], common: Column) -> DataFrame:
    """PRJ07: every cell is parsed once in a projection (where Spark shares the trimmed text between
    the value and its problem); the melt then only moves finished values."""
    parsed, names = [], {}
    for i, (canonical, name) in enumerate(decl.series.items()):
        v, vp = P.to_number(_cell(canonical), required=False)
        parsed.append(F.struct(v.alias("value"), vp.alias("value_problem")).alias(f"__s{i}"))
        names[f"__s{i}"] = f"{decl.product}:{name}"
    wide = df.select(*base, common.alias("__common"), *parsed)
    kept = [n for n in wide.columns if not n.startswith("__s")]
    # unpivot plans an Expand (one output row per series, in generated code)
    melted = wide.unpivot(kept, list(names), "__series", "__m")
    series = F.col("__series")
    for col_name, label in names.items():
        series = F.when(F.col("__series") == col_name, F.lit(label)).otherwise(series)
    # a row with a problem of its own keeps one row, its first series, even if all cells are blank
    first = F.col("__common").isNotNull() & (F.col("__series") == "__s0")
    return (melted.filter(F.col("__m.value").isNotNull() | F.col("__m.value_problem").isNotNull() | first)
            .select(*[c for c in kept if c != "__common"], series.alias("series"), F.col("__m.value").alias("value"),
                    F.coalesce(F.col("__common"), F.col("__m.value_problem")).alias("problem")))


TABLE_BUILDERS = {"spp": _spp, "mcpc": _mcpc, "series": _series}


def transform(records: DataFrame, decl: Declaration, *, posting: str = "posting",
              source: str | None = None, carry=()) -> DataFrame:
    """JOB05: records -> curated rows of ``decl.table`` plus a ``problem`` column.

    PRJ03 (keep flag) and PRJ04 (point prefixes) run before any time parsing, so rows they drop
    cannot fail the posting. Series tables are melted (PRJ07) with blank cells producing no row
    unless the row itself has a problem.
    """
    # every declared cell is looked up once (its header position found once per row); later
    # expressions read these short columns, keeping each generated method small enough to be
    # JIT-compiled
    df = records.select("*", *[cell(decl, c).alias(f"__cell_{c}") for c in decl.columns])
    if decl.keep_flag:
        keep, keep_problem = P.to_flag(_cell(decl.keep_flag))
        df = df.withColumn("__keep_problem", keep_problem).filter(F.coalesce(keep, F.lit(True)))
    if decl.keep_point_prefixes:
        point = F.trim(_cell("point"))
        df = df.filter(F.greatest(*[point.startswith(p) for p in decl.keep_point_prefixes], F.lit(False)))
    if "repeated_flag" in decl.columns:
        rep, rep_problem = P.to_flag(_cell("repeated_flag"))
        rep = F.coalesce(rep, F.lit(False))
    else:
        rep, rep_problem = F.lit(False), F.lit(None).cast("string")
    df = _with_time(df, decl, rep)
    time_problem = F.col("__time_problem")
    rep = F.col("__rep")
    base = [
        F.col(posting),
        *[F.col(c) for c in carry],
        F.col("__start").alias("interval_start"),
        F.lit(decl.interval_minutes).alias("interval_minutes"),
        F.col("posted_at"),
        F.col("ingested_at"),
        F.lit(source or decl.source).alias("source"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        rep.alias("dst_flag"),
    ]
    keep_problem = F.col("__keep_problem") if decl.keep_flag else F.lit(None).cast("string")
    common_problem = F.coalesce(keep_problem, rep_problem, time_problem)
    return TABLE_BUILDERS[decl.table](df, decl, base, common_problem)


def posting_status(rows: DataFrame, drift: DataFrame | None = None, posting: str = "posting") -> DataFrame:
    """Per posting: rows, problem rows, the first problem, and ``status`` ok/failed. The status comes from counts: a
    job that asks for it alone is planned without the texts, as a hash aggregate."""
    agg = rows.groupBy(posting).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("problem").alias("n_problems"),
        F.min("problem").alias("first_problem"),
    )
    if drift is not None:
        agg = agg.join(drift.select(posting, F.col("problem").alias("drift")), on=posting, how="full")
        first, drifted = F.coalesce(F.col("drift"), F.col("first_problem")), F.col("drift").isNotNull()
    else:
        first, drifted = F.col("first_problem"), F.lit(False)
    failed = drifted | (F.coalesce("n_problems", F.lit(0)) > 0)
    return agg.select(posting, F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
                      F.coalesce("n_problems", F.lit(0)).alias("n_problems"), first.alias("problem"),
                      F.when(failed, F.lit("failed")).otherwise(F.lit("ok")).alias("status"))


def accepted(rows: DataFrame, status: DataFrame, posting: str = "posting") -> DataFrame:
    """Rows of postings whose status is ok (left semi join on the small status table)."""
    ok = status.filter(F.col("status") == "ok").select(posting)
    return rows.join(ok, on=posting, how="left_semi").drop("problem")
