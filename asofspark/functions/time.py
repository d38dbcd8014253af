"""Zone-exact time rules as Column expressions (no UDFs).

UTC instants and local wall clocks are both ``TIMESTAMP_NTZ``. A zone conversion moves the NTZ
value to a ``TIMESTAMP`` with the same UTC wall clock (pure microsecond arithmetic), applies
``to_utc_timestamp`` / ``from_utc_timestamp`` with a literal zone (resolved once per task, not
per row as ``convert_timezone`` on NTZ does) and moves back: independent of the session time
zone, and equal to ``convert_timezone``. For a local time that happens twice (the fall-back
hour) the first occurrence is returned; a local time in the spring-forward gap maps to the
instant one hour later in local terms (02:30 -> 08:30Z in Central time), which mapping back
exposes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The market's zone and the text formats of its stamps.
CT = "America/Chicago"
STAMP_FORMAT = "yyyyMMdd'T'HHmmss'Z'"
POST_LOCAL_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss.SSS", "yyyy-MM-dd'T'HH:mm:ss")
DELIVERY_DATE_FORMATS = ("yyyy-M-d", "M/d/yyyy")
RUN_STAMP_FORMATS = ("M/d/yyyy HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def utc_to_local(ts_utc, tz: str = CT) -> Column:
    """UTC wall clock -> local wall clock (FN02)."""
    return instant_to_ntz(F.from_utc_timestamp(ntz_to_instant(ts_utc), tz))


def delivery_date(ts_utc, tz: str = CT) -> Column:
    """Local calendar date an interval starts on: the curated partition (FN02, PRJ09)."""
    return F.to_date(utc_to_local(ts_utc, tz))


def first_utc(local, tz: str = CT) -> Column:
    """Local wall clock -> UTC, first occurrence for a repeated time (FN01)."""
    return instant_to_ntz(F.to_utc_timestamp(ntz_to_instant(local), tz))


_HOUR = "INTERVAL 1 HOUR"


def _second_candidate(local, tz: str) -> Column:
    return first_utc(local, tz) + F.expr(_HOUR)


def _zone_parts(local, tz: str):
    """(local as an instant, first UTC occurrence as an instant, whether the wall clock happens
    a second time): every test below stays in the instant domain, so a chain of conversions
    never nests NTZ round trips inside one another."""
    li = ntz_to_instant(local)
    u1 = F.to_utc_timestamp(li, tz)
    twice = F.from_utc_timestamp(u1 + F.expr(_HOUR), tz) == li
    return li, u1, twice


def exists_local(local, tz: str = CT) -> Column:
    """False for a wall-clock time in the spring-forward gap (FN03)."""
    li, u1, _ = _zone_parts(local, tz)
    return F.from_utc_timestamp(u1, tz) == li


def is_repeated(local, tz: str = CT) -> Column:
    """True when the wall-clock time happens twice, the fall-back hour (FN08)."""
    return _zone_parts(local, tz)[2]


def local_to_utc(local, repeated=None, tz: str = CT) -> Column:
    """Local wall clock -> UTC; ``repeated`` selects the second occurrence (FN01).

    Use :func:`local_problem` alongside: a gap time or a flag on an unambiguous time is refused.
    """
    if repeated is None:
        return first_utc(local, tz)
    rep = F.lit(repeated) if isinstance(repeated, bool) else _c(repeated)
    _, u1, twice = _zone_parts(local, tz)
    return instant_to_ntz(F.when(rep & twice, u1 + F.expr(_HOUR)).otherwise(u1))


def local_problem(local, repeated=None, tz: str = CT) -> Column:
    """NULL when ``local`` (with its repeat flag) names one real instant, else the reason (FN03)."""
    text = F.date_format(_c(local), "yyyy-MM-dd HH:mm")
    rep = F.lit(False) if repeated is None else (
        F.lit(repeated) if isinstance(repeated, bool) else _c(repeated)
    )
    return (
        F.when(_c(local).isNull(), F.lit("missing local time"))
        .when(~exists_local(local, tz), F.concat(text, F.lit(" falls into the hour that the clocks skip")))
        .when(rep & ~is_repeated(local, tz), F.concat(text, F.lit(" carries the repeat flag outside a repeated hour")))
    )


def nearest_occurrence(local, listed_utc, tz: str = CT) -> Column:
    """Of the first/second occurrence of ``local``, the one nearer to ``listed_utc``; ties go to
    the first; no local time -> the listed time (FN17)."""
    _, a, twice = _zone_parts(local, tz)
    b = F.when(twice, a + F.expr(_HOUR)).otherwise(a)
    listed = F.unix_micros(ntz_to_instant(listed_utc))
    da = F.abs(listed - F.unix_micros(a))
    db = F.abs(listed - F.unix_micros(b))
    return F.when(_c(local).isNull(), _c(listed_utc)).when(db < da, instant_to_ntz(b)).otherwise(instant_to_ntz(a))


def _minutes(n) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), _c(n) if not isinstance(n, int) else F.lit(n))


def midnight(day) -> Column:
    """DATE -> local midnight as NTZ (a plain cast; no zone is involved)."""
    return _c(day).cast("timestamp_ntz")


def interval_local(day, hour, interval, minutes: int) -> Column:
    """Wall-clock start of interval ``interval`` (1-based) of hour ending ``hour`` (FN11)."""
    return midnight(day) + F.make_dt_interval(
        F.lit(0), _c(hour) - 1, (_c(interval) - 1) * F.lit(minutes)
    )


def interval_start(day, hour, interval, minutes: int, repeated=None, tz: str = CT):
    """(UTC start, problem) of an hour-interval stamp (FN11)."""
    per_hour = 60 // minutes
    local = interval_local(day, hour, interval, minutes)
    problem = (
        F.when(_c(day).isNull(), F.lit("unrecognised delivery date"))
        .when(_c(hour).isNull() | ~_c(hour).between(1, 24), F.lit("hour out of range"))
        .when(
            _c(interval).isNull() | ~_c(interval).between(1, per_hour),
            F.lit(f"interval out of range for {minutes}-minute product"),
        )
        .otherwise(local_problem(local, repeated, tz))
    )
    return local_to_utc(local, repeated, tz), problem


def hour_ending_start(day, hour, minutes: int, repeated=None, tz: str = CT):
    """(UTC start, problem) of an hour-ending label; HE 3 on the spring-forward day is HE 2 (FN12)."""
    two_am = midnight(day) + F.expr("INTERVAL 2 HOURS")
    he = F.when((_c(hour) == 3) & ~exists_local(two_am, tz), F.lit(2)).otherwise(_c(hour))
    return interval_start(day, he, F.lit(1), minutes, repeated, tz)


def parse_run_stamp(text) -> Column:
    """``MM/dd/yyyy HH:mm:ss`` or ISO run stamp -> local NTZ (FN13 input)."""
    t = F.trim(_c(text))
    us, iso = RUN_STAMP_FORMATS
    # dispatch on the separator so a valid stamp is parsed once, without a failing attempt
    return F.when(t.contains("/"), F.try_to_timestamp(t, F.lit(us))).otherwise(
        F.try_to_timestamp(t, F.lit(iso))).cast("timestamp_ntz")


def run_stamp_start(text, minutes: int, repeated=None, tz: str = CT):
    """(UTC start, problem) of a run stamp floored to the grain within its hour (FN13)."""
    return run_stamp_start_local(parse_run_stamp(text), minutes, repeated, tz)


def run_stamp_start_local(local, minutes: int, repeated=None, tz: str = CT):
    """FN13 from an already parsed local run time."""
    local = _c(local)
    floored = F.date_trunc("hour", local).cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.minute(local) - F.minute(local) % F.lit(minutes)
    )
    problem = F.when(local.isNull(), F.lit("unrecognised run timestamp")).otherwise(
        local_problem(floored, repeated, tz)
    )
    return local_to_utc(floored, repeated, tz), problem


def parse_post_local(text) -> Column:
    """Listing ``postDatetime`` -> local NTZ, with no fraction or one to six digits of it (FN07)."""
    t = F.trim(_c(text))
    _, whole = POST_LOCAL_FORMATS
    digits = F.regexp_extract(t, r"\.(\d{1,6})$", 1)
    start = F.try_to_timestamp(F.regexp_replace(t, r"\.\d{1,6}$", ""), F.lit(whole)).cast("timestamp_ntz")
    micros = F.rpad(F.when(digits != "", digits).otherwise("0"), 6, "0").cast("long")
    return F.timestamp_add("MICROSECOND", micros, start)


def parse_delivery_date(text) -> Column:
    """``yyyy-MM-dd`` or ``MM/dd/yyyy`` (one-digit parts accepted) -> DATE (FN09)."""
    t = F.trim(_c(text))
    iso, us = DELIVERY_DATE_FORMATS
    return F.to_date(F.when(t.contains("/"), F.try_to_timestamp(t, F.lit(us))).otherwise(
        F.try_to_timestamp(t, F.lit(iso))))


def parse_hour_ending(text) -> Column:
    """``01:00`` / ``1:00`` / ``24`` -> 1..24, else NULL (FN10)."""
    h = F.split_part(F.trim(_c(text).cast("string")), F.lit(":"), F.lit(1)).try_cast("int")
    return F.when(h.between(1, 24), h)


def stamp(ts_utc) -> Column:
    """UTC NTZ -> ``yyyyMMddTHHmmssZ`` (FN15)."""
    return F.date_format(_c(ts_utc), STAMP_FORMAT)


def parse_stamp(text) -> Column:
    """``yyyyMMddTHHmmssZ`` -> UTC NTZ (FN15)."""
    return F.try_to_timestamp(_c(text), F.lit(STAMP_FORMAT)).cast("timestamp_ntz")


def stamp_from_name(name) -> Column:
    """Posting wall clock from a member name ``...<yyyyMMdd>.<HHmmss>...`` (FN16)."""
    d = F.regexp_extract(_c(name), r"\.(\d{8})\.(\d{6})\.", 1)
    t = F.regexp_extract(_c(name), r"\.(\d{8})\.(\d{6})\.", 2)
    return F.when(d != "", F.try_to_timestamp(F.concat(d, t), F.lit("yyyyMMddHHmmss")).cast("timestamp_ntz"))


def day_starts(day, tz: str = CT):
    """(UTC start, UTC end) of a local calendar day."""
    return first_utc(midnight(day), tz), first_utc(midnight(F.date_add(_c(day), 1)), tz)


def day_interval_starts(day, minutes: int, tz: str = CT) -> Column:
    """ARRAY of every UTC interval start of a local day: 92/96/100 at 15 min (FN18)."""
    start, end = day_starts(day, tz)
    return F.sequence(start, end - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes)),
                      F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes)))


def month_edges(month_start, tz: str = CT):
    """(UTC start, UTC end) of the local month starting at DATE ``month_start`` (FN19)."""
    return first_utc(midnight(month_start), tz), first_utc(midnight(F.add_months(_c(month_start), 1)), tz)


def ntz_micros(ts) -> Column:
    """Microseconds since 1970-01-01 00:00 of an NTZ wall clock, from its fields: plain
    arithmetic, with no session zone involved (``timestamp_diff`` on NTZ values consults the
    session zone inside its DST gaps)."""
    t = _c(ts)
    return (F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("bigint") * F.lit(86_400_000_000)
            + F.hour(t).cast("bigint") * F.lit(3_600_000_000) + F.minute(t).cast("bigint") * F.lit(60_000_000)
            + (F.extract(F.lit("SECOND"), t) * F.lit(1_000_000)).cast("bigint"))


def micros_between(start, end) -> Column:
    """``end - start`` in microseconds, on NTZ wall clocks (no session zone involved)."""
    return ntz_micros(end) - ntz_micros(start)


def age_minutes(ts_utc, now_utc) -> Column:
    """Minutes from ``ts_utc`` to ``now_utc`` as DOUBLE (FN24)."""
    return micros_between(ts_utc, now_utc) / F.lit(60_000_000.0)


def resolve_local(df, local: str, repeated=None, *, out: str, problem: str, tz: str = CT):
    """DataFrame form of :func:`local_to_utc` + :func:`local_problem` for wide inputs.

    The three zone conversions a wall clock needs (first instant, and both candidates mapped
    back) are computed once each as their own columns, so the resulting plan evaluates three
    zone shifts per row instead of repeating them inside every derived expression.
    """
    rep = F.lit(False) if repeated is None else (F.lit(repeated) if isinstance(repeated, bool) else _c(repeated))
    hour = F.expr("INTERVAL 1 HOUR")
    # in the instant domain: one move in, three zone shifts, one move out
    df = (df.withColumn("__li", ntz_to_instant(local))
          .withColumn("__u1", F.to_utc_timestamp(F.col("__li"), tz))
          .withColumn("__b1", F.from_utc_timestamp(F.col("__u1"), tz))
          .withColumn("__b2", F.from_utc_timestamp(F.col("__u1") + hour, tz)))
    loc = _c(local)
    exists = F.col("__b1") == F.col("__li")
    twice = F.col("__b2") == F.col("__li")
    text = F.date_format(loc, "yyyy-MM-dd HH:mm")
    prob = (F.when(loc.isNull(), F.lit("missing local time"))
            .when(~exists, F.concat(text, F.lit(" falls into the hour that the clocks skip")))
            .when(rep & ~twice, F.concat(text, F.lit(" carries the repeat flag outside a repeated hour"))))
    out_utc = instant_to_ntz(F.when(rep & twice, F.col("__u1") + hour).otherwise(F.col("__u1")))
    return (df.withColumn(out, out_utc).withColumn(problem, prob).drop("__li", "__u1", "__b1", "__b2"))


_EPOCH = "1970-01-01 00:00:00"


def ntz_to_instant(ts_utc) -> Column:
    """UTC wall clock (NTZ) -> TIMESTAMP instant, independent of the session zone (event time
    for watermarks needs the instant type)."""
    return F.timestamp_micros(ntz_micros(ts_utc))


def instant_to_ntz(ts) -> Column:
    """TIMESTAMP instant -> UTC wall clock (NTZ), independent of the session zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(ts)), F.lit(_EPOCH).cast("timestamp_ntz"))
