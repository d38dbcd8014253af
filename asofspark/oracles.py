"""DuckDB SQL oracles, one per driver query, with the same output column names.

Rules: timestamps stay TIMESTAMP (no time zone); integer sums are cast to BIGINT; every column is
aliased. Where the zone rule matters the SQL spells out the offset rule explicitly instead of
relying on DuckDB's choice for ambiguous local times.
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-01-15 00:00:00'"

LOG = """(SELECT CAST(ts AS DATE) AS day, user_id, event_type, ts AS posted_at, event_id, value
          FROM events)"""

ORACLES: dict[str, str] = {}

ORACLES["pit_latest_as_of"] = f"""
SELECT day, user_id, event_type, posted_at, event_id, value FROM {LOG} l
WHERE posted_at <= {AS_OF}
QUALIFY row_number() OVER (PARTITION BY day, user_id, event_type ORDER BY posted_at DESC) = 1
"""

ORACLES["pit_by_date"] = f"""
SELECT day, user_id, event_type, posted_at, event_id, value FROM {LOG} l
WHERE day = DATE '2024-01-10' AND posted_at <= TIMESTAMP '2024-01-10 12:00:00'
QUALIFY row_number() OVER (PARTITION BY day, user_id, event_type ORDER BY posted_at DESC) = 1
"""

ORACLES["pit_by_range_named"] = f"""
SELECT day, user_id, event_type, posted_at, event_id, value, CAST(day AS TIMESTAMP) AS interval_start
FROM {LOG} l
WHERE CAST(day AS TIMESTAMP) >= TIMESTAMP '2024-01-05' AND CAST(day AS TIMESTAMP) < TIMESTAMP '2024-01-12'
  AND event_type IN ('click', 'purchase') AND posted_at <= TIMESTAMP '2024-01-20'
QUALIFY row_number() OVER (PARTITION BY day, user_id, event_type ORDER BY posted_at DESC) = 1
"""

ORACLES["pit_two_clocks"] = f"""
SELECT * FROM (
  SELECT day, user_id, event_type, posted_at, event_id, value,
         posted_at + to_hours(CAST(event_id % 7 AS INTEGER)) AS ingested_at
  FROM {LOG} l) t
WHERE posted_at <= {AS_OF} AND ingested_at <= {AS_OF}
QUALIFY row_number() OVER (PARTITION BY day, user_id, event_type
                           ORDER BY posted_at DESC, ingested_at DESC) = 1
"""

ORACLES["pit_postings"] = f"""
SELECT day, user_id, event_type, posted_at, event_id, value, CAST(day AS TIMESTAMP) AS interval_start
FROM {LOG} l
WHERE CAST(day AS TIMESTAMP) >= TIMESTAMP '2024-01-03' AND CAST(day AS TIMESTAMP) < TIMESTAMP '2024-01-06'
  AND posted_at <= TIMESTAMP '2024-01-05 12:00:00'
"""

ORACLES["pit_null_key"] = f"""
SELECT * FROM (
  SELECT day, CASE WHEN user_id % 3 <> 0 THEN user_id END AS user_id, event_type, posted_at,
         event_id, value
  FROM {LOG} l) t
WHERE posted_at <= TIMESTAMP '2024-01-20'
QUALIFY row_number() OVER (PARTITION BY day, user_id, event_type ORDER BY posted_at DESC) = 1
"""

ORACLES["pit_tie_break"] = f"""
SELECT * FROM (
  SELECT day, user_id, event_type, date_trunc('hour', posted_at) AS posted_at,
         posted_at AS ingested_at, event_id, value
  FROM {LOG} l) t
WHERE posted_at <= {AS_OF}
QUALIFY row_number() OVER (PARTITION BY day, user_id, event_type
                           ORDER BY posted_at DESC, ingested_at DESC) = 1
"""

_PIT_JOIN = """
SELECT p.decision_id, p.user_id, p.decision_ts, v.posted_at AS known_posted, v.view_value
FROM (SELECT event_id AS decision_id, user_id, ts AS decision_ts FROM events
      WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT user_id, ts AS posted_at, value AS view_value FROM events
                WHERE event_type = 'view') v
  ON p.user_id = v.user_id AND p.decision_ts >= v.posted_at
"""
ORACLES["pit_join"] = _PIT_JOIN
ORACLES["pit_join_bucketed"] = _PIT_JOIN

ORACLES["pit_join_null_keys"] = """
WITH k AS (SELECT *, CASE WHEN user_id % 7 <> 0 THEN user_id END AS key FROM events),
p AS (SELECT event_id, key, CASE WHEN event_id % 5 <> 0 THEN ts END AS at FROM k WHERE event_type = 'purchase'),
v AS (SELECT key, ts AS posted_at, max(value) AS view_value FROM k WHERE event_type = 'view' GROUP BY ALL)
SELECT p.event_id AS decision_id, p.key AS user_id, p.at AS decision_ts, x.posted_at AS known_posted, x.view_value
FROM p LEFT JOIN LATERAL (SELECT posted_at, view_value FROM v WHERE v.key IS NOT DISTINCT FROM p.key AND v.posted_at <= p.at
                          ORDER BY posted_at DESC LIMIT 1) x ON true
"""


# --- zone-exact time rules -------------------------------------------------------------------
# The oracle spells the Central-time rule out from DuckDB's UTC -> local conversion (which is
# unambiguous): the first UTC instant of a local wall clock L is L + 5h when that maps back to
# L (daylight time), else L + 6h; the second is first + 1h when that also maps back to L.


def _local(u: str) -> str:
    return f"timezone('America/Chicago', timezone('UTC', {u}))"


def _first(l: str) -> str:
    return (f"(CASE WHEN {_local(f'({l}) + INTERVAL 5 HOUR')} = ({l}) THEN ({l}) + INTERVAL 5 HOUR "
            f"ELSE ({l}) + INTERVAL 6 HOUR END)")


def _exists(l: str) -> str:
    return f"({_local(_first(l))} = ({l}))"


def _repeated(l: str) -> str:
    return f"({_local(_first(l) + ' + INTERVAL 1 HOUR')} = ({l}))"


def _to_utc(l: str, flag: str) -> str:
    return f"(CASE WHEN ({flag}) AND {_repeated(l)} THEN {_first(l)} + INTERVAL 1 HOUR ELSE {_first(l)} END)"


def _problem(l: str, flag: str) -> str:
    txt = f"strftime({l}, '%Y-%m-%d %H:%M')"
    return (f"(CASE WHEN ({l}) IS NULL THEN 'missing local time' "
            f"WHEN NOT {_exists(l)} THEN {txt} || ' falls into the hour that the clocks skip' "
            f"WHEN ({flag}) AND NOT {_repeated(l)} THEN {txt} || ' carries the repeat flag outside a repeated hour' END)")


SHIFTED = "(SELECT event_id, ts + INTERVAL 304 DAY AS utc FROM events)"

ORACLES["delivery_date_split"] = f"""
SELECT event_id, utc, {_local('utc')} AS local_ts, CAST({_local('utc')} AS DATE) AS delivery_date
FROM {SHIFTED} s
"""

ORACLES["hour_ending_to_utc"] = f"""
WITH a AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(1 + o_orderkey % 24 AS INTEGER) AS he0,
         o_orderkey % 10 = 0 AS flag FROM orders),
b AS (
  SELECT *, CASE WHEN he0 = 3 AND NOT {_exists("CAST(day AS TIMESTAMP) + INTERVAL 2 HOUR")} THEN 2 ELSE he0 END AS he
  FROM a),
c AS (SELECT *, CAST(day AS TIMESTAMP) + to_hours(he - 1) AS l FROM b)
SELECT o_orderkey, {_to_utc('l', 'flag')} AS interval_start,
       {_problem('l', 'flag')} AS problem
FROM c
"""

ORACLES["interval_to_utc"] = f"""
WITH c AS (
  SELECT o_orderkey, o_orderkey % 7 = 0 AS flag,
         CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + to_hours(CAST(o_orderkey % 24 AS INTEGER))
           + to_minutes(CAST(15 * ((o_orderkey // 24) % 4) AS INTEGER)) AS l
  FROM orders)
SELECT o_orderkey, {_to_utc('l', 'flag')} AS interval_start, {_problem('l', 'flag')} AS problem
FROM c
"""

ORACLES["stamp_floor"] = f"""
WITH a AS (
  SELECT o_orderkey, o_custkey % 9 = 0 AS flag,
         o_orderdate + to_seconds(CAST((o_orderkey * 37) % 86400 AS BIGINT)) AS t FROM orders),
c AS (
  SELECT o_orderkey, flag,
         date_trunc('hour', t) + to_minutes(CAST(minute(t) - minute(t) % 5 AS INTEGER)) AS l FROM a)
SELECT o_orderkey, {_to_utc('l', 'flag')} AS interval_start, {_problem('l', 'flag')} AS problem
FROM c
"""

ORACLES["repeated_hour_roundtrip"] = f"""
SELECT event_id, {_local('utc')} AS local_ts, utc,
       {_local('utc - INTERVAL 1 HOUR')} = {_local('utc')} AS second_pass
FROM {SHIFTED} s
"""

WALL = """(SELECT day, hour, CAST(day AS TIMESTAMP) + to_hours(hour) AS l
          FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders) d,
               range(0, 24) r(hour))"""

ORACLES["strict_local_time"] = f"""
SELECT day, CAST(hour AS INTEGER) AS hour, {_to_utc('l', 'hour % 2 = 1')} AS utc,
       {_problem('l', 'hour % 2 = 1')} AS problem
FROM {WALL} w
"""

ORACLES["ambiguous_hours"] = f"""
SELECT day, CAST(hour AS INTEGER) AS hour, {_exists('l')} AS exists_local, {_repeated('l')} AS is_repeated
FROM {WALL} w
"""

ORACLES["nearest_occurrence"] = f"""
WITH a AS (SELECT day, hour, l, {_first('l')} + to_minutes(CAST(40 * (hour % 3) AS INTEGER)) AS listed_utc
           FROM {WALL} w)
SELECT day, CAST(hour AS INTEGER) AS hour, listed_utc,
       CASE WHEN {_repeated('l')}
             AND abs(epoch_us({_first('l')} + INTERVAL 1 HOUR) - epoch_us(listed_utc))
                 < abs(epoch_us({_first('l')}) - epoch_us(listed_utc))
            THEN {_first('l')} + INTERVAL 1 HOUR ELSE {_first('l')} END AS posted_utc
FROM a
"""

ORACLES["dst_day_intervals"] = f"""
WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders),
e AS (SELECT day, {_first('CAST(day AS TIMESTAMP)')} AS s,
             {_first('CAST(day + INTERVAL 1 DAY AS TIMESTAMP)')} AS e FROM d)
SELECT day, CAST((epoch(e) - epoch(s)) // 900 AS INTEGER) AS n15,
       CAST((epoch(e) - epoch(s)) // 3600 AS INTEGER) AS n60
FROM e
"""

ORACLES["month_edges"] = f"""
WITH m AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders)
SELECT month, {_first('CAST(month AS TIMESTAMP)')} AS utc_start,
       {_first('CAST(month + INTERVAL 1 MONTH AS TIMESTAMP)')} AS utc_end
FROM m
"""

ORACLES["stamp_roundtrip"] = """
SELECT event_id, strftime(date_trunc('second', ts), '%Y%m%dT%H%M%SZ') AS stamp,
       date_trunc('second', ts) AS parsed
FROM events
"""

ORACLES["time_styles"] = """
SELECT event_id, date_trunc('hour', ts + INTERVAL 304 DAY) AS u,
       date_trunc('hour', ts + INTERVAL 304 DAY) AS he_utc,
       date_trunc('hour', ts + INTERVAL 304 DAY) AS hi_utc,
       date_trunc('hour', ts + INTERVAL 304 DAY) AS sced_utc
FROM events
"""

ORACLES["parse_numbers"] = """
WITH a AS (
  SELECT l_orderkey, l_linenumber, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS q, l_linenumber % 5 AS k
  FROM lineitem),
b AS (
  SELECT l_orderkey, l_linenumber,
         CASE k WHEN 0 THEN q || '.5' WHEN 1 THEN ' ' || q || ' ' WHEN 2 THEN q || 'd'
                WHEN 3 THEN '' ELSE 'x' || q END AS cell
  FROM a)
SELECT l_orderkey, l_linenumber, cell,
       CASE WHEN trim(cell) = '' OR regexp_matches(trim(cell), '[dDfF]$') THEN NULL
            ELSE TRY_CAST(trim(cell) AS DOUBLE) END AS number,
       CASE WHEN trim(cell) = '' THEN NULL
            WHEN regexp_matches(trim(cell), '[dDfF]$') OR TRY_CAST(trim(cell) AS DOUBLE) IS NULL
            THEN 'not a number ' || cell END AS number_problem,
       CASE WHEN regexp_full_match(trim(cell), '[+-]?[0-9]+') THEN TRY_CAST(trim(cell) AS INTEGER) END AS whole,
       CASE WHEN regexp_full_match(trim(cell), '[+-]?[0-9]+') AND TRY_CAST(trim(cell) AS INTEGER) IS NOT NULL
            THEN NULL ELSE 'not an integer ' || cell END AS whole_problem
FROM b
"""

ORACLES["parse_timestamps"] = """
WITH a AS (
  SELECT event_id,
         CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%g')
                           WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
                           WHEN 2 THEN strftime(ts, '%Y/%m/%d %H:%M')
                           ELSE 'T' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') END AS cell
  FROM events)
SELECT event_id, cell,
       COALESCE(try_strptime(cell, '%Y-%m-%dT%H:%M:%S.%g'), try_strptime(cell, '%Y-%m-%dT%H:%M:%S')) AS posted_local
FROM a
"""

ORACLES["hour_ending_parse"] = """
WITH a AS (
  SELECT o_orderkey, o_orderkey % 6 AS k, CAST(1 + o_orderkey % 24 AS VARCHAR) AS h,
         CAST(o_orderdate AS DATE) AS d FROM orders),
b AS (
  SELECT o_orderkey,
         CASE k WHEN 0 THEN lpad(h, 2, '0') || ':00' WHEN 1 THEN h || ':00' WHEN 2 THEN h
                WHEN 3 THEN '25:00' WHEN 4 THEN 'x' ELSE ' 7 ' END AS he_text,
         CASE k WHEN 0 THEN strftime(d, '%Y-%m-%d') WHEN 1 THEN strftime(d, '%m/%d/%Y')
                WHEN 2 THEN strftime(d, '%-m/%-d/%Y') WHEN 3 THEN strftime(d, '%Y-%-m-%-d')
                WHEN 4 THEN '13/45/2020' ELSE strftime(d, '%d.%m.%Y') END AS date_text,
         CASE k WHEN 0 THEN 'Y' WHEN 1 THEN ' n ' WHEN 2 THEN 'TRUE' WHEN 3 THEN ''
                WHEN 4 THEN 'maybe' ELSE NULL END AS flag_text
  FROM a)
SELECT o_orderkey, he_text,
       CASE WHEN TRY_CAST(split_part(trim(he_text), ':', 1) AS INTEGER) BETWEEN 1 AND 24
            THEN TRY_CAST(split_part(trim(he_text), ':', 1) AS INTEGER) END AS hour_ending,
       date_text,
       CAST(COALESCE(try_strptime(trim(date_text), '%Y-%m-%d'), try_strptime(trim(date_text), '%m/%d/%Y')) AS DATE)
         AS delivery_date,
       CASE WHEN upper(trim(flag_text)) IN ('Y', 'TRUE', '1') THEN true
            WHEN upper(trim(flag_text)) IN ('N', 'FALSE', '0', '') THEN false END AS flag,
       CASE WHEN flag_text IS NULL THEN 'flag is null'
            WHEN upper(trim(flag_text)) NOT IN ('Y', 'TRUE', '1', 'N', 'FALSE', '0', '')
            THEN 'unrecognised flag ' || flag_text END AS flag_problem
FROM b
"""


# --- declared transforms ---------------------------------------------------------------------

def _he_local(day: str, he0: str) -> str:
    """Hour-ending label -> local start, reading HE 3 on the spring-forward day as HE 2."""
    two = f"CAST({day} AS TIMESTAMP) + INTERVAL 2 HOUR"
    return (f"CAST({day} AS TIMESTAMP) + to_hours(CAST((CASE WHEN {he0} = 3 AND NOT {_exists(two)} "
            f"THEN 2 ELSE {he0} END) - 1 AS INTEGER))")


_LI_SPP = f"""
r AS (
  SELECT CAST(l_orderkey % 400 AS INTEGER) AS posting, l_orderkey, l_linenumber,
         CAST(l_shipdate AS DATE) AS day,
         CAST(1 + (l_linenumber * 5 + l_partkey) % 24 AS INTEGER) AS he0,
         'P' || CAST(l_suppkey AS VARCHAR) AS settlement_point,
         CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS settlement_point_type,
         CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS DOUBLE) AS price_mwh,
         (l_orderkey % 400) % 5 = 0 AND l_linenumber = 7 AS cut,
         l_partkey % 997 = 0 AS flag_y
  FROM lineitem),
l AS (SELECT *, {_he_local('day', 'he0')} AS lt, (NOT cut AND flag_y) AS rep FROM r),
t AS (
  SELECT posting, l_orderkey, l_linenumber, {_to_utc('lt', 'rep')} AS interval_start,
         TIMESTAMP '2024-01-01 00:00:00' + to_hours(posting) AS posted_at,
         TIMESTAMP '2024-01-01 00:02:00' + to_hours(posting) AS ingested_at,
         rep AS dst_flag, settlement_point, settlement_point_type, price_mwh, cut,
         CASE WHEN cut THEN 'flag is null' ELSE {_problem('lt', 'rep')} END AS problem
  FROM l),
d AS (
  SELECT posting, count(*) AS n_rows, CAST(sum(CASE WHEN cut THEN 1 ELSE 0 END) AS BIGINT) AS bad_rows,
         count(problem) AS n_problems, min(problem) AS row_problem
  FROM t GROUP BY posting),
s AS (
  SELECT *, '' AS missing, CASE WHEN posting % 2 = 1 THEN 'Extra' ELSE '' END AS unexpected,
         false AS repeated_header,
         CASE WHEN posting % 2 = 1 THEN 'column drift: missing [] unexpected [Extra]'
              WHEN bad_rows > 0 THEN 'cell count differs from header on ' || CAST(bad_rows AS VARCHAR) || ' rows'
              ELSE row_problem END AS problem
  FROM d)
"""

ORACLES["declared_transform"] = f"""
WITH {_LI_SPP}
SELECT t.posting, interval_start, 60 AS interval_minutes, posted_at, ingested_at, 'archive' AS source,
       1 AS schema_version, dst_flag, settlement_point, settlement_point_type, price_mwh
FROM t JOIN s ON t.posting = s.posting
WHERE s.problem IS NULL
"""

ORACLES["drift_report"] = f"""
WITH {_LI_SPP}
SELECT posting, n_rows, bad_rows, missing, unexpected, repeated_header, n_problems, problem,
       CASE WHEN problem IS NULL THEN 'ok' ELSE 'failed' END AS status
FROM s
"""

ORACLES["spp_from_lineitem"] = f"""
WITH {_LI_SPP}
SELECT posting, interval_start, settlement_point, settlement_point_type, price_mwh, dst_flag, problem
FROM t
"""

ORACLES["mcpc_domain"] = f"""
WITH r AS (
  SELECT l_orderkey, CAST(l_shipdate AS DATE) AS day, CAST(1 + l_suppkey % 24 AS INTEGER) AS h,
         CAST(1 + l_partkey % 4 AS INTEGER) AS i,
         upper(trim(CASE l_linenumber % 6 WHEN 0 THEN ' regup' WHEN 1 THEN 'REGDN ' WHEN 2 THEN 'rrs'
                                          WHEN 3 THEN 'Ecrs' WHEN 4 THEN 'nspin' ELSE 'other' END)) AS as_type,
         CAST(CAST(l_quantity AS BIGINT) AS DOUBLE) AS mcpc_mw
  FROM lineitem),
l AS (SELECT *, CAST(day AS TIMESTAMP) + to_hours(h - 1) + to_minutes(CAST((i - 1) * 15 AS INTEGER)) AS lt FROM r)
SELECT l_orderkey, {_to_utc('lt', 'false')} AS interval_start, as_type, mcpc_mw,
       COALESCE({_problem('lt', 'false')},
                CASE WHEN as_type NOT IN ('REGUP', 'REGDN', 'RRS', 'ECRS', 'NSPIN')
                     THEN 'unknown ancillary type ' || as_type END) AS problem
FROM l
"""

_LI_SERIES = f"""
r AS (
  SELECT l_orderkey, l_linenumber, l_returnflag,
         l_shipdate + to_minutes(CAST(l_orderkey % 1440 AS INTEGER)) + to_seconds(CAST(l_partkey % 60 AS BIGINT)) AS t,
         l_quantity, l_extendedprice, l_discount, l_tax
  FROM lineitem),
l AS (SELECT *, date_trunc('hour', t) + to_minutes(CAST(minute(t) - minute(t) % 5 AS INTEGER)) AS lt FROM r),
u AS (
  SELECT l_orderkey, l_linenumber, l_returnflag, {_to_utc('lt', 'false')} AS interval_start,
         {_problem('lt', 'false')} AS problem, series, raw
  FROM l UNPIVOT INCLUDE NULLS (raw FOR series IN (
      l_quantity AS 'li-measures:quantity', l_extendedprice AS 'li-measures:price',
      l_discount AS 'li-measures:discount', l_tax AS 'li-measures:tax')))
"""

ORACLES["melt_series"] = f"""
WITH {_LI_SERIES}
SELECT l_orderkey, l_linenumber, interval_start, series,
       CAST(CAST(round(raw * 100) AS BIGINT) AS DOUBLE) AS value
FROM u
"""

ORACLES["melt_skip_blank"] = f"""
WITH {_LI_SERIES}
SELECT l_orderkey, l_linenumber, interval_start, series,
       CAST(CAST(round(raw * 100) AS BIGINT) AS DOUBLE) AS value
FROM u WHERE raw <> 0
"""

ORACLES["flag_filter"] = f"""
WITH {_LI_SERIES}
SELECT l_orderkey, l_linenumber, series, CAST(CAST(round(raw * 100) AS BIGINT) AS DOUBLE) AS value, problem
FROM u WHERE l_returnflag = 'R'
"""

ORACLES["prefix_filter"] = f"""
WITH r AS (
  SELECT p_partkey, CAST('2024-03-' || lpad(CAST(1 + p_partkey % 28 AS VARCHAR), 2, '0') AS DATE) AS day,
         CAST(1 + p_size % 24 AS INTEGER) AS he0, p_brand AS settlement_point,
         CAST(CAST(round(p_retailprice * 100) AS BIGINT) AS DOUBLE) AS price_mwh
  FROM part WHERE starts_with(p_brand, 'Brand#1') OR starts_with(p_brand, 'Brand#2')),
l AS (SELECT *, {_he_local('day', 'he0')} AS lt FROM r)
SELECT p_partkey, {_to_utc('lt', 'false')} AS interval_start, settlement_point, price_mwh,
       {_problem('lt', 'false')} AS problem
FROM l
"""


# --- checks, calendars and monitoring --------------------------------------------------------

ORACLES["repeated_keys"] = """
SELECT l_returnflag, count(*) AS n_repeated_keys,
       min(CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR)) AS example,
       max(n) AS max_copies
FROM (SELECT l_returnflag, l_orderkey, l_linenumber, count(*) AS n FROM lineitem
      GROUP BY l_returnflag, l_orderkey, l_linenumber HAVING count(*) > 1) d
GROUP BY l_returnflag
"""

ORACLES["duplicate_posting_keys"] = """
SELECT l_orderkey, l_linenumber, l_shipdate, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber, l_shipdate HAVING count(*) > 1
ORDER BY n DESC, l_orderkey, l_linenumber, l_shipdate LIMIT 5
"""

ORACLES["zone_sum_findings"] = """
WITH u AS (SELECT l_orderkey AS order_key, l_extendedprice AS value, 'zone' AS kind FROM lineitem
           UNION ALL SELECT o_orderkey, o_totalprice, 'total' FROM orders),
g AS (SELECT order_key, sum(CASE WHEN kind = 'zone' THEN value END) AS parts_sum,
             max(CASE WHEN kind = 'total' THEN value END) AS total,
             count(CASE WHEN kind = 'zone' THEN 1 END) AS n_parts
      FROM u GROUP BY order_key)
SELECT order_key, round(parts_sum, 2) AS parts_sum, total, n_parts FROM g
WHERE abs(parts_sum - total) > 1.0 OR n_parts <> 7
"""

ORACLES["null_audit"] = """
WITH d AS (
  SELECT 'year=' || CAST(year(l_shipdate) AS VARCHAR) AS file, NULLIF(l_returnflag, 'R') AS l_returnflag,
         NULLIF(l_discount, 0.0) AS l_discount, NULLIF(l_tax, 0.08) AS l_tax, l_quantity FROM lineitem),
w AS (SELECT file, count(*) FILTER (WHERE l_returnflag IS NULL) AS l_returnflag,
             count(*) FILTER (WHERE l_discount IS NULL) AS l_discount,
             count(*) FILTER (WHERE l_tax IS NULL) AS l_tax,
             count(*) FILTER (WHERE l_quantity IS NULL) AS l_quantity FROM d GROUP BY file)
SELECT file, "column", n_null FROM w
UNPIVOT (n_null FOR "column" IN (l_returnflag, l_discount, l_tax, l_quantity))
WHERE n_null > 0
"""

ORACLES["version_audit"] = """
WITH d AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS file,
                  1 + CAST(event_id % 50 = 0 AS INTEGER) AS v FROM events)
SELECT file, array_to_string(list_sort(list_distinct(list(CAST(v AS VARCHAR)))), ',') AS versions,
       bool_or(v <> 1) AS unsupported
FROM d GROUP BY file
"""

ORACLES["calendar_gaps"] = """
WITH p AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders),
c AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM p)
SELECT day FROM c WHERE day NOT IN (SELECT day FROM p)
"""

_SLOT15 = "to_timestamp(floor(epoch(ts) / 900) * 900)::TIMESTAMPTZ AT TIME ZONE 'UTC'"

_COV15 = f"""
p AS (SELECT DISTINCT time_bucket(INTERVAL 15 MINUTE, ts) AS interval_start FROM events),
b AS (SELECT min(CAST({_local('interval_start')} AS DATE)) AS lo,
             max(CAST({_local('interval_start')} AS DATE)) AS hi FROM p),
d AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS delivery_date FROM b),
e AS (SELECT delivery_date,
             unnest(generate_series({_first('CAST(delivery_date AS TIMESTAMP)')},
                                    {_first('CAST(delivery_date + INTERVAL 1 DAY AS TIMESTAMP)')} - INTERVAL 15 MINUTE,
                                    INTERVAL 15 MINUTE)) AS interval_start FROM d),
c AS (SELECT e.delivery_date, count(*) AS expected, count(p.interval_start) AS present,
             list_sort(list(e.interval_start) FILTER (WHERE p.interval_start IS NULL)) AS missing
      FROM e LEFT JOIN p ON e.interval_start = p.interval_start GROUP BY e.delivery_date)
"""


def _missing_text(arr: str, limit: int) -> str:
    return (f"(array_to_string(list_transform(coalesce({arr}, [])[1:{limit}], lambda x: strftime({_local('x')}, '%H:%M')), ', ')"
            f" || CASE WHEN len(coalesce({arr}, [])) > {limit} THEN ' +' || CAST(len({arr}) - {limit} AS VARCHAR) || ' more' ELSE '' END"
            f" || ' CT')")


ORACLES["coverage_15min"] = f"""
WITH {_COV15}
SELECT 'events' AS product, delivery_date, expected, present, CAST(len(coalesce(missing, [])) AS INTEGER) AS n_missing FROM c
"""

ORACLES["missing_text"] = f"""
WITH {_COV15}
SELECT delivery_date, {_missing_text('missing', 8)} AS missing_text FROM c
"""

ORACLES["findings_limit"] = f"""
WITH {_COV15}
SELECT delivery_date, CAST(len(missing) AS INTEGER) AS n_missing, {_missing_text('missing', 4)} AS missing_text
FROM c WHERE len(coalesce(missing, [])) > 0 ORDER BY delivery_date LIMIT 5
"""

_NOW = "TIMESTAMP '2024-01-20 12:00:00'"

ORACLES["coverage_actionable"] = f"""
WITH cfg(product, cadence, interval_minutes) AS (
  VALUES ('click', 'intraday', 15), ('view', 'hourly', 60), ('purchase', 'daily_after', 60),
         ('signup', 'daily_ahead', 60), ('error', 'intraday', 5)),
t AS (SELECT CAST({_local(_NOW)} AS DATE) AS today),
d AS (SELECT cfg.*, CAST(today + to_days(CAST(k AS INTEGER)) AS DATE) AS delivery_date
      FROM cfg, t, range(-1, 2) r(k)),
cal AS (SELECT product, cadence, interval_minutes, delivery_date,
               unnest(generate_series({_first('CAST(delivery_date AS TIMESTAMP)')},
                                      {_first('CAST(delivery_date + INTERVAL 1 DAY AS TIMESTAMP)')} - to_minutes(interval_minutes),
                                      to_minutes(interval_minutes))) AS interval_start FROM d),
e AS (SELECT * FROM cal WHERE CASE
        WHEN cadence = 'daily_ahead' THEN {_NOW} >= {_first("CAST(delivery_date - INTERVAL 1 DAY AS TIMESTAMP) + INTERVAL 13 HOUR + INTERVAL 30 MINUTE")}
        WHEN cadence = 'daily_after' THEN {_NOW} >= {_first("CAST(delivery_date + INTERVAL 1 DAY AS TIMESTAMP) + INTERVAL 8 HOUR")}
        WHEN cadence = 'hourly' THEN interval_start + INTERVAL 1 HOUR + INTERVAL 30 MINUTE <= {_NOW}
        ELSE interval_start + to_minutes(interval_minutes) + INTERVAL 10 MINUTE <= {_NOW} END),
p AS (SELECT DISTINCT event_type AS product,
             to_timestamp(floor(epoch(ts) / (interval_minutes * 60)) * (interval_minutes * 60)) AT TIME ZONE 'UTC' AS interval_start
      FROM events JOIN cfg ON events.event_type = cfg.product),
c AS (SELECT e.product, e.delivery_date, first(e.cadence) AS cadence, first(e.interval_minutes) AS interval_minutes,
             count(*) AS expected, count(p.interval_start) AS present,
             list_sort(list(e.interval_start) FILTER (WHERE p.interval_start IS NULL)) AS missing
      FROM e LEFT JOIN p ON e.product = p.product AND e.interval_start = p.interval_start
      GROUP BY e.product, e.delivery_date),
a AS (SELECT *, coalesce(missing, []) AS m,
             CASE WHEN cadence IN ('daily_ahead', 'daily_after') THEN coalesce(missing, [])
                  WHEN cadence = 'hourly' THEN CASE WHEN len(coalesce(missing, [])) > 2 THEN missing ELSE [] END
                  ELSE list_filter(coalesce(missing, []), lambda x: x + to_minutes(interval_minutes) + INTERVAL 120 MINUTE <= {_NOW}) END
               AS actionable
      FROM c)
SELECT product, delivery_date, CASE WHEN cadence = 'hourly' THEN 'postings' ELSE 'intervals' END AS unit,
       expected, present, CAST(len(m) AS INTEGER) AS n_missing, CAST(len(actionable) AS INTEGER) AS n_actionable,
       {_missing_text('actionable', 4)} AS actionable_text
FROM a
"""

ORACLES["posting_hours"] = f"""
SELECT event_type AS product, CAST({_local('ts')} AS DATE) AS posting_date,
       count(DISTINCT date_trunc('hour', ts)) AS n_hours
FROM events GROUP BY ALL
"""

_FRESH = """
cfg(name, stale_after_min) AS (VALUES ('click', 60), ('view', 120), ('purchase', 30), ('signup', 1440),
                                      ('error', 15), ('refund', 60)),
s AS (SELECT event_type AS name, max(ts) AS last_seen FROM events GROUP BY event_type),
f AS (SELECT cfg.name, 'product' AS kind, cfg.stale_after_min, s.last_seen,
             (epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(s.last_seen)) / 60000000.0 AS age_minutes,
             s.name IS NULL AS absent
      FROM cfg LEFT JOIN s ON cfg.name = s.name)
"""

ORACLES["freshness_objects"] = """
WITH cfg(name, stale_after_min) AS (VALUES ('click', 60), ('view', 120), ('purchase', 30), ('signup', 1440),
                                           ('error', 15), ('refund', 60)),
s AS (SELECT event_type AS name, max(ts) AS ts FROM events GROUP BY event_type),
f AS (SELECT cfg.name, cfg.stale_after_min, CASE WHEN cfg.name IN ('click', 'purchase') THEN s.ts END AS last_seen,
             CASE WHEN s.name IS NULL THEN 'no manifest' WHEN cfg.name = 'view' THEN 'unreadable'
                  WHEN cfg.name = 'error' THEN 'no ISO timestamp' WHEN cfg.name = 'signup' THEN 'no posting yet' END AS problem
      FROM cfg LEFT JOIN s ON cfg.name = s.name),
g AS (SELECT *, (epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(last_seen)) / 60000000.0 AS age_minutes FROM f)
SELECT name, 'product' AS kind, stale_after_min, last_seen, age_minutes,
       age_minutes IS NULL OR age_minutes > stale_after_min AS stale, problem,
       CASE WHEN age_minutes IS NULL THEN name || ' (' || problem || ')'
            ELSE name || ' (' || CAST(CAST(round_even(age_minutes, 0) AS BIGINT) AS VARCHAR) || ' min > '
                 || CAST(stale_after_min AS VARCHAR) || ')' END AS reason
FROM g
"""

ORACLES["freshness"] = f"""
WITH {_FRESH}
SELECT name, kind, stale_after_min, last_seen, age_minutes,
       age_minutes IS NULL OR age_minutes > stale_after_min AS stale,
       CASE WHEN absent THEN 'no manifest' WHEN last_seen IS NULL THEN 'no posting yet' END AS problem,
       CASE WHEN age_minutes IS NULL THEN name || ' (' || CASE WHEN absent THEN 'no manifest' ELSE 'no posting yet' END || ')'
            ELSE name || ' (' || CAST(CAST(round_even(age_minutes, 0) AS BIGINT) AS VARCHAR) || ' min > '
                 || CAST(stale_after_min AS VARCHAR) || ')' END AS reason
FROM f
"""

ORACLES["stale_count"] = f"""
WITH {_FRESH}
SELECT 'FreshnessMinutes' AS metric, name AS dimension, age_minutes AS value FROM f WHERE age_minutes IS NOT NULL
UNION ALL
SELECT 'StaleProducts', NULL, CAST(sum(CASE WHEN age_minutes IS NULL OR age_minutes > stale_after_min THEN 1 ELSE 0 END) AS DOUBLE) FROM f
"""

ORACLES["run_summary"] = f"""
SELECT event_type AS product, count(DISTINCT event_id) AS docs,
       CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS rows,
       count(DISTINCT CAST({_local('ts')} AS DATE)) AS partitions,
       max(ts) AS last_posted_at, max(date_trunc('hour', ts)) AS latest_interval_start
FROM events GROUP BY event_type
"""

ORACLES["safe_progress"] = """
WITH stop AS (SELECT event_type, min(ts) AS stopped_at FROM events WHERE event_id % 997 = 0 GROUP BY event_type),
j AS (SELECT e.event_type, e.ts, s.stopped_at,
             s.stopped_at IS NULL OR e.ts < s.stopped_at AS before FROM events e LEFT JOIN stop s USING (event_type))
SELECT event_type AS product, max(ts) FILTER (WHERE before) AS watermark, first(stopped_at) AS stopped_at,
       count(*) FILTER (WHERE before) AS taken, count(*) FILTER (WHERE NOT before) AS held
FROM j GROUP BY event_type
"""

_NATION = """
c AS (SELECT c_nationkey, count(*) AS nc FROM customer GROUP BY c_nationkey),
s AS (SELECT s_nationkey, count(*) AS ns FROM supplier GROUP BY s_nationkey),
prev AS (SELECT n_name AS product, TIMESTAMP '2024-01-01' + to_minutes(CAST(nc AS INTEGER)) AS last_posted_at,
                TIMESTAMP '2024-01-01 01:00:00' AS last_run_at,
                CASE WHEN nc % 5 = 0 THEN 'error' ELSE 'ok' END AS status,
                CASE WHEN nc % 5 = 0 THEN 'failed after ' || CAST(nc AS VARCHAR) END AS error, n_nationkey
         FROM nation JOIN c ON n_nationkey = c_nationkey),
run AS (SELECT n_name AS product,
               CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE TIMESTAMP '2024-01-01' + to_hours(CAST(ns AS INTEGER)) END AS last_posted_at,
               TIMESTAMP '2024-01-02' AS run_at, CASE WHEN n_nationkey % 3 = 0 THEN 'error' ELSE 'ok' END AS status,
               CASE WHEN n_nationkey % 3 = 0 THEN 'drift' END AS error, ns AS docs, n_nationkey
        FROM nation JOIN s ON n_nationkey = s_nationkey)
"""

ORACLES["watermark_merge"] = f"""
WITH {_NATION}
SELECT coalesce(prev.product, run.product) AS product,
       coalesce(run.last_posted_at, prev.last_posted_at) AS last_posted_at,
       coalesce(run.run_at, prev.last_run_at) AS last_run_at,
       coalesce(run.status, prev.status) AS status,
       CASE WHEN run.status = 'ok' THEN NULL WHEN run.status IS NOT NULL THEN run.error ELSE prev.error END AS error
FROM prev FULL OUTER JOIN run ON prev.product = run.product
"""

ORACLES["manifest_carry"] = f"""
WITH {_NATION},
p AS (SELECT product, last_posted_at, last_run_at AS latest_interval_start, CAST(n_nationkey AS VARCHAR) AS partitions FROM prev),
r AS (SELECT product, run_at, CASE WHEN n_nationkey % 2 = 0 THEN 0 ELSE docs END AS docs, docs * 10 AS rows,
             last_posted_at, run_at AS latest_interval_start, 'new' AS partitions FROM run)
SELECT r.product, r.run_at, r.docs, r.rows,
       CASE WHEN r.docs = 0 THEN p.last_posted_at ELSE r.last_posted_at END AS last_posted_at,
       CASE WHEN r.docs = 0 THEN p.latest_interval_start ELSE r.latest_interval_start END AS latest_interval_start,
       CASE WHEN r.docs = 0 THEN p.partitions ELSE r.partitions END AS partitions,
       1 AS schema_version
FROM r LEFT JOIN p ON r.product = p.product
"""

ORACLES["catalog_retire"] = """
WITH config AS (SELECT n_name AS product, 'series' AS "table" FROM nation WHERE n_regionkey <> 0),
manifests AS (SELECT n_name AS product FROM nation WHERE n_nationkey % 2 = 0),
previous AS (SELECT n_name AS product, 'spp' AS "table" FROM nation WHERE n_nationkey < 10)
SELECT product, "table", true AS live, 'configured' AS status FROM config
UNION ALL
SELECT m.product, p."table", false, 'retired' FROM manifests m JOIN previous p ON m.product = p.product
WHERE m.product NOT IN (SELECT product FROM config)
UNION ALL
SELECT product, CAST(NULL AS VARCHAR), CAST(NULL AS BOOLEAN), 'orphan' FROM manifests
WHERE product NOT IN (SELECT product FROM config) AND product NOT IN (SELECT product FROM previous)
"""

ORACLES["sample_complete"] = """
WITH li AS (SELECT l_partkey, l_orderkey * 8 + l_linenumber AS line_no, strftime(l_shipdate, '%Y') AS year, 'N' || CAST(l_suppkey AS VARCHAR) AS point
            FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey, line_no ORDER BY year, point) = 1),
f AS (SELECT l_partkey, year, dense_rank() OVER (PARTITION BY l_partkey ORDER BY min(line_no)) AS rk FROM li GROUP BY l_partkey, year),
c AS (SELECT l_partkey, max(rk) > 2 AS complete FROM f GROUP BY l_partkey)
SELECT li.l_partkey, line_no, li.year, point, complete
FROM li JOIN f ON f.l_partkey = li.l_partkey AND f.year = li.year JOIN c ON c.l_partkey = li.l_partkey WHERE rk <= 2
QUALIFY row_number() OVER (PARTITION BY li.l_partkey, li.year ORDER BY line_no) = 1
"""

ORACLES["sample_rule"] = """
WITH li AS (
  SELECT l_suppkey, l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') AS interval_key,
         CASE WHEN l_partkey % 10 = 0 THEN 'HB_' || CAST(l_partkey AS VARCHAR)
              WHEN l_partkey % 10 = 1 THEN 'LZ_' || CAST(l_partkey AS VARCHAR)
              ELSE 'N' || CAST(l_partkey AS VARCHAR) END AS point,
         l_orderkey * 8 + l_linenumber AS line_no FROM lineitem),
f AS (SELECT l_suppkey, interval_key, dense_rank() OVER (PARTITION BY l_suppkey ORDER BY min(line_no)) AS rk
      FROM li GROUP BY l_suppkey, interval_key),
k AS (SELECT li.*, starts_with(point, 'HB_') OR starts_with(point, 'LZ_') AS hub FROM li
      JOIN f ON li.l_suppkey = f.l_suppkey AND li.interval_key = f.interval_key WHERE f.rk <= 2),
n AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey, interval_key, hub ORDER BY line_no) AS rn FROM k)
SELECT l_suppkey, l_orderkey, l_linenumber, interval_key, point, line_no FROM n WHERE hub OR rn <= 5
"""

_ERRLOG = """
lg AS (SELECT ts AS "at",
              CASE WHEN event_id % 2 = 0
                   THEN '{"level": "ERROR", "message": "run   failed\\tk=' || json_extract_string(props, '$.k')
                        || ' for user ' || CAST(user_id AS VARCHAR) || '"}'
                   ELSE 'plain  error line ' || props END AS raw
       FROM events WHERE event_type = 'error')
"""

ORACLES["error_digest"] = f"""
WITH {_ERRLOG},
w AS (SELECT * FROM lg WHERE "at" > TIMESTAMP '2024-01-29' AND "at" <= TIMESTAMP '2024-01-31'),
t AS (SELECT count(*) AS total FROM w),
n AS (SELECT "at", left(trim(regexp_replace(coalesce(CASE WHEN json_valid(raw) THEN json_extract_string(raw, '$.message') END, raw),
                                          '\\s+', ' ', 'g')), 240) AS text
      FROM w ORDER BY "at" DESC, raw LIMIT 25)
SELECT n."at", n.text, t.total FROM n, t
"""

_METRICS = """
m AS (SELECT date_trunc('hour', ts) AS "at", count(*) AS invocations,
             count(*) FILTER (WHERE event_type = 'error') AS errors FROM events GROUP BY 1)
"""

ORACLES["error_rate"] = f"""
WITH {_METRICS},
g AS (SELECT CAST(coalesce(sum(invocations), 0) AS BIGINT) AS invocations, CAST(coalesce(sum(errors), 0) AS BIGINT) AS errors
      FROM m WHERE "at" > TIMESTAMP '2024-01-24' AND "at" <= TIMESTAMP '2024-01-31')
SELECT invocations, errors, CASE WHEN invocations = 0 THEN 0.0 ELSE errors / invocations END AS error_rate FROM g
"""

ORACLES["closest_to_limit"] = """
WITH th(name, stale_after_min) AS (VALUES ('click', 60), ('view', 120), ('purchase', 30), ('signup', 1440),
                                          ('error', 15), ('refund', 60)),
p AS (SELECT event_type AS name, max(value) AS peak FROM events GROUP BY event_type)
SELECT p.name, peak, stale_after_min, round(peak / stale_after_min, 6) AS ratio
FROM p JOIN th ON p.name = th.name ORDER BY peak / stale_after_min DESC, p.name LIMIT 1
"""

ORACLES["kpis"] = f"""
WITH {_COV15}, {_METRICS},
y AS (SELECT CAST({_local(_NOW)} AS DATE) - INTERVAL 1 DAY AS d),
k AS (SELECT sum(expected) AS e, sum(len(coalesce(missing, []))) AS m, first(delivery_date) AS d
      FROM c WHERE delivery_date = (SELECT CAST(d AS DATE) FROM y)),
g AS (SELECT CAST(coalesce(sum(invocations), 0) AS BIGINT) AS inv, CAST(coalesce(sum(errors), 0) AS BIGINT) AS err
      FROM m WHERE "at" > TIMESTAMP '2024-01-19 12:00:00' AND "at" <= {_NOW})
SELECT 1 AS rank, 'covered on ' || CAST(d AS VARCHAR) || ': ' || format('{{:,.1f}}', round_even(100.0 * (e - m) / e, 1))
       || ' % (' || CAST(m AS VARCHAR) || ' of ' || format('{{:,}}', e) || ' missing)' AS text
FROM k WHERE e > 0
UNION ALL
SELECT 3, 'runs within a day: ' || format('{{:,}}', inv) || ', ' || CAST(err AS VARCHAR) || ' failed ('
       || format('{{:,.2f}}', round_even(CASE WHEN inv = 0 THEN 0.0 ELSE err / inv END * 100, 2)) || '%)'
FROM g
UNION ALL
SELECT 2, 'alarms within a day: ' || CAST(count(*) AS VARCHAR) FROM events
WHERE event_type = 'error' AND event_id % 2 = 0 AND ts > TIMESTAMP '2024-01-19 12:00:00' AND ts <= {_NOW}
UNION ALL
(SELECT 4, 'nearest to its limit: ' || event_type || ' with ' || CAST(CAST(round_even(max(value), 0) AS BIGINT) AS VARCHAR) || ' of '
        || CAST(stale AS VARCHAR) || ' min'
 FROM events JOIN (VALUES ('click', 60), ('view', 120), ('purchase', 30), ('signup', 1440), ('error', 15), ('refund', 60)) th(name, stale)
   ON name = event_type GROUP BY event_type, stale ORDER BY max(value) / stale DESC, event_type LIMIT 1)
UNION ALL
SELECT 5, 'sec' || CAST(user_id AS VARCHAR) || ': ' || k FROM events, (VALUES ('n=1'), ('n=2')) kk(k)
WHERE event_type = 'signup' AND event_id % 7 <> 0 AND event_id % 11 <> 0
"""

ORACLES["alarm_states"] = """
WITH per AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS bucket, max(value) AS stat FROM events
             WHERE event_type = 'error' GROUP BY 1),
cal AS (SELECT unnest(generate_series(min(bucket), max(bucket), INTERVAL 5 MINUTE)) AS bucket FROM per),
s AS (SELECT cal.bucket, per.stat, CASE WHEN per.stat IS NULL THEN true ELSE per.stat > 25.0 END AS breaching,
             (SELECT min(bucket) FROM per) AS lo
      FROM cal LEFT JOIN per ON cal.bucket = per.bucket),
w AS (SELECT *, CASE WHEN bucket >= lo + INTERVAL 10 MINUTE
                          AND bool_and(breaching) OVER (ORDER BY bucket ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
                     THEN 'ALARM' ELSE 'OK' END AS state FROM s)
SELECT 'ingest-errors' AS metric, bucket, stat, breaching, state,
       coalesce(lag(state) OVER (ORDER BY bucket) <> state, false) AS changed
FROM w
"""

ORACLES["alarm_states_silent"] = """
WITH per AS (SELECT 'no-sales-' || CAST(user_id % 3 AS VARCHAR) AS metric, date_trunc('hour', ts) AS bucket, sum(-1.0::DOUBLE) AS stat
             FROM events WHERE event_type = 'purchase' GROUP BY ALL),
b AS (SELECT metric, min(bucket) AS lo, greatest(max(bucket), TIMESTAMP '2024-02-03 09:00:00') AS hi FROM per GROUP BY metric),
cal AS (SELECT metric, lo, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS bucket FROM b),
s AS (SELECT cal.metric, cal.lo, cal.bucket, per.stat, coalesce(per.stat > -3.5, true) AS breaching
      FROM cal LEFT JOIN per ON cal.metric = per.metric AND cal.bucket = per.bucket),
w AS (SELECT *, CASE WHEN bucket > lo AND breaching AND lag(breaching) OVER (PARTITION BY metric ORDER BY bucket)
                     THEN 'ALARM' ELSE 'OK' END AS state FROM s)
SELECT metric, bucket, stat, breaching, state,
       coalesce(lag(state) OVER (PARTITION BY metric ORDER BY bucket) <> state, false) AS changed
FROM w
"""

ORACLES["alarm_transitions"] = """
SELECT ts AS at, CASE WHEN user_id % 3 = 0 THEN 'other-' ELSE 'ingest-' END || CAST(user_id AS VARCHAR) AS alarm,
       CASE WHEN event_id % 2 = 0 THEN 'OK' ELSE 'ALARM' END AS old,
       CASE WHEN event_id % 2 = 0 THEN 'ALARM' ELSE 'OK' END AS new,
       'k=' || json_extract_string(props, '$.k') AS reason
FROM events
WHERE event_type = 'error' AND user_id % 3 <> 0 AND ts > TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-20'
"""

ORACLES["newest_batch"] = f"""
WITH b AS (SELECT DISTINCT CAST({_local('ts')} AS DATE) AS date,
                  'part-' || strftime(date_trunc('hour', ts), '%Y%m%dT%H%M%SZ') AS batch FROM events)
SELECT date, batch, batch = max(batch) OVER (PARTITION BY date) AS newest FROM b
"""

ORACLES["union_by_name"] = """
SELECT s_suppkey AS key, s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal, CAST(NULL AS VARCHAR) AS segment
FROM supplier
UNION ALL
SELECT c_custkey, c_name, c_nationkey, NULL, c_mktsegment FROM customer
"""

ORACLES["delivery_range"] = f"""
SELECT day AS date, user_id, event_type, posted_at, event_id, value FROM {LOG} l
WHERE day BETWEEN DATE '2024-01-07' AND DATE '2024-01-09'
"""

ORACLES["version_gate"] = """
SELECT 1 + CAST(event_id % 50 = 0 AS INTEGER) AS schema_version, count(*) AS n_rows,
       1 + CAST(event_id % 50 = 0 AS INTEGER) = 1 AS supported
FROM events GROUP BY 1
"""

ORACLES["typed_empty"] = f"""
SELECT day, user_id, event_type, posted_at, event_id, value FROM {LOG} l
WHERE posted_at <= TIMESTAMP '2023-12-31 00:00:00'
QUALIFY row_number() OVER (PARTITION BY day, user_id, event_type ORDER BY posted_at DESC) = 1
"""

ORACLES["quality_rules"] = """
SELECT 'on_grid' AS rule, count(*) AS n_checked,
       count(*) FILTER (WHERE minute(time_bucket(INTERVAL 15 MINUTE, ts)) % 15 <> 0
                        OR second(time_bucket(INTERVAL 15 MINUTE, ts)) <> 0) AS n_failed FROM events
UNION ALL
SELECT 'delivery_after_posting', count(*), count(*) FILTER (WHERE l_shipdate < o_orderdate)
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
UNION ALL
SELECT 'total_within_tolerance', count(*), count(*) FILTER (WHERE abs(s - t) > greatest(1.0, abs(t) * 1e-4))
FROM (SELECT o_orderkey, sum(l_extendedprice) AS s, first(o_totalprice) AS t
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderkey) x
UNION ALL
SELECT 'same_names', count(*), count(*) FILTER (WHERE n < 2)
FROM (SELECT user_id, CAST(bool_or(event_id % 5 < 3) AS INTEGER) + CAST(bool_or(event_id % 5 > 1) AS INTEGER) AS n
      FROM events WHERE user_id % 3 = 0 GROUP BY user_id) x
"""


# --- archives --------------------------------------------------------------------------------

_POSTED = f"""
p AS (SELECT *, date_trunc('second', max({_local('ts')}) OVER (PARTITION BY event_type, CAST({_local('ts')} AS DATE)))
                AS posted_local,
             (CAST({_local('ts')} AS DATE) - DATE '2023-12-31') * 10
               + CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2
                                 WHEN 'signup' THEN 3 WHEN 'view' THEN 4 ELSE 9 END AS doc_id
      FROM events)
"""

ORACLES["posting_zip_scan"] = f"""
WITH {_POSTED}
SELECT event_id, ts, user_id, event_type, value, posted_local FROM p
"""

ORACLES["bundle_scan"] = f"""
WITH {_POSTED}
SELECT event_id, ts, user_id, event_type, value, posted_local, CAST(doc_id AS BIGINT) AS doc_id FROM p
"""


# --- raw landing, curated lake, compaction ---------------------------------------------------

_CURATED = f"""
cu AS (SELECT 'ev-' || event_type AS product, date_trunc('hour', ts) AS interval_start, ts AS posted_at,
              ts + INTERVAL 2 MINUTE AS ingested_at, 'user:' || CAST(user_id AS VARCHAR) AS series, value,
              CAST({_local("date_trunc('hour', ts)")} AS DATE) AS date,
              'part-' || strftime(date_trunc('day', ts), '%Y%m%dT%H%M%SZ') AS batch
       FROM events)
"""

ORACLES["curated_roundtrip"] = f"""
WITH {_CURATED}
SELECT product, date, batch, interval_start, posted_at, series, value FROM cu
"""

ORACLES["raw_roundtrip"] = "SELECT event_id, ts, user_id, event_type, value FROM events"

ORACLES["scan_days"] = f"""
WITH {_CURATED}
SELECT date, interval_start, series, posted_at, value FROM cu
WHERE product = 'ev-click' AND date BETWEEN DATE '2024-01-07' AND DATE '2024-01-09'
  AND posted_at <= TIMESTAMP '2024-01-09 12:00:00'
QUALIFY row_number() OVER (PARTITION BY interval_start, series ORDER BY posted_at DESC, ingested_at DESC) = 1
"""

ORACLES["file_listing"] = f"""
WITH {_CURATED}
SELECT product, date, count(DISTINCT batch) AS n_batches FROM cu GROUP BY product, date
"""

ORACLES["path_parts"] = f"""
WITH {_CURATED}
SELECT DISTINCT product, date, batch, 'part' AS kind, date_trunc('day', posted_at) AS stamp FROM cu
"""

ORACLES["compaction_summary"] = f"""
WITH {_CURATED},
p AS (SELECT product, date, count(DISTINCT batch) AS nb, count(*) AS n FROM cu GROUP BY product, date HAVING count(DISTINCT batch) >= 2)
SELECT product, count(*) AS partitions, CAST(sum(nb) AS BIGINT) AS batches_in, CAST(sum(n) AS BIGINT) AS rows,
       CAST(0 AS BIGINT) AS leftovers, CAST(0 AS BIGINT) AS skipped
FROM p GROUP BY product
"""

ORACLES["compaction_off_contract"] = f"""
WITH {_CURATED},
p AS (SELECT product, date, count(DISTINCT batch) AS nb, count(*) AS n,
             count(DISTINCT batch) > 1 AND date = DATE '2024-01-05' AND product IN ('ev-click', 'ev-view')
               AND bool_or(batch = 'part-20240105T000000Z') AS odd
      FROM cu GROUP BY product, date HAVING count(DISTINCT batch) >= 2)
SELECT product, count(*) FILTER (WHERE NOT odd) AS partitions, CAST(coalesce(sum(nb) FILTER (WHERE NOT odd), 0) AS BIGINT) AS batches_in,
       CAST(coalesce(sum(n) FILTER (WHERE NOT odd), 0) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS leftovers,
       count(*) FILTER (WHERE odd) AS skipped
FROM p GROUP BY product
"""

ORACLES["compaction_identity"] = f"""
WITH {_CURATED}
SELECT product, interval_start, series, posted_at, value FROM cu
WHERE posted_at <= TIMESTAMP '2024-01-20 00:00:00'
QUALIFY row_number() OVER (PARTITION BY product, interval_start, series ORDER BY posted_at DESC, ingested_at DESC) = 1
"""

ORACLES["snapshot_reads"] = f"""
WITH {_CURATED},
p AS (SELECT product, count(*) AS n_rows, CAST(sum(floor(value)) AS BIGINT) AS value_sum FROM cu
      WHERE posted_at <= TIMESTAMP '2024-01-20 00:00:00' AND interval_start >= TIMESTAMP '2024-01-01 06:00:00'
        AND interval_start < TIMESTAMP '2024-02-01 06:00:00' GROUP BY product)
SELECT phase, product, n_rows, value_sum FROM p, (VALUES ('before'), ('during'), ('pinned'), ('after'), ('vacuumed')) v(phase)
"""

ORACLES["indexed_reads"] = f"""
WITH {_CURATED}
SELECT product, names, interval_start, series, posted_at, value, true AS fewer FROM cu, (VALUES ('all'), ('few')) v(names)
WHERE posted_at <= TIMESTAMP '2024-01-11 00:00:00' AND interval_start >= TIMESTAMP '2024-01-10 06:00:00'
  AND interval_start < TIMESTAMP '2024-01-12 00:00:00' AND (names = 'all' OR series IN ('user:7', 'user:11', 'user:404'))
QUALIFY row_number() OVER (PARTITION BY product, names, interval_start, series ORDER BY posted_at DESC, ingested_at DESC) = 1
"""

ORACLES["lake_difference"] = f"""
WITH {_CURATED},
one AS (SELECT min(posted_at) AS t FROM cu WHERE product = 'ev-view' AND date = DATE '2024-01-12'),
b AS (SELECT product, date, batch, interval_start, posted_at, series, value + CASE WHEN product = 'ev-view' AND posted_at = t THEN 1 ELSE 0 END AS value
      FROM cu, one WHERE NOT (product = 'ev-click' AND batch = 'part-20240108T000000Z')
      UNION ALL SELECT product, date, 'part-20240201T000000Z', interval_start, posted_at, series, value FROM cu
      WHERE product = 'ev-error' AND date = DATE '2024-01-12'),
x AS (SELECT product, date, batch, count(*) AS n, list_sort(list(posted_at || '|' || series || '|' || value)) AS l FROM cu GROUP BY ALL),
y AS (SELECT product, date, batch, count(*) AS n, list_sort(list(posted_at || '|' || series || '|' || value)) AS l FROM b GROUP BY ALL)
SELECT coalesce(x.product, y.product) AS product, coalesce(x.date, y.date) AS date, coalesce(x.batch, y.batch) AS batch, x.n, y.n AS o_n
FROM x FULL JOIN y ON x.product = y.product AND x.date = y.date AND x.batch = y.batch
WHERE x.l IS DISTINCT FROM y.l
"""

ORACLES["leftover_files"] = """
SELECT 'part-' || CAST(l_suppkey % 5 AS VARCHAR) AS batch, count(*) AS n_rows, l_suppkey % 5 < 3 AS held
FROM lineitem GROUP BY l_suppkey % 5
"""


# --- ingestion -------------------------------------------------------------------------------

def _ingest(extra: str = "", src: str = "po") -> str:
    """The ingest CTE chain; ``extra`` CTEs may define another posting source ``src``."""
    return f"""
ev AS (SELECT *, {_local('ts')} AS lts FROM events),
po AS (SELECT *, CAST(lts AS DATE) AS pday,
              date_trunc('second', max(lts) OVER (PARTITION BY event_type, CAST(lts AS DATE))) AS posted_local,
              (CAST(lts AS DATE) - DATE '2023-12-31') * 10
                + CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2
                                  WHEN 'signup' THEN 3 WHEN 'view' THEN 4 ELSE 9 END AS doc_id,
              date_trunc('hour', date_trunc('second', lts))
                + to_minutes(CAST(minute(lts) - minute(lts) % 5 AS INTEGER)) AS l5
       FROM ev),{extra}
r AS (SELECT 'ev-' || event_type AS product, doc_id, {_first('posted_local')} AS posted_at,
             {_first('l5')} AS interval_start, CAST(user_id AS VARCHAR) AS settlement_point,
             event_type AS settlement_point_type, value AS price_mwh FROM {src}),
st AS (SELECT product, doc_id, posted_at,
              max(n) > 1 AS failed
       FROM (SELECT product, doc_id, posted_at, count(*) AS n FROM r
             GROUP BY product, doc_id, posted_at, interval_start, settlement_point, settlement_point_type) k
       GROUP BY product, doc_id, posted_at),
stop AS (SELECT product, min((posted_at, doc_id)) AS s, min(posted_at) AS stopped_at FROM st WHERE failed GROUP BY product),
taken AS (SELECT st.product, st.doc_id, st.posted_at FROM st LEFT JOIN stop ON st.product = stop.product
          WHERE NOT st.failed AND (stop.s IS NULL OR (st.posted_at, st.doc_id) < stop.s)),
acc AS (SELECT r.*, CAST({_local('r.interval_start')} AS DATE) AS date,
               'part-' || strftime(r.posted_at, '%Y%m%dT%H%M%SZ') || '-' || r.doc_id AS batch
        FROM r JOIN taken t ON r.product = t.product AND r.doc_id = t.doc_id)
"""


_INGEST = _ingest()

_INGEST_ROWS = f"""
WITH {_INGEST}
SELECT product, interval_start, settlement_point, settlement_point_type, price_mwh, posted_at, date, batch FROM acc
"""
ORACLES["ingest_end_to_end"] = _INGEST_ROWS
ORACLES["rebuild_identity"] = _INGEST_ROWS

ORACLES["ingest_summary"] = f"""
WITH {_INGEST},
a AS (SELECT product, count(DISTINCT doc_id) AS docs, count(*) AS rows, count(DISTINCT date) AS partitions,
             max(posted_at) AS last_posted_at FROM acc GROUP BY product),
f AS (SELECT product, count(*) FILTER (WHERE failed) AS failed FROM st GROUP BY product)
SELECT f.product, coalesce(a.docs, 0) AS docs, coalesce(a.rows, 0) AS rows, coalesce(a.partitions, 0) AS partitions,
       a.last_posted_at, f.failed, stop.stopped_at
FROM f LEFT JOIN a ON f.product = a.product LEFT JOIN stop ON f.product = stop.product
"""

ORACLES["ingest_manifests"] = f"""
WITH {_INGEST},
a AS (SELECT product, count(DISTINCT doc_id) AS docs, count(*) AS rows, max(posted_at) AS last_posted_at,
             max(interval_start) AS latest_interval_start FROM acc GROUP BY product),
f AS (SELECT DISTINCT product FROM st)
SELECT f.product, coalesce(a.docs, 0) AS docs, coalesce(a.rows, 0) AS rows, a.last_posted_at, a.latest_interval_start
FROM f LEFT JOIN a ON f.product = a.product
"""

_CORRUPT = _INGEST.replace("max(n) > 1 AS failed",
                           "max(n) > 1 OR (product IN ('ev-click', 'ev-view', 'ev-error') AND CAST("
                           + _local("posted_at") + " AS DATE) = DATE '2024-01-08') AS failed")
ORACLES["ingest_corrupt_posting"] = f"""
WITH {_CORRUPT},
a AS (SELECT product, count(DISTINCT doc_id) AS docs, count(*) AS rows, max(posted_at) AS last_posted_at FROM acc GROUP BY product),
f AS (SELECT product, count(*) FILTER (WHERE failed) AS failed FROM st GROUP BY product)
SELECT f.product, coalesce(a.docs, 0) AS docs, coalesce(a.rows, 0) AS rows, f.failed, stop.stopped_at, a.last_posted_at
FROM f LEFT JOIN a ON f.product = a.product LEFT JOIN stop ON f.product = stop.product
"""

ORACLES["backfill_no_watermark"] = f"""
WITH {_INGEST},
a AS (SELECT product, max(posted_at) AS last_posted_at FROM acc GROUP BY product),
f AS (SELECT product, count(*) FILTER (WHERE failed) AS failed FROM st GROUP BY product)
SELECT f.product, a.last_posted_at, CASE WHEN f.failed > 0 THEN 'error' ELSE 'ok' END AS status
FROM f LEFT JOIN a ON f.product = a.product
"""

ORACLES["backfill_rows"] = f"""
WITH {_INGEST},
w AS (SELECT st.product, st.doc_id, st.posted_at, st.failed FROM st WHERE st.posted_at > TIMESTAMP '2024-01-01' AND st.posted_at <= TIMESTAMP '2024-01-09 12:00:00'),
ws AS (SELECT product, min((posted_at, doc_id)) AS s FROM w WHERE failed GROUP BY product),
again AS (SELECT w.product, w.doc_id FROM w LEFT JOIN ws ON w.product = ws.product
          WHERE NOT w.failed AND (ws.s IS NULL OR (w.posted_at, w.doc_id) < ws.s))
SELECT product, interval_start, settlement_point, settlement_point_type, price_mwh, posted_at, date, batch FROM acc
WHERE date >= DATE '2024-01-08'
UNION ALL
SELECT r.product, interval_start, settlement_point, settlement_point_type, price_mwh, r.posted_at,
       CAST({_local('r.interval_start')} AS DATE), 'part-' || strftime(r.posted_at, '%Y%m%dT%H%M%SZ') || '-' || r.doc_id
FROM r JOIN again a ON r.product = a.product AND r.doc_id = a.doc_id
WHERE CAST({_local('r.interval_start')} AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-07'
"""

ORACLES["stream_ingest"] = _INGEST_ROWS

ORACLES["stream_latest"] = f"""
SELECT day, user_id, event_type, posted_at, event_id, value FROM {LOG} l
QUALIFY row_number() OVER (PARTITION BY day, user_id, event_type ORDER BY posted_at DESC) = 1
"""

ORACLES["stream_current"] = """
SELECT user_id, event_type, ts AS posted_at, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
"""

ORACLES["listing_stream"] = f"""
SELECT event_id AS doc_id, strftime({_local("ts + INTERVAL 304 DAY")}, '%Y-%m-%dT%H:%M:%S.%g') AS post_local_text,
       CASE WHEN event_id % 5 <> 0 THEN 'ev_' || event_type END AS friendly_name,
       CASE WHEN event_id <= (SELECT max(event_id) * 3 // 4 FROM events) THEN 1 ELSE 2 END AS run, true AS fewer
FROM events
"""

ORACLES["stream_hourly_counts"] = """
SELECT date_trunc('hour', ts) AS hour_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS hour_end, event_type,
       count(*) AS n
FROM events
WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR
GROUP BY ALL
"""

ORACLES["verify_findings"] = f"""
WITH {_CURATED},
base AS (
  SELECT product, interval_start, posted_at, series, value, date, batch,
         CASE WHEN product = 'ev-error' AND second(posted_at) % 17 = 0 THEN NULL ELSE 'archive' END AS source,
         CASE WHEN product = 'ev-signup' AND second(posted_at) % 13 = 0 THEN 2 ELSE 1 END AS schema_version
  FROM cu WHERE NOT (product = 'ev-click' AND date = DATE '2024-01-05')),
dup AS (SELECT product, interval_start, posted_at, series, value, date, 'part-20240201T000000Z' AS batch,
               'archive' AS source, 1 AS schema_version
        FROM cu WHERE product = 'ev-view' AND second(posted_at) % 11 = 0),
lake AS (SELECT * FROM base UNION ALL SELECT * FROM dup),
k AS (SELECT product, interval_start, series, posted_at, count(*) AS n FROM lake
      GROUP BY ALL HAVING count(*) > 1),
k5 AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY product ORDER BY n DESC, interval_start, series, posted_at) <= 5),
days AS (SELECT DISTINCT product, date FROM lake),
bounds AS (SELECT product, min(date) AS lo, max(date) AS hi FROM days GROUP BY product),
cal AS (SELECT product, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM bounds)
SELECT product, 'keys' AS "check",
       strftime(interval_start, '%Y-%m-%d %H:%M:%S') || '|' || series || ' posted ' ||
       strftime(posted_at, '%Y-%m-%d %H:%M:%S') || ' x' || CAST(n AS VARCHAR) AS detail FROM k5
UNION ALL
SELECT product, 'keys', CAST(count(*) AS VARCHAR) || ' repeated keys in all' FROM k GROUP BY product HAVING count(*) > 5
UNION ALL
SELECT product, 'nulls', 'date=' || CAST(date AS VARCHAR) || ' batch=' || batch || ': source has '
       || CAST(count(*) AS VARCHAR) || ' NULL'
FROM lake WHERE source IS NULL GROUP BY product, date, batch
UNION ALL
SELECT product, 'versions', 'date=' || CAST(date AS VARCHAR) || ' batch=' || batch || ': versions '
       || array_to_string(list_sort(list_distinct(list(CAST(schema_version AS VARCHAR)))), ',')
FROM lake GROUP BY product, date, batch HAVING bool_or(schema_version <> 1)
UNION ALL
SELECT c.product, 'calendar', 'missing day ' || CAST(c.date AS VARCHAR)
FROM cal c LEFT JOIN days d ON c.product = d.product AND c.date = d.date WHERE d.date IS NULL
"""

ORACLES["verify_products"] = f"""
WITH {_CURATED},
base AS (
  SELECT product, interval_start, posted_at, series, date, batch,
         CASE WHEN product = 'ev-error' AND second(posted_at) % 17 = 0 THEN NULL ELSE 'archive' END AS source,
         CASE WHEN product = 'ev-signup' AND second(posted_at) % 13 = 0 THEN 2 ELSE 1 END AS schema_version
  FROM cu WHERE product <> 'ev-purchase' AND NOT (product = 'ev-click' AND date = DATE '2024-01-05')),
dup AS (SELECT product, interval_start, posted_at, series, date, 'part-20240201T000000Z' AS batch, 'archive' AS source, 1 AS schema_version
        FROM cu WHERE product = 'ev-view' AND second(posted_at) % 11 = 0),
lake AS (SELECT * FROM base UNION ALL SELECT * FROM dup),
per AS (SELECT interval_start, date, CAST(count(*) FILTER (WHERE product = 'ev-click') AS DOUBLE) AS a,
               CAST(count(*) FILTER (WHERE product = 'ev-view') AS DOUBLE) AS b, CAST(epoch(interval_start) AS BIGINT) // 3600 AS h
        FROM cu WHERE product IN ('ev-click', 'ev-view') GROUP BY interval_start, date),
z AS (SELECT * FROM per WHERE date NOT IN (DATE '2024-01-03', DATE '2024-01-09')),
zf AS (SELECT interval_start, CASE WHEN h % 70 = 0 THEN 1 ELSE 2 END AS n, CASE WHEN h % 70 = 0 THEN b ELSE a + b END AS zones,
              a + b + CASE WHEN h % 50 = 0 THEN 500 ELSE 0 END AS total
       FROM z WHERE h % 3 <> 0 AND (h % 70 = 0 OR h % 50 = 0) ORDER BY interval_start LIMIT 5),
k AS (SELECT product, strftime(interval_start, '%Y-%m-%d %H:%M:%S') || '|' || series AS key, interval_start, series, posted_at, count(*) AS n
      FROM lake GROUP BY ALL HAVING count(*) > 1
      UNION ALL
      SELECT 'prices', strftime(interval_start, '%Y-%m-%d %H:%M:%S') || '|' || series || '|N', interval_start, series, posted_at, count(*)
      FROM cu WHERE product = 'ev-purchase' AND batch <> 'part-20240110T000000Z' GROUP BY ALL HAVING count(*) > 1),
k5 AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY product ORDER BY n DESC, interval_start, series, posted_at) <= 5),
days AS (SELECT DISTINCT product, date FROM lake
         UNION SELECT 'zones', date FROM z WHERE date >= DATE '2024-01-04'
         UNION SELECT 'prices', date FROM cu WHERE product = 'ev-purchase'),
bounds AS (SELECT product, min(date) AS lo, max(date) AS hi FROM days GROUP BY product),
cal AS (SELECT product, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM bounds),
gone AS (SELECT c.product, list(CAST(c.date AS VARCHAR) ORDER BY c.date) AS d FROM cal c LEFT JOIN days d ON c.product = d.product AND c.date = d.date
         WHERE d.date IS NULL GROUP BY c.product)
SELECT product, 'keys' AS "check", key || ' posted ' || strftime(posted_at, '%Y-%m-%d %H:%M:%S') || ' x' || CAST(n AS VARCHAR) AS detail FROM k5
UNION ALL
SELECT product, 'keys', CAST(count(*) AS VARCHAR) || ' repeated keys in all' FROM k GROUP BY product HAVING count(*) > 5
UNION ALL
SELECT product, 'nulls', 'date=' || CAST(date AS VARCHAR) || ' batch=' || batch || ': source has ' || CAST(count(*) AS VARCHAR) || ' NULL'
FROM lake WHERE source IS NULL GROUP BY product, date, batch
UNION ALL
SELECT product, 'versions', 'date=' || CAST(date AS VARCHAR) || ' batch=' || batch || ': versions '
       || array_to_string(list_sort(list_distinct(list(CAST(schema_version AS VARCHAR)))), ',')
FROM lake GROUP BY product, date, batch HAVING bool_or(schema_version <> 1)
UNION ALL
SELECT product, 'calendar', CAST(len(d) AS VARCHAR) || ' missing delivery days: ' || array_to_string(d[1:5], ', ') || CASE WHEN len(d) > 5 THEN ' ...' ELSE '' END
FROM gone
UNION ALL
SELECT DISTINCT 'prices', 'files', 'date=' || CAST(date AS VARCHAR) || ' batch=' || batch || ': differs from the contract: unexpected note string'
FROM cu WHERE product = 'ev-purchase' AND batch = 'part-20240110T000000Z'
UNION ALL
SELECT 'zones', 'zones', strftime(interval_start, '%Y-%m-%d %H:%M:%S') || ' posted ' || strftime(interval_start, '%Y-%m-%d %H:%M:%S') || ': '
       || CAST(n AS VARCHAR) || ' zones sum ' || format('{{:,.1f}}', zones) || ', total ' || format('{{:,.1f}}', total) FROM zf
"""


# --- API pages, JSON objects, listings, source planning, workbook rows -----------------------

_API_SPP = _LI_SPP.replace("(l_orderkey % 400) % 5 = 0 AND l_linenumber = 7 AS cut", "false AS cut")
ORACLES["api_transform"] = f"""
WITH {_API_SPP}
SELECT CAST(l_orderkey AS BIGINT) AS posting, interval_start, settlement_point, settlement_point_type, price_mwh, dst_flag,
       'api' AS source, problem FROM t
"""

ORACLES["bundle_window"] = f"""
WITH {_INGEST}
SELECT CAST(doc_id AS BIGINT) AS doc_id, posted_at, count(*) AS n_lines FROM r
WHERE posted_at > TIMESTAMP '2024-01-10' AND posted_at <= TIMESTAMP '2024-01-20' GROUP BY ALL
"""

ORACLES["catalog_publish"] = """
WITH t AS (SELECT DISTINCT event_type AS product FROM events)
SELECT product, CASE WHEN product = 'signup' THEN NULL ELSE 'series' END AS "table",
       CASE WHEN product = 'signup' THEN NULL ELSE product <> 'view' END AS live,
       CASE product WHEN 'signup' THEN 'orphan' WHEN 'view' THEN 'retired' ELSE 'configured' END AS status,
       TIMESTAMP '2024-01-02' AS generated_at FROM t
UNION ALL SELECT 'refund', 'spp', true, 'configured', TIMESTAMP '2024-01-02'
"""

ORACLES["api_json_pages"] = "SELECT event_id, ts, user_id, event_type, value FROM events"

ORACLES["json_objects"] = """
SELECT event_id,
       CASE WHEN event_id % 97 = 0 OR event_id % 89 = 0 THEN NULL ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
       CASE WHEN event_id % 97 = 0 THEN 'unreadable' WHEN event_id % 89 = 0 THEN 'missing' ELSE 'ok' END AS status
FROM events
"""

_LISTING = """
SELECT event_id AS doc_id, ts + INTERVAL 304 DAY AS posted_at,
       CASE WHEN event_id % 5 <> 0 THEN 'ev_' || event_type ELSE CAST(event_id AS VARCHAR) END AS name
FROM events
"""

ORACLES["listing_window"] = f"""
SELECT doc_id, date_trunc('millisecond', posted_at) AS posted_at, name, CAST(NULL AS VARCHAR) AS problem FROM ({_LISTING}) l
WHERE date_trunc('millisecond', posted_at) > TIMESTAMP '2024-11-03 05:00:00'
  AND date_trunc('millisecond', posted_at) <= TIMESTAMP '2024-11-04 00:00:00'
"""

ORACLES["listing_broken_stamps"] = f"""
SELECT doc_id, CASE WHEN bad THEN NULL ELSE date_trunc('millisecond', posted_at) END AS posted_at, name,
       CASE WHEN doc_id % 61 = 0 THEN 'unreadable posting time: none'
            WHEN bad THEN 'unreadable posting time: at ' || CAST(doc_id AS VARCHAR) END AS problem
FROM (SELECT *, doc_id % 61 = 0 OR doc_id % 53 = 0 AS bad FROM ({_LISTING}) x) l
WHERE bad OR date_trunc('millisecond', posted_at) > TIMESTAMP '2024-11-03 08:00:00'
  AND date_trunc('millisecond', posted_at) <= TIMESTAMP '2024-11-04 00:00:00'
"""

ORACLES["json_object_files"] = """
WITH n AS (SELECT user_id, props FROM events WHERE event_type = 'signup'
           QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT 'user-' || CAST(user_id AS VARCHAR) || '.json' AS name,
       CASE WHEN user_id % 5 <> 0 AND user_id % 13 <> 0 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
       CASE WHEN user_id % 5 = 0 THEN 'missing' WHEN user_id % 13 = 0 THEN 'unreadable' ELSE 'ok' END AS status
FROM n
"""

ORACLES["history_window"] = f"""
SELECT doc_id, date_trunc('millisecond', posted_at) AS posted_at, name, CAST(NULL AS VARCHAR) AS problem FROM ({_LISTING}) l
WHERE doc_id % 2 = 1 AND date_trunc('millisecond', posted_at) > TIMESTAMP '2024-11-01 00:00:00'
  AND date_trunc('millisecond', posted_at) <= TIMESTAMP '2024-11-10 00:00:00'
"""

ORACLES["source_plan"] = f"""
WITH months AS (SELECT CAST(unnest(generate_series(DATE '1995-12-01', DATE '1997-06-01', INTERVAL 1 MONTH)) AS DATE) AS month),
bm AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders
       WHERE month(o_orderdate) % 2 = 0),
newest AS (SELECT month, 'bundle-' || strftime(month, '%Y%m') || '-2' AS bundle_id FROM bm),
docs AS (SELECT o_orderkey AS doc_id, o_orderdate + to_seconds(CAST(o_orderkey % 86400 AS BIGINT)) AS posted_at FROM orders)
SELECT m.month, 'bundle' AS source, n.bundle_id AS id, CAST(NULL AS TIMESTAMP) AS posted_at
FROM months m JOIN newest n ON m.month = n.month
UNION ALL
SELECT CAST(date_trunc('month', {_local('d.posted_at')}) AS DATE), 'listing', CAST(d.doc_id AS VARCHAR), d.posted_at
FROM docs d
WHERE d.posted_at > TIMESTAMP '1996-01-01' AND d.posted_at <= TIMESTAMP '1997-06-30'
  AND CAST(date_trunc('month', {_local('d.posted_at')}) AS DATE) IN (SELECT month FROM months)
  AND CAST(date_trunc('month', {_local('d.posted_at')}) AS DATE) NOT IN (SELECT month FROM newest)
"""

ORACLES["workbook_rows"] = """
SELECT 'year.xlsx' AS file, strftime(l_shipdate, '%Y-%m') AS sheet, l_orderkey * 8 + l_linenumber + 10 AS row_no,
       strftime(l_shipdate, '%m/%d/%Y') AS c0, CAST(l_orderkey AS VARCHAR) AS c1, CAST(l_linenumber AS VARCHAR) AS c2,
       l_returnflag AS c3, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS c4, l_linestatus AS c5
FROM lineitem
"""


# --- report sections and problems ------------------------------------------------------------

ORACLES["section_lists"] = """
SELECT event_id,
       CASE WHEN event_id % 7 <> 0 AND event_id % 11 = 0 THEN '?' ELSE 'sec' || CAST(user_id AS VARCHAR) END AS title,
       CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 THEN NULL ELSE CAST(1 AS INTEGER) END AS n_problems,
       CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 THEN NULL ELSE CAST(2 AS INTEGER) END AS n_kpis,
       CASE WHEN event_id % 7 = 0 THEN '''problems'' is not a list of strings'
            WHEN event_id % 11 = 0 THEN 'not JSON' END AS error
FROM events WHERE event_type = 'signup'
"""

_cov_sql = ORACLES["coverage_actionable"]
_cut = _cov_sql.rindex("\nSELECT product, delivery_date")
_COV_ACT_CTE = _cov_sql[:_cut].strip()[len("WITH "):]

ORACLES["report_problems"] = f"""
WITH {_COV_ACT_CTE},
hist AS (SELECT 'ingest-' || CAST(user_id % 40 AS VARCHAR) AS alarm, ts AS at_,
                CASE WHEN event_id % 2 = 0 THEN 'ALARM' ELSE 'OK' END AS state
         FROM events WHERE event_type = 'error' AND ts <= {_NOW}),
alarming AS (SELECT alarm FROM hist QUALIFY row_number() OVER (PARTITION BY alarm ORDER BY at_ DESC) = 1 AND state = 'ALARM'),
sec AS (SELECT event_id, user_id, props FROM events WHERE event_type = 'signup')
SELECT 1 AS rank, alarm || ': alarm active' AS text FROM alarming
UNION ALL
SELECT 2, product || ' ' || CAST(delivery_date AS VARCHAR) || ': ' || CAST(len(actionable) AS VARCHAR) || ' '
          || CASE WHEN cadence = 'hourly' THEN 'postings' ELSE 'intervals' END || ' missing ('
          || {_missing_text('actionable', 4)} || ')'
FROM a WHERE len(actionable) > 0
UNION ALL
SELECT 3, CASE WHEN event_id % 7 = 0 THEN 'section sec' || CAST(user_id AS VARCHAR)
                                          || ' cannot be read: ''problems'' is not a list of strings'
               WHEN event_id % 11 = 0 THEN 'section ? cannot be read: not JSON'
               ELSE 'sec' || CAST(user_id AS VARCHAR) || ': k=' || json_extract_string(props, '$.k') END
FROM sec
"""

ORACLES["stream_replay"] = _INGEST_ROWS

ORACLES["symmetric_diff"] = """
WITH a AS (SELECT l_orderkey AS file,
                  CASE WHEN l_quantity > 48 THEN 8 - l_linenumber ELSE l_linenumber END AS position,
                  CASE WHEN l_discount >= 0.09 THEN 'extra_' ELSE 'c' END || CAST(l_linenumber AS VARCHAR) AS col,
                  CASE WHEN l_tax > 0.07 THEN 'string' ELSE 'double' END AS typ
           FROM lineitem),
f AS (SELECT file, list(col || ' ' || typ ORDER BY position, col, typ) AS pa FROM a GROUP BY file),
e AS (SELECT ['c1 double', 'c2 double', 'c3 double', 'c4 double', 'c5 double', 'c6 double', 'c7 double'] AS pe),
d AS (SELECT file,
             array_to_string(list_sort(list_distinct(list_filter(pa, lambda x: NOT list_contains(pe, x)))), ',') AS unexpected,
             array_to_string(list_sort(list_distinct(list_filter(pe, lambda x: NOT list_contains(pa, x)))), ',') AS missing,
             pa, pe
      FROM f, e)
SELECT file, unexpected, missing, (unexpected = '' AND missing = '' AND pa <> pe) AS column_order
FROM d WHERE unexpected <> '' OR missing <> '' OR (unexpected = '' AND missing = '' AND pa <> pe)
"""

ORACLES["stream_defer"] = _INGEST_ROWS

# STR02: the failed postings are redelivered corrected (last line per repeated key kept)
ORACLES["stream_resume"] = f"""
WITH {_ingest(extra=chr(10) + "fixed AS (SELECT * FROM po QUALIFY row_number() OVER (PARTITION BY event_type, doc_id, l5, user_id ORDER BY event_id DESC) = 1),", src="fixed")}
SELECT product, interval_start, settlement_point, settlement_point_type, price_mwh, posted_at, date, batch FROM acc
"""

# STR05: every posting reposted 30 minutes later under a new doc id with revised values;
# the point-in-time read after the last drop
ORACLES["stream_repost"] = f"""
WITH {_ingest(extra=chr(10) + "rp AS (SELECT * FROM po UNION ALL SELECT * REPLACE (posted_local + INTERVAL 30 MINUTE AS posted_local, doc_id + 5 AS doc_id, value + 1.0 AS value) FROM po),", src="rp")}
SELECT product, interval_start, settlement_point, settlement_point_type, price_mwh, posted_at FROM acc
QUALIFY row_number() OVER (PARTITION BY product, interval_start, settlement_point, settlement_point_type ORDER BY posted_at DESC) = 1
"""

_LAKE_MONTH = """
WHERE interval_start >= TIMESTAMP '2024-01-01 06:00:00' AND interval_start < TIMESTAMP '2024-02-01 06:00:00'
  AND posted_at <= TIMESTAMP '2024-01-20 00:00:00'
"""

ORACLES["lake_by_range"] = f"""
WITH {_CURATED}
SELECT product, interval_start, series, posted_at, value FROM cu {_LAKE_MONTH}
QUALIFY row_number() OVER (PARTITION BY product, interval_start, series ORDER BY posted_at DESC, ingested_at DESC) = 1
"""

ORACLES["lake_postings"] = f"""
WITH {_CURATED}
SELECT product, interval_start, series, posted_at, ingested_at, value FROM cu {_LAKE_MONTH}
"""


# --- calendar bitmaps and the pre-shuffled layout --------------------------------------------

ORACLES["coverage_bitmaps"] = f"""
WITH {_COV15}
SELECT 'events' AS product, delivery_date, expected, present, CAST(len(coalesce(missing, [])) AS INTEGER) AS n_missing,
       {_missing_text('missing', 8)} AS missing_text FROM c
"""

ORACLES["layout_by_range"] = ORACLES["lake_by_range"]
ORACLES["layout_pit_join"] = _PIT_JOIN
