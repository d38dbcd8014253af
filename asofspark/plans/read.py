"""Point-in-time reads of a curated lake (JOB01, JOB02, JOB03 with FLT01-FLT04, FLT09, FLT11,
SRC09, WIN01, SRT01, SRT02).

``Lake(spark, root, tables)`` answers what was known at ``as_of`` about one product: only the
requested Central-time delivery days are listed and opened (explicit partition paths), the
knowledge cut and the name filter reach the Parquet scan, and the latest posting per business
key is a ``row_number() = 1`` that Spark plans with a partial top-1 before its one shuffle.
The driver only turns arguments into day paths; results are lazy DataFrames.
"""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asofspark.functions.time import CT
from asofspark.operators import pit
from asofspark.plans.declare import BUSINESS_KEY, NAME_COLUMN, SUPPORTED_VERSIONS
from asofspark.sources import fileindex as FI
from asofspark.sources import lake as LK
from asofspark.sources import snapshots as SN


_COMMON = ("interval_start timestamp_ntz, interval_minutes int, posted_at timestamp_ntz, "
           "ingested_at timestamp_ntz, source string, schema_version int")
CURATED_SCHEMA = {
    "spp": f"{_COMMON}, settlement_point string, settlement_point_type string, price_mwh double, dst_flag boolean",
    "mcpc": f"{_COMMON}, as_type string, mcpc_mw double, dst_flag boolean",
    "series": f"{_COMMON}, series string, value double, dst_flag boolean",
}


def read_curated(spark: SparkSession, root: str, table: str | None = None) -> DataFrame:
    """Every row under ``root/curated``, in the declared columns of ``table`` or, without one, in those of the files.
    A lake that no posting was taken into yet (every product stopped at its first one) has no
    file to read a schema from: it has the declared columns and no rows."""
    base = f"{root.rstrip('/')}/curated"
    place = "product string, date date, batch string"
    fs, p = LK._fs(spark, base)
    if not fs.exists(p) or not any(s.getPath().getName().startswith("product=") for s in fs.listStatus(p)):
        return spark.createDataFrame([], f"{CURATED_SCHEMA[table] if table else _COMMON}, {place}")
    if table is None:
        return spark.read.option("mergeSchema", "true").parquet(base)
    return spark.read.schema(f"{CURATED_SCHEMA[table]}, {place}").parquet(base)


def _utc(moment: dt.datetime, what: str) -> dt.datetime:
    """A timezone-aware moment as a naive UTC wall clock (the lake's NTZ convention)."""
    if not isinstance(moment, dt.datetime) or moment.tzinfo is None:
        raise ValueError(f"{what} must be a timezone-aware datetime")
    return moment.astimezone(dt.UTC).replace(tzinfo=None)


def _ct_day(utc_naive: dt.datetime) -> dt.date:
    return utc_naive.replace(tzinfo=dt.UTC).astimezone(ZoneInfo(CT)).date()


class Lake:
    """Reads of ``root/curated``; ``tables`` maps product -> table family (spp, mcpc, series).
    ``max_days`` refuses longer reads; there is no limit unless it is given. On a lake with a
    snapshot log every read resolves one version: the newest at that moment, or ``version``."""

    def __init__(self, spark: SparkSession, root: str, tables: dict[str, str], max_days: int | None = None,
                 version: int | None = None):
        self.spark, self.root, self.tables = spark, root.rstrip("/"), dict(tables)
        self.max_days, self.version = max_days, version

    def pinned(self) -> Lake:
        """The same lake as of the newest version now, whatever is committed later."""
        return Lake(self.spark, self.root, self.tables, self.max_days, SN.newest(self.spark, self.root))

    def _table(self, product: str) -> str:
        if product not in self.tables:
            raise KeyError(f"unknown product {product!r}")
        return self.tables[product]

    def _scan(self, product: str, d_from: dt.date, d_to: dt.date, **cut) -> DataFrame:
        if d_to < d_from:
            raise ValueError(f"day range ends before it starts: {d_from} .. {d_to}")
        if self.max_days and (d_to - d_from).days + 1 > self.max_days:
            raise ValueError(f"at most {self.max_days} days per read")
        table = self._table(product)
        if cut and FI.indexed(self.spark, self.root):  # only files that may hold a wanted row
            df = FI.scan(self.spark, self.root, product, d_from, d_to, version=self.version, **cut)
        else:
            df = LK.scan_days(self.spark, self.root, product, d_from, d_to, self.version)
        if df is None:  # FLT11: nothing stored, the declared types still hold
            return self.spark.createDataFrame([], CURATED_SCHEMA[table])
        return df.select(*[f.split(" ")[0] for f in CURATED_SCHEMA[table].split(", ")])

    def _read(self, df: DataFrame, product: str, as_of: dt.datetime, names, *, latest: bool) -> DataFrame:
        table = self._table(product)
        key = list(BUSINESS_KEY[table])
        df = pit.named(df, NAME_COLUMN[table], names)  # on the key: safe before the dedupe
        cut = pit.known_by(df, _utc(as_of, "as_of"))
        pit.require_versions(cut, SUPPORTED_VERSIONS)
        if not latest:
            return pit.postings(cut, key=key, as_of=_utc(as_of, "as_of"))
        return pit.order_by_key(pit.latest(cut, key=key, tie="ingested_at"), key)

    def files(self, product: str, start: dt.datetime, end: dt.datetime, *, as_of: dt.datetime, names=None) -> tuple[int, int]:
        """(files that such a read opens, files and unindexed directories of its days that are live)."""
        self._table(product)
        lo, hi = _utc(start, "start"), _utc(end, "end")
        found = FI.chosen(self.spark, self.root, product, _ct_day(lo), _ct_day(hi - dt.timedelta(microseconds=1)), start=lo,
                          end=hi, as_of=_utc(as_of, "as_of"), names=names, version=self.version)
        r = found.agg(F.count_if("wanted").alias("opened"), F.count(F.lit(1)).alias("live")).first()
        return r.opened, r.live

    def by_date(self, product: str, day: dt.date, *, as_of: dt.datetime, names=None) -> DataFrame:
        """JOB01: the whole delivery day (CT) as known at ``as_of``; one row per business key."""
        df = self._scan(product, day, day, as_of=_utc(as_of, "as_of"), names=names)
        return self._read(df, product, as_of, names, latest=True)

    def by_range(self, product: str, start: dt.datetime, end: dt.datetime, *, as_of: dt.datetime,
                 names=None) -> DataFrame:
        """JOB02: intervals in ``[start, end)`` as known at ``as_of``."""
        lo, hi = _utc(start, "start"), _utc(end, "end")
        if hi <= lo:
            raise ValueError(f"empty interval range {start} .. {end}")
        df = self._scan(product, _ct_day(lo), _ct_day(hi - dt.timedelta(microseconds=1)), start=lo, end=hi,
                        as_of=_utc(as_of, "as_of"), names=names)
        return self._read(pit.between_intervals(df, lo, hi), product, as_of, names, latest=True)

    def postings(self, product: str, start: dt.datetime, end: dt.datetime, *, as_of: dt.datetime,
                 names=None) -> DataFrame:
        """JOB03/SRT02: every version known at ``as_of`` with ``ingested_at`` and ``source``,
        ordered by key then ``posted_at``; no dedupe."""
        lo, hi = _utc(start, "start"), _utc(end, "end")
        if hi <= lo:
            raise ValueError(f"empty interval range {start} .. {end}")
        df = self._scan(product, _ct_day(lo), _ct_day(hi - dt.timedelta(microseconds=1)), start=lo, end=hi,
                        as_of=_utc(as_of, "as_of"), names=names)
        return self._read(pit.between_intervals(df, lo, hi), product, as_of, names, latest=False)

