"""Verification of a whole lake, product by product and family by family (JOB09, SET03, AGG02-AGG05, SET04).

* Files. Every file's footer is read once, by tasks of its own: its columns against the family's contract
  (:func:`asofspark.operators.checks.schema_diff`), NULLs in required columns and schema versions from its
  statistics. Rows are read only from files whose statistics are absent, and, to name the versions, from files that
  the statistics show to hold an unsupported one. A file off the contract is reported and left out of the rest.
* Keys. Each table family is read with its own schema and its products are checked against its own business key.
* Calendar. Missing delivery days between the first and last present one since a product is collected: one finding with
  their number and the first five.
* Zones. A product with a total: the sum and number of its zones, where there is a total.

On a lake with a snapshot log the live directories of one version are checked. The findings are data:
``(product, check, detail)``; a batch is named by its day and name, whatever its files are called.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from asofspark.functions import time as T
from asofspark.operators import checks as CK
from asofspark.plans.compact import REQUIRED
from asofspark.plans.declare import BUSINESS_KEY, SUPPORTED_VERSIONS
from asofspark.plans.products import Product
from asofspark.plans.read import CURATED_SCHEMA
from asofspark.session import scratch_path
from asofspark.sources import fileindex as FI
from asofspark.sources import lake as LK
from asofspark.sources import snapshots as SN

FINDING_SCHEMA = "product string, check string, detail string"
SHOWN = 5
TOLERANCE = 1.0

_FOOTER = ("product string, date date, batch string, path string, n_rows bigint, columns array<struct<column: string, type: string>>, "
           "nulls map<string, bigint>, lo_version int, hi_version int")


def contract_of(table: str) -> list[tuple[str, str]]:
    """Column names and types of a table family's files, in order."""
    return [(f.name, f.dataType.simpleString()) for f in ST.StructType.fromDDL(CURATED_SCHEMA[table])]


def footers(files: DataFrame, tasks: int) -> DataFrame:
    """``files(product, date, batch, path)`` with what their footers say."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_schema

        for pdf in batches:
            rows = []
            for at in pdf.itertuples(index=False):
                store, where = LK.store_of(at.path)
                with store.open_input_file(where) as f:
                    file = pq.ParquetFile(f)
                    meta, schema = file.metadata, file.schema_arrow
                    nulls = {c: FI._zone(meta, c)[2] for c in REQUIRED if c in schema.names}
                    lo, hi, _ = FI._zone(meta, "schema_version") if "schema_version" in schema.names else (None, None, None)
                rows.append({"product": at.product, "date": at.date, "batch": at.batch, "path": at.path, "n_rows": meta.num_rows,
                             "columns": [{"column": x.name, "type": x.dataType.simpleString()} for x in from_arrow_schema(schema, True)],
                             "nulls": {c: n for c, n in nulls.items() if n is not None}, "lo_version": lo, "hi_version": hi})
            if rows:
                yield pd.DataFrame(rows).astype({"lo_version": "Int32", "hi_version": "Int32"})

    return files.repartition(tasks, "path").select("product", "date", "batch", "path").mapInPandas(read, _FOOTER)


def _batch() -> Column:
    return F.concat(F.lit("date="), F.col("date").cast("string"), F.lit(" batch="), F.col("batch"))


def _finding(check: str, detail: Column) -> list[Column]:
    return [F.col("product"), F.lit(check).alias("check"), detail.alias("detail")]


def _off_contract(foot: DataFrame, table: str) -> DataFrame:
    """``(path, detail)`` of a family's files whose columns are not those declared."""
    actual = foot.select(F.col("path").alias("file"), F.posexplode("columns").alias("position", "c")).select("file", "position", "c.*")
    diff = CK.schema_diff(actual, contract_of(table), by="file")
    parts = F.concat_ws(", ", F.when(F.col("unexpected") != "", F.concat(F.lit("unexpected "), "unexpected")),
                        F.when(F.col("missing") != "", F.concat(F.lit("missing "), "missing")),
                        F.when(F.col("column_order"), F.lit("column order")))
    return diff.select(F.col("file").alias("path"), F.concat(F.lit("differs from the contract: "), parts).alias("detail"))


def _paths(df: DataFrame) -> list[str]:
    return sorted(r.path for r in df.select("path").collect())


def _of_files(spark: SparkSession, base: str, paths: list[str], table: str) -> DataFrame:
    schema = f"{CURATED_SCHEMA[table]}, product string, date date, batch string"
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*paths)


def _nulls(foot: DataFrame, rows: DataFrame) -> DataFrame:
    """NULLs of required columns: from statistics, and counted where a file has none."""
    known = foot.select("product", "date", "batch", F.explode("nulls").alias("column", "n_null"))
    required = [c for c in REQUIRED if c in rows.columns]
    counted = rows.groupBy("product", "date", "batch").agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    counted = counted.unpivot(["product", "date", "batch"], required, "column", "n_null")
    both = known.unionByName(counted).groupBy("product", "date", "batch", "column").agg(F.sum("n_null").alias("n_null"))
    return both.filter("n_null > 0").select(*_finding("nulls", F.concat(
        _batch(), F.lit(": "), F.col("column"), F.lit(" has "), F.col("n_null").cast("string"), F.lit(" NULL"))))


def _versions(rows: DataFrame) -> DataFrame:
    found = rows.groupBy("product", "date", "batch").agg(F.array_sort(F.collect_set("schema_version")).alias("v"))
    odd = found.filter(F.exists("v", lambda x: ~x.isin(list(SUPPORTED_VERSIONS))))
    return odd.select(*_finding("versions", F.concat(_batch(), F.lit(": versions "), F.array_join(F.transform("v", lambda x: x.cast("string")), ","))))


def _keys(rows: DataFrame, table: str) -> DataFrame:
    """Business keys stored twice for one posting time: the most repeated of each product, and how many in all."""
    key = [*BUSINESS_KEY[table], "posted_at"]
    g = rows.groupBy("product", *key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    total = g.groupBy("product").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > SHOWN).select(
        *_finding("keys", F.concat(F.col("n").cast("string"), F.lit(" repeated keys in all"))))
    top = CK.first_per_group(g, "product", [F.col("n").desc(), *[F.col(k).asc_nulls_last() for k in key]], SHOWN)
    text = [_time(k) if dict(rows.dtypes)[k].startswith("timestamp") else F.coalesce(F.col(k).cast("string"), F.lit("NULL"))
            for k in BUSINESS_KEY[table]]
    shown = F.concat(F.concat_ws("|", *text), F.lit(" posted "), _time("posted_at"), F.lit(" x"), F.col("n").cast("string"))
    return total.unionByName(top.select(*_finding("keys", shown)))


def _time(c: str) -> Column:
    return F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss")


def _calendar(days: DataFrame, products: Sequence[Product]) -> DataFrame:
    """One finding per product with missing days, from the day directories alone."""
    since = F.lit(None).cast("date")
    for p in products:
        if p.collected_from is not None:
            since = F.when(F.col("product") == p.key, T.delivery_date(F.lit(p.collected_from).cast("timestamp_ntz"))).otherwise(since)
    kept = days.select("product", F.col("date").alias("day")).distinct().withColumn("since", since)
    kept = kept.filter(F.col("since").isNull() | (F.col("day") >= F.col("since"))).drop("since")
    gone = CK.calendar_gaps(kept, day="day", by="product").groupBy("product").agg(F.array_sort(F.collect_list("day")).alias("d"))
    shown = F.array_join(F.transform(F.slice("d", 1, SHOWN), lambda x: x.cast("string")), ", ")
    more = F.when(F.size("d") > SHOWN, F.lit(" ...")).otherwise(F.lit(""))
    return gone.select(*_finding("calendar", F.concat(F.size("d").cast("string"), F.lit(" missing delivery days: "), shown, more)))


def _zone_sums(rows: DataFrame, p: Product) -> DataFrame:
    """The first intervals of a product whose zones do not sum to their total or are not all there."""
    zones = list(p.zones)
    f = CK.sum_findings(rows.filter(F.col("product") == p.key), by=["product", "interval_start", "posted_at"],
                        part=F.col("series").isin(zones), total=F.col("series") == p.total, value="value",
                        expected_parts=len(zones), tolerance=TOLERANCE)
    first = CK.first_per_group(f, "product", [F.col("interval_start"), F.col("posted_at")], SHOWN)
    return first.select(*_finding("zones", F.concat(
        _time("interval_start"), F.lit(" posted "), _time("posted_at"), F.lit(": "), F.col("n_parts").cast("string"), F.lit(" zones sum "),
        F.format_number(F.coalesce("parts_sum", F.lit(0.0)), 1), F.lit(", total "), F.format_number("total", 1))))


def verify_lake(spark: SparkSession, root: str, products: Sequence[Product], *, tasks: int | None = None) -> DataFrame:
    """All findings of the ``products`` of a lake."""
    base = f"{root}/curated"
    tasks = tasks or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    files = LK.list_files(spark, base).select("path", *LK.path_parts("path")).filter(F.col("kind") != "")
    files = files.filter(F.col("product").isin([p.key for p in products]))
    live = SN.live(spark, root)
    if live is not None:
        files = files.join(live, SN.DIRECTORY, "left_semi")
    kept = scratch_path(spark, "footers")
    footers(files, tasks).write.parquet(kept)  # read once, used by every check
    foot = spark.read.parquet(kept)
    found = [_calendar(foot, products)]
    for table in sorted({p.table for p in products}):
        family = [p for p in products if p.table == table]
        mine = foot.filter(F.col("product").isin([p.key for p in family]))
        odd = _off_contract(mine, table)
        found.append(mine.join(odd, "path").select(*_finding("files", F.concat(_batch(), F.lit(": "), F.col("detail")))).distinct())
        good = mine.join(odd.select("path"), "path", "left_anti")
        unknown = good.filter(F.size("nulls") < len(REQUIRED))
        found.append(_nulls(good.filter(F.size("nulls") == len(REQUIRED)), _of_files(spark, base, _paths(unknown), table)))
        in_bounds = F.col("lo_version").isin(list(SUPPORTED_VERSIONS)) & F.col("hi_version").isin(list(SUPPORTED_VERSIONS))
        sure = in_bounds & ((F.col("lo_version") == F.col("hi_version")) | F.lit(_gapless(SUPPORTED_VERSIONS)))
        unsure = good.filter(~F.coalesce(sure, F.lit(False)) & (F.col("n_rows") > 0))
        found.append(_versions(_of_files(spark, base, _paths(unsure), table)))
        # whole family: by directories, of which there are fewer than files
        rows = _of_files(spark, base, _paths(good), table)
        found.append(_keys(rows, table))
        found += [_zone_sums(rows, p) for p in family if p.zones]
    return reduce(DataFrame.unionByName, found)


def _gapless(versions: Sequence[int]) -> bool:
    return set(versions) == set(range(min(versions), max(versions) + 1))
