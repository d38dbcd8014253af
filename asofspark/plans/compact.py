"""Compaction that never changes an answer and never loses a column (JOB08, JN05, WIN03, AGG12, SRT03).

Per (product, delivery date) partition with at least two eligible batches (name
``(part|merged)-<stamp>``, files at least ``min_age`` old), all rows are rewritten as one
``merged-<now>`` batch sorted by key, posted and ingested time, then the source batches are
deleted. Duplicates are kept (the dedupe happens at read time). A merged batch left by an
interrupted run is recognised: source batches whose rows it already holds in full (multiset
containment, NULL-safe) are leftovers and are deleted, not merged twice. Order-free digests of the batches
tell this for a whole partition; only where they disagree are rows compared.

Every batch's own file schema is read from its footers on executors. A partition is off the
contract, and is skipped and reported with its sources untouched, when a batch differs from the
product's declared schema (without a declaration: when its batches differ from one another) or
has a NULL in a required column. What is rewritten is read with the schema that its files have.

The listing is a distributed ``binaryFile`` metadata scan kept as a table; all products whose files
have the same columns are one job with one range shuffle on (product, date, key), which reads the
partitions to be merged by their paths; rows are compared with a merged batch only in
partitions that have one; sources are deleted by executors after the write succeeded, or, on a lake
with a snapshot log, replaced in one commit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from asofspark.functions import time as T
from asofspark.operators import digest as DG
from asofspark.session import scratch_path
from asofspark.sources import fileindex as FI
from asofspark.sources import lake as L
from asofspark.sources import snapshots as SN

REQUIRED = ("interval_start", "interval_minutes", "posted_at", "ingested_at", "source", "schema_version")


def held_batches(df: DataFrame, *, batch: str, merged: str, by=()) -> DataFrame:
    """JN05: per source batch, whether every row of it (with multiplicity) is held by the
    ``merged`` batch of the same ``by`` group. ``df`` has ``batch`` and a ``merged`` column
    naming the group's newest merged batch (NULL when there is none). Groups whose digests agree
    are told without their rows (:mod:`asofspark.operators.digest`)."""
    return DG.held_by_digest(df, batch=batch, merged=merged, by=by,
                             exact=lambda rows: held_rows(rows, batch=batch, merged=merged, by=by))


def held_rows(df: DataFrame, *, batch: str, merged: str, by=()) -> DataFrame:
    """:func:`held_batches` row by row."""
    by = list(by)
    data = [c for c in df.columns if c not in (batch, merged, *by)]
    counts = df.groupBy(*by, batch, merged, *data).agg(F.count(F.lit(1)).alias("__n"))
    have = counts.filter(F.col(batch) == F.col(merged)).select(
        *by, *[F.col(c).alias(f"__m_{c}") for c in data], F.col("__n").alias("__held"))
    src = counts.filter(F.col(merged).isNull() | (F.col(batch) != F.col(merged)))
    cond = [src[b] == have[b] for b in by] + [src[c].eqNullSafe(have[f"__m_{c}"]) for c in data]
    j = src.join(have, on=cond, how="left")
    return j.groupBy(*[src[b] for b in by], src[batch]).agg(
        F.sum("__n").alias("n_rows"),
        F.bool_and(F.coalesce(F.col("__held"), F.lit(0)) >= F.col("__n")).alias("held"))


def plan(spark: SparkSession, root: str, *, now, min_age_minutes: int = 60, products=None,
         limit_partitions: int | None = None, with_path: bool = False, live: DataFrame | None = None) -> DataFrame:
    """Eligible batches per partition: (product, date, batch, kind, newest_merged), with
    ``with_path`` one row per file and its ``path``. ``live`` limits them to a snapshot's directories."""
    files = L.list_files(spark, f"{root}/curated").select("*", *L.path_parts("path"))
    files = files.filter(F.col("kind") != "")
    if live is not None:
        files = files.join(live, on=["product", "date", "batch"], how="left_semi")
    if products:
        files = files.filter(F.col("product").isin(list(products)))
    now_c = F.lit(now).cast("timestamp_ntz")
    now_us = T.micros_between(F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), now_c)
    old = now_us - F.unix_micros(F.col("modified")) >= min_age_minutes * 60_000_000
    batches = files.groupBy("product", "date", "batch", "kind").agg(F.bool_and(old).alias("aged"))
    batches = batches.filter("aged")
    parts = batches.groupBy("product", "date").agg(
        F.count(F.lit(1)).alias("n_batches"),
        F.max(F.when(F.col("kind") == "merged", F.col("batch"))).alias("newest_merged"))
    parts = parts.filter(F.col("n_batches") >= 2)
    if limit_partitions:
        parts = parts.orderBy("date", "product").limit(limit_partitions)  # oldest first
    batches = batches.join(parts, on=["product", "date"], how="inner")
    if with_path:
        return batches.join(files.select("product", "date", "batch", "path"), on=["product", "date", "batch"])
    return batches


def schema_text(schema: ST.StructType) -> str:
    """A schema as DDL with its columns in name order, so that equal contracts are equal texts."""
    return ddl(sorted(schema, key=lambda f: f.name))


def ddl(fields) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def file_schemas(files: DataFrame) -> DataFrame:
    """``files(path, ...)`` with each file's own ``columns`` (:func:`schema_text`) and, in
    file order, its ``ddl``, both from its footer."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_schema

        for pdf in batches:
            found = []
            for path in pdf["path"]:
                store, name = L.store_of(path)
                found.append(from_arrow_schema(pq.read_schema(name, filesystem=store), True))
            yield pdf.assign(columns=[schema_text(x) for x in found], ddl=[ddl(x) for x in found])

    text = ST.StringType()
    return files.mapInPandas(read, ST.StructType([*files.schema, ST.StructField("columns", text), ST.StructField("ddl", text)]))


def off_contract(schemas: DataFrame, contract: Mapping[str, ST.StructType | str] | None) -> DataFrame:
    """(product, date, reason) of the partitions whose files differ from the declared columns, or,
    for products without a declaration, from one another."""
    declared = F.lit(None).cast("string")
    for product, schema in (contract or {}).items():
        schema = schemas.sparkSession.createDataFrame([], schema).schema if isinstance(schema, str) else schema
        declared = F.when(F.col("product") == product, F.lit(schema_text(schema))).otherwise(declared)
    per = schemas.withColumn("declared", declared).groupBy("product", "date", "declared").agg(
        F.min("columns").alias("least"), F.max("columns").alias("most"))
    other = (F.col("least") != F.col("declared")) | (F.col("most") != F.col("declared"))
    reason = (F.when(other, F.lit("columns differ from the declared ones"))
              .when(F.col("least") != F.col("most"), F.lit("batches differ in their columns")))
    return per.select("product", "date", reason.alias("reason")).filter("reason is not null")


_SUMMARY = "product string, partitions bigint, batches_in bigint, rows bigint, leftovers bigint, skipped bigint"


def _kept_table(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def compact(spark: SparkSession, root: str, *, now, key, min_age_minutes: int = 60, products=None,
            limit_partitions: int | None = None, contract: Mapping[str, ST.StructType | str] | None = None,
            before_commit: Callable[[], None] | None = None) -> DataFrame:
    """JOB08: merge eligible partitions; returns the AGG12 summary per product. ``contract``
    declares products' file columns (without product, date and batch). ``key`` orders the rows;
    columns that a table family does not have are passed over.

    On a lake with a snapshot log the merged batches replace their sources in one commit, and the
    sources stay for readers of earlier versions until a vacuum; ``before_commit`` is called when
    all is written and nothing is visible. Without a log the sources are deleted."""
    base = f"{root}/curated"
    key = [key] if isinstance(key, str) else list(key)
    batch_id = ["product", "date", "batch"]
    logged = SN.live(spark, root)
    # the listing is fixed now: re-listing after the write would see the new batch
    files = plan(spark, root, now=now, min_age_minutes=min_age_minutes, products=products,
                 limit_partitions=limit_partitions, with_path=True, live=logged)
    schemas = _kept_table(spark, file_schemas(files.select(*batch_id, "newest_merged", "path")), "compact-files")
    odd = off_contract(schemas, contract)
    batches = schemas.groupBy(*batch_id, "newest_merged").agg(F.min("columns").alias("columns"), F.min("ddl").alias("ddl"))
    usable = batches.join(odd, on=["product", "date"], how="left_anti")
    stamp = T.stamp(F.lit(now).cast("timestamp_ntz"))
    new_batch = "merged-" + spark.range(1).select(stamp.alias("s")).first()["s"]

    decisions, rows = [], spark.createDataFrame([], "product string, rows bigint")
    for r in usable.groupBy("columns").agg(F.min("ddl").alias("ddl")).collect():  # one job per table family
        mine = usable.filter(F.col("columns") == r["columns"]).drop("columns", "ddl")
        schema = f"{r.ddl}, product string, date date, batch string"
        read = spark.read.schema(schema).option("basePath", base)
        # only the partitions to be merged are listed and opened
        days = [f"{base}/product={d.product}/date={d.date}" for d in mine.select("product", "date").distinct().collect()]
        data = read.parquet(*days).join(mine, on=batch_id, how="inner")  # SET01: duplicates kept
        required = [c for c in REQUIRED if c in data.columns]
        null = F.greatest(*[F.col(c).isNull() for c in required], F.lit(False))
        bad = data.filter(null).select("product", "date").distinct()
        data = data.join(bad, on=["product", "date"], how="left_anti")
        # only partitions that have a merged batch can hold leftovers
        held = held_batches(data.filter(F.col("newest_merged").isNotNull()), batch="batch", merged="newest_merged",
                            by=["product", "date"])
        left = held.filter("held").select(*batch_id, F.lit("leftover").alias("fate"))
        fate = (mine.select(*batch_id).join(left, on=batch_id, how="left")
                .join(bad.withColumn("null", F.lit(True)), on=["product", "date"], how="left")
                .select(*batch_id, F.coalesce("fate", F.when(F.col("null"), F.lit("skipped")), F.lit("merged")).alias("fate")))
        fate = _kept_table(spark, fate, "compact-fate")
        # a small partition stays in one task and one file; a hot one (a day holding a third of all
        # rows) is split by key over several tasks, each file sorted so that row-group
        # statistics still skip on key and time
        keep = data.join(fate.filter("fate = 'merged'").select(*batch_id), on=batch_id, how="left_semi")
        order = [c for c in key if c in data.columns]
        out = (keep.drop("batch", "newest_merged").withColumn("batch", F.lit(new_batch))
               .repartitionByRange("product", "date", *order)
               .sortWithinPartitions("product", "date", *order, "posted_at", "ingested_at"))
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
         .partitionBy(*batch_id).parquet(base))
        decisions.append(fate)
        merged = fate.filter("fate = 'merged'").select("product", "date").distinct().collect()
        new = [f"{base}/product={d.product}/date={d.date}/batch={new_batch}" for d in merged]
        if new:
            rows = rows.unionByName(read.parquet(*new).groupBy("product").agg(F.count(F.lit(1)).alias("rows")))

    fates = batches.join(odd, on=["product", "date"], how="left_semi").select(*batch_id, F.lit("skipped").alias("fate"))
    for d in decisions:
        fates = fates.unionByName(d)
    per = fates.groupBy("product").agg(
        F.count_distinct(F.when(F.col("fate") == "merged", F.col("date"))).alias("partitions"),
        F.count_if(F.col("fate") == "merged").alias("batches_in"),
        F.count_if(F.col("fate") == "leftover").alias("leftovers"),
        F.count_distinct(F.when(F.col("fate") == "skipped", F.col("date"))).alias("skipped"))
    summary = per.join(rows, "product", "left").select(
        "product", "partitions", "batches_in", F.coalesce("rows", F.lit(0)).alias("rows"), "leftovers", "skipped")
    summary = spark.createDataFrame(summary.collect(), _SUMMARY)  # one row per product
    if before_commit is not None:
        before_commit()
    gone = fates.filter((F.col("fate") != "skipped") & (F.col("batch") != new_batch)).select(*batch_id)
    if logged is None:
        L.delete_dirs(gone.select(F.concat(
            F.lit(f"{base}/product="), "product", F.lit("/date="), F.col("date").cast("string"), F.lit("/batch="), "batch").alias("dir")), base)
    elif not gone.isEmpty():
        added = fates.filter("fate = 'merged'").select("product", "date").distinct().withColumn("batch", F.lit(new_batch))
        SN.commit(spark, root, added, gone)
        if FI.indexed(spark, root):
            FI.update(spark, root)
    return summary
