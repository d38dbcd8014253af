"""Archive fixtures derived from the driver's ``events`` table, built on executors.

``events`` becomes a stream of postings: one zipped CSV per (event type, local day), named like
a market posting (``cdr.<doc>.0000000000000000.<yyyyMMdd>.<HHmmss>.<TYPE>.csv``, stamped with the
local time of the group's last event), and a monthly bundle per type holding the day zips plus
a noise file. Zips are written by executors, line by line from sorted rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as ST
from pyspark.sql.pandas.types import to_arrow_schema

from asofspark.functions import time as T
from asofspark.sources import archive as A
from asofspark.tables import read

# The event types in the order that numbers their postings.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
CSV_HEADER = ["EventId", "Timestamp", "UserId", "EventType", "Value", "LocalStamp", "RepeatedHourFlag"]


def _type_code():
    c = F.lit(9)
    for i, t in reversed(list(enumerate(EVENT_TYPES))):
        c = F.when(F.col("event_type") == t, F.lit(i)).otherwise(c)
    return c


def posting_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their posting: (event_type, day, doc_id, posted_local, stamp) per row."""
    e = read(spark, sf_dir, "events")
    local = T.utc_to_local("ts")
    e = e.withColumn("day", F.to_date(local)).withColumn("__local", local)
    posted = F.date_trunc("second", F.max("__local").over(Window.partitionBy("event_type", "day"))).cast("timestamp_ntz")
    doc = F.datediff("day", F.lit("2023-12-31").cast("date")) * 10 + _type_code()
    return e.withColumn("posted_local", posted).withColumn("doc_id", doc.cast("bigint")).drop("__local")


def documents_of(rows: DataFrame, key: Sequence[str], order: str, build: Callable[..., dict], schema: str) -> DataFrame:
    """One row of ``schema`` per ``key``, built by ``build(key values, rows)`` from the rows in ``order`` as they pass: a
    task holds a batch of rows and the document it writes, never a group. The key's columns come first in a row."""
    types = [f.type for f in to_arrow_schema(ST.StructType.fromDDL(schema))]
    n = len(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passing = (row for b in batches for row in zip(*[c.to_pylist() for c in b.columns], strict=True))
        for at, group in itertools.groupby(passing, lambda row: row[:n]):
            made = build(at, (row[n:] for row in group))
            yield pa.record_batch([pa.array([v], t) for v, t in zip(made.values(), types, strict=True)], names=list(made))

    rest = [c for c in rows.columns if c not in key]
    dealt = rows.select(*key, *rest).repartition(*key).sortWithinPartitions(*key, order)
    return dealt.mapInArrow(run, schema)


def _zip_posting(key: tuple, rows: Iterator[tuple]) -> dict:
    """A posting's zip: lines go into the archive as they come."""
    event_type, day, doc_id = key
    first = next(rows)
    stamp = first[1]
    member = f"cdr.{doc_id:08d}.0000000000000000.{stamp:%Y%m%d}.{stamp:%H%M%S}.{str(event_type).upper()}.csv"
    lines = ((no, ts, user, event_type, repr(float("nan") if value is None else value), local, "N")
             for no, _, ts, user, value, local in itertools.chain([first], rows))
    return {"event_type": event_type, "day": day, "doc_id": doc_id, "posted_local": stamp, "member": member,
            "name": f"{event_type}/date={day}/posted={stamp:%Y%m%dT%H%M%S}-{doc_id}.zip",
            "content": A.zip_csv(member, CSV_HEADER, lines)}


POSTING_SCHEMA = ("event_type string, day date, doc_id bigint, posted_local timestamp_ntz, member string, "
                  "name string, content binary")


ZIP_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "day", "doc_id", "posted_local", "local_ts"]


def zip_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that go into posting zips (one posting per event type, local day and doc id)."""
    return posting_rows(spark, sf_dir).withColumn("local_ts", T.utc_to_local("ts")).select(*ZIP_COLUMNS)


def zips_of(rows: DataFrame) -> DataFrame:
    """One zipped CSV posting per (event type, day, doc id) of ``rows``, its lines by event id."""
    cells = rows.select("event_type", "day", "doc_id", "event_id", "posted_local",
                        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "user_id", "value",
                        F.date_format("local_ts", "MM/dd/yyyy HH:mm:ss").alias("local_ts"))
    return documents_of(cells, ["event_type", "day", "doc_id"], "event_id", _zip_posting, POSTING_SCHEMA)


def posting_zips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One zipped CSV posting per (event type, local day)."""
    return zips_of(zip_rows(spark, sf_dir))


def reposts(rows: DataFrame, minutes: int = 30, doc_offset: int = 5, delta: float = 1.0) -> DataFrame:
    """A newer posting for every posting: the same intervals, published ``minutes`` later under
    a new doc id (``doc_offset`` keeps ids unique: the type code is the last digit), every
    value revised by ``delta``."""
    return (rows.withColumn("posted_local", F.col("posted_local") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes)))
            .withColumn("doc_id", F.col("doc_id") + doc_offset)
            .withColumn("value", F.col("value") + delta))


def corrected(rows: DataFrame) -> DataFrame:
    """Corrected copies of the postings that repeat a business key (5-minute slot, user): the
    publisher keeps the last line (highest event id) per key. Only those postings are returned."""
    slot = F.date_trunc("minute", "local_ts") - F.make_dt_interval(F.lit(0), F.lit(0), F.minute("local_ts") % 5)
    posting = ["event_type", "day", "doc_id"]
    k = rows.withColumn("__slot", slot)
    bad = (k.groupBy(*posting, "__slot", "user_id").agg(F.count(F.lit(1)).alias("n"))
           .filter(F.col("n") > 1).select(*posting).distinct())
    w = Window.partitionBy(*posting, "__slot", "user_id").orderBy(F.col("event_id").desc())
    return (k.join(bad, on=posting, how="left_semi").withColumn("__rn", F.row_number().over(w))
            .filter(F.col("__rn") == 1).drop("__rn", "__slot"))


def placeholders(zips: DataFrame) -> DataFrame:
    """Listed postings that are not yet available: a ``.listed`` marker file in place of each
    zip (file scans skip zero-byte files, so the marker carries a few bytes)."""
    return (zips.withColumn("name", F.regexp_replace("name", r"\.zip$", ".listed"))
            .withColumn("content", F.lit(b"listed").cast("binary")))


def _bundle_group(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("doc_id")
    members = [(f"{int(r.doc_id)}.{r.member[:-4]}.zip", bytes(r.content)) for r in pdf.itertuples()]
    members.append(("README.txt", b"not a posting"))
    first = pdf.iloc[0]
    month = pd.Timestamp(first["day"]).strftime("%Y%m")
    return pd.DataFrame({"name": [f"bundles/{first['event_type']}-{month}.zip"],
                         "content": [A.zip_members(members)]})


def bundle_zips(postings: DataFrame) -> DataFrame:
    """A monthly bundle per type: the month's posting zips plus one noise member."""
    p = postings.withColumn("month", F.trunc("day", "month"))
    return p.groupBy("event_type", "month").applyInPandas(_bundle_group, "name string, content binary")


def typed_events(records: DataFrame) -> DataFrame:
    """CSV cells of the event postings back to typed columns."""
    c = F.col("cells")
    return records.select(
        c[0].cast("bigint").alias("event_id"),
        F.to_timestamp_ntz(c[1], F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("ts"),
        c[2].cast("bigint").alias("user_id"), c[3].alias("event_type"), c[4].cast("double").alias("value"),
        *[x for x in records.columns if x not in ("cells", "header")],
    )


EVENTS_DECL_COLUMNS = {"run_stamp": "LocalStamp", "repeated_flag": "RepeatedHourFlag", "point": "UserId",
                       "point_type": "EventType", "price": "Value", "event_id": "EventId", "ts": "Timestamp"}


def event_product(folder):
    """The product whose postings land in ``folder``."""
    return F.concat(F.lit("ev-"), folder)


def event_declarations(types=EVENT_TYPES) -> dict:
    """One declared 5-minute price product per event type: user = point, type = point type."""
    from asofspark.plans.declare import Declaration

    return {f"ev-{t}": Declaration(product=f"ev-{t}", table="spp", interval_minutes=5,
                                   time_style="sced_timestamp", columns=dict(EVENTS_DECL_COLUMNS))
            for t in types}


def raw_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event postings as landed raw rows (product, posted_at, doc_id, name, content)."""
    z = posting_zips(spark, sf_dir)
    return z.select(F.concat(F.lit("ev-"), F.col("event_type")).alias("product"),
                    T.local_to_utc("posted_local").alias("posted_at"), "doc_id",
                    F.col("member").alias("name"), "content")
