"""A listing of documents as a Spark data source, batch and stream (SRC06, STR01, STR03).

A poll of a listing is a folder ``poll=<n>`` of pages ``page-<k>.json``, newest documents first, each
``{"_meta": {"totalPages"}, "archives": [{"docId", "postDatetime", "friendlyName"}]}``. Polls are never
changed; one is complete when all its pages are there, and an incomplete one is passed over.

The stream's offset is ``{"poll", "doc", "posted"}``: the poll it was read from and its newest document. A
micro-batch holds the documents after the last offset up to the next, its pages dealt in runs to at most ``TASKS``
partitions (a page each where there are fewer), from the pages of one poll, so a replay reads the same rows whatever has been listed since. Progress is
by document id, which ascends with publication; posting times are wall clocks without offset and run
backwards in the repeated hour. Only the pages that hold newer documents are opened: the driver finds the
last of them by bisection. So a stream resumes from its checkpoint alone: nothing has to remember which
documents were never offered.

Rows are ``doc_id, post_local_text, friendly_name, page``, as :func:`asofspark.sources.documents.listing_docs`
takes them. A stamp is passed on as it is; one that cannot be read is reported there.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from asofspark.sources import archive as AR
from asofspark.sources import lake as LK

NAME = "asof_listing"
SCHEMA = "doc_id bigint, post_local_text string, friendly_name string, page int"
#: The most partitions of a micro-batch: the number of tasks does not grow with the listing, only their runs of pages do.
TASKS = 256
START = {"poll": -1, "doc": -1, "posted": None}


class Polls:
    """The polls under a folder."""

    def __init__(self, root: str):
        self.store, self.root = LK.store_of(root)

    def page(self, poll: int, k: int) -> dict:
        with self.store.open_input_stream(f"{self.root}/poll={poll}/page-{k:06d}.json") as f:
            return json.loads(f.read())

    def pages(self, poll: int) -> int:
        return int(self.page(poll, 1)["_meta"]["totalPages"])

    def newest(self, after: int = -1) -> int | None:
        """The newest complete poll, not looking further back than ``after``."""
        from pyarrow import fs

        found = self.store.get_file_info(fs.FileSelector(self.root, allow_not_found=True))
        polls = sorted((int(i.base_name[5:]) for i in found if i.base_name.startswith("poll=")), reverse=True)
        for poll in (p for p in polls if p >= after):
            there = {i.base_name for i in self.store.get_file_info(fs.FileSelector(f"{self.root}/poll={poll}"))}
            if "page-000001.json" in there and all(f"page-{k:06d}.json" in there for k in range(1, self.pages(poll) + 1)):
                return poll
        return None

    def pages_after(self, poll: int, doc: int) -> int:
        """How many pages of a poll, from the first, hold documents after ``doc``."""
        low, high = 0, self.pages(poll)
        while low < high:
            mid = (low + high + 1) // 2
            archives = self.page(poll, mid)["archives"]
            low, high = (mid, high) if archives and int(archives[0]["docId"]) > doc else (low, mid - 1)
        return low

    def rows(self, poll: int, k: int, after: int, upto: int) -> Iterator[tuple]:
        for a in self.page(poll, k)["archives"]:
            doc = int(a["docId"])
            if after < doc <= upto:
                yield doc, a.get("postDatetime"), a.get("friendlyName"), k


class PagePartition(InputPartition):
    def __init__(self, poll: int, first: int, last: int, after: int, upto: int):
        super().__init__((poll, first, last, after, upto))


class _Pages:
    """What batch and stream readers share."""

    def __init__(self, options):
        self.root = options["path"]

    def _between(self, start: dict, end: dict) -> list[PagePartition]:
        if end["poll"] < 0 or end["doc"] <= start["doc"]:
            return []
        last = Polls(self.root).pages_after(end["poll"], start["doc"])
        tasks = min(last, TASKS)
        cuts = [last * n // tasks for n in range(tasks + 1)] if tasks else []
        return [PagePartition(end["poll"], a + 1, b, start["doc"], end["doc"]) for a, b in itertools.pairwise(cuts)]

    def _latest(self, known: dict) -> dict:
        polls = Polls(self.root)
        poll = polls.newest(known["poll"])
        archives = polls.page(poll, 1)["archives"] if poll is not None else []
        if not archives or int(archives[0]["docId"]) <= known["doc"]:
            return known
        return {"poll": poll, "doc": int(archives[0]["docId"]), "posted": archives[0].get("postDatetime")}

    def read(self, partition: PagePartition) -> Iterator[tuple]:
        poll, first, last, after, upto = partition.value
        polls = Polls(self.root)
        for k in range(first, last + 1):
            yield from polls.rows(poll, k, after, upto)


class ListingReader(_Pages, DataSourceReader):
    def partitions(self) -> list[PagePartition]:
        return self._between(START, self._latest(START)) or [PagePartition(-1, 1, 0, 0, 0)]

    def read(self, partition: PagePartition) -> Iterator[tuple]:
        if partition.value[0] >= 0:
            yield from super().read(partition)


class ListingStreamReader(_Pages, DataSourceStreamReader):
    def __init__(self, options):
        super().__init__(options)
        self.known = START

    def initialOffset(self) -> dict:  # noqa: N802
        return START

    def latestOffset(self) -> dict:  # noqa: N802
        self.known = self._latest(self.known)
        return self.known

    def partitions(self, start: dict, end: dict) -> list[PagePartition]:
        return self._between(start, end)


class ListingSource(DataSource):
    """``spark.read.format(NAME).load(folder)`` and ``spark.readStream.format(NAME).load(folder)``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ListingReader:
        return ListingReader(self.options)

    def streamReader(self, schema) -> ListingStreamReader:  # noqa: N802
        return ListingStreamReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ListingSource)


def read_listing(spark: SparkSession, root: str) -> DataFrame:
    """All documents of the newest complete poll."""
    register(spark)
    return spark.read.format(NAME).load(root)


def stream_listing(spark: SparkSession, root: str) -> DataFrame:
    """The documents of a listing as they are listed, each once."""
    register(spark)
    return spark.readStream.format(NAME).load(root)


def write_poll(listing: DataFrame, root: str, poll: int, size: int = 500) -> int:
    """Land ``listing(doc_id, post_local_text, friendly_name)`` as a poll of pages of ``size`` document ids,
    newest first; its number of pages. The first page, which makes a poll readable, is written last."""
    bounds = listing.agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).first()
    spark = listing.sparkSession
    pages = 1 if bounds.lo is None else (bounds.hi - bounds.lo) // size + 1
    number = F.floor((F.lit(bounds.hi) - F.col("doc_id")) / size).cast("int") + 1
    entry = F.struct(F.col("doc_id").alias("docId"), F.col("post_local_text").alias("postDatetime"), F.col("friendly_name").alias("friendlyName"))
    filled = listing.groupBy(number.alias("page")).agg(F.sort_array(F.collect_list(entry), asc=False).alias("archives"))
    every = spark.range(1, pages + 1).select(F.col("id").cast("int").alias("page")).join(filled, "page", "left")
    meta = F.struct(F.lit(pages).alias("totalPages")).alias("_meta")
    none = F.array().cast(filled.schema["archives"].dataType)
    text = F.to_json(F.struct(meta, F.coalesce("archives", none).alias("archives")))
    files = every.select("page", F.format_string(f"poll={poll}/page-%06d.json", "page").alias("name"), text.cast("binary").alias("content"))
    AR.export_files(files.filter("page > 1"), root).write.format("noop").mode("overwrite").save()
    AR.export_files(files.filter("page = 1"), root).write.format("noop").mode("overwrite").save()
    return pages
