"""Findings of round 3: lakes that nothing was taken into, documents whose size grows with the tables."""

import datetime as dt
import json
import re
import tracemalloc

import pytest
from pyspark.sql import functions as F

from asofspark import fixtures as FX
from asofspark.plans import ingest as IN
from asofspark.plans.read import read_curated
from asofspark.queries import QUERIES
from asofspark.session import JIT_OPTIONS, fit_methods, scratch_path
from asofspark.sources import archive as AR
from asofspark.sources import documents as DOC
from asofspark.sources import listing as LS

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def tables(spark, folder, rows) -> str:
    """A folder with these events: (event_id, ts, user_id, event_type, value)."""
    spark.createDataFrame([(*r, None) for r in rows], EVENTS).write.parquet(f"{folder}/events.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def refused(spark, tmp_path_factory):
    """Every posting repeats a business key: all products stop at their first one."""
    t = dt.datetime(2024, 1, 3, 9, 0)
    rows = [(4 * d + k, t + dt.timedelta(days=d, seconds=k), 7, "click", 1.5 * k) for d in range(2) for k in range(2)]
    return tables(spark, tmp_path_factory.mktemp("refused") / "sf", rows)


@pytest.mark.parametrize("name", ["backfill_rows", "rebuild_identity", "stream_defer"])
def test_a_lake_that_nothing_was_taken_into_has_columns_and_no_rows(spark, refused, name):
    got = QUERIES[name](spark, refused)
    assert got.count() == 0
    assert {"product", "interval_start", "price_mwh"} <= set(got.columns)


def test_reads_of_a_lake_without_rows(spark):
    root = scratch_path(spark, "nothing")
    assert read_curated(spark, root, "spp").count() == 0 and read_curated(spark, root).count() == 0
    assert IN.lake_digests(spark, root).count() == 0
    IN.start_slots(spark, root)
    assert IN.read_state(spark, root, "slots").count() == 0


def test_an_exploded_page_row_carries_the_header_and_not_the_page(spark):
    pages = spark.createDataFrame([(1, '{"fields":[{"name":"a"},{"name":"b"}],"data":[[1,"x"],[null,"y"]]}'), (2, "no page")], "k int, v string")
    got = DOC.parse_api_pages(pages, "v")
    assert [tuple(r) for r in got.orderBy("k", "row_no").collect()] == [(1, ["a", "b"], 0, ["1", "x"]), (1, ["a", "b"], 1, [None, "y"])]
    generate = next(x for x in got._jdf.queryExecution().executedPlan().toString().splitlines() if "Generate" in x)
    assert re.search(r"posexplode\(data#\d+\), \[k#\d+, header#\d+\]", generate), generate


def test_a_document_is_built_from_passing_rows(spark):
    rows = spark.range(50_000).select((F.col("id") % 2).alias("k"), "id")

    def build(key, passing):
        first = next(passing)
        return {"k": key[0], "first": first[0], "n": 1 + sum(1 for _ in passing), "lazy": hasattr(passing, "send")}

    got = FX.documents_of(rows, ["k"], "id", build, "k bigint, first bigint, n bigint, lazy boolean")
    assert sorted(map(tuple, got.collect())) == [(0, 0, 25_000, True), (1, 1, 25_000, True)]


def test_members_are_streamed_and_damage_is_told_before_any_line(spark):
    lines = [[str(k), "é" * 40] for k in range(120_000)]
    whole = AR.zip_csv("a.csv", ["X", "Y"], lines)
    assert [r[7] for r in AR._records("p", whole) if r[7]] == lines
    tracemalloc.start()
    n = sum(1 for _ in AR._records("p", whole))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == len(lines) + 1 and peak < 8 << 20, peak
    at = whole.index(b"a.csv") + 5_000  # inside the compressed lines
    broken = whole[:at] + bytes([whole[at] ^ 0xFF]) + whole[at + 1:]
    assert [r[8] is None for r in AR._records("p", broken)] == [False]


def test_a_listings_tasks_do_not_grow_with_its_pages(tmp_path, monkeypatch):
    monkeypatch.setattr(LS, "TASKS", 4)
    (tmp_path / "poll=1").mkdir()
    for k in range(1, 11):  # ten pages of three documents, newest first
        archives = [{"docId": 30 - 3 * (k - 1) - n, "postDatetime": "t", "friendlyName": None} for n in range(3)]
        (tmp_path / "poll=1" / f"page-{k:06d}.json").write_text(json.dumps({"_meta": {"totalPages": 10}, "archives": archives}))
    reader = LS.ListingStreamReader({"path": str(tmp_path)})
    parts = reader.partitions(LS.START, reader.latestOffset())
    assert len(parts) == 4
    got = [r for p in parts for r in reader.read(p)]
    assert [r[0] for r in got] == list(range(30, 0, -1)) and [r[3] for r in got] == [1 + n // 3 for n in range(30)]
    few = reader.partitions({**LS.START, "doc": 25}, reader.latestOffset())  # documents 26 to 30 stand on two pages
    assert len(few) == 2 and sorted(r[0] for p in few for r in reader.read(p)) == [26, 27, 28, 29, 30]


def test_methods_fit_the_jit_where_executors_lack_the_option(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    for options, before, after in (("", None, "8000"), (f"-Xss4m {JIT_OPTIONS}", None, "65535"), ("", "20000", "20000")):
        s = spark.newSession()
        if before:
            s.conf.set(key, before)
        fit_methods(s, options)
        assert s.conf.get(key) == after
