"""Products in file form, verification product by product, and the report's rules."""

import datetime as dt
import json
from urllib.parse import urlparse

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from asofspark.operators.sample import sample_job
from asofspark.plans import monitor as MO
from asofspark.plans import products as PR
from asofspark.plans import quality as QR
from asofspark.plans.verify_lake import contract_of, verify_lake
from asofspark.queries import _product_document
from asofspark.session import scratch_path
from asofspark.sources import documents as DOC
from asofspark.sources import lake as LK
from asofspark.sources import snapshots as SN


def document(**changes):
    entry = json.loads(_product_document())["products"][-2] | changes
    return json.dumps({"products": [{k: v for k, v in entry.items() if v != "-"}]})


def test_a_document_is_read_whole(spark):
    path = scratch_path(spark, "products")
    spark.createDataFrame([(_product_document(),)], "value string").coalesce(1).write.text(path)
    found = PR.load_products(spark, path)
    assert PR.tables(found) == {"ev-click": "series", "ev-error": "series", "ev-signup": "series", "ev-view": "series", "zones": "series", "prices": "spp"}
    zones = next(p for p in found if p.key == "zones")
    assert zones.zones == ("z:a", "z:b") and zones.collected_from == dt.datetime(2024, 1, 4, 6) and found[0].zones == ()
    assert PR.declarations(found)["prices"].interval_minutes == 60 and found[0].cadence == "hourly"


@pytest.mark.parametrize("changes,words", [
    ({"cadence": "weekly"}, ["no cadence is called 'weekly'"]),
    ({"lookback_hours": 0, "stale_after_min": -5}, ["'lookback_hours' is not positive", "'stale_after_min' is not positive"]),
    ({"collected_from": "2024-01-04T06:00:00"}, ["'collected_from' is not an ISO time with its offset"]),
    ({"colour": 1, "table": "-"}, ["no field is called 'colour'", "'table' is missing"]),
    ({"interval_minutes": True, "columns": {"a": 1}}, ["'interval_minutes' is not int", "'columns' holds something else than text"]),
    ({"table": "prices", "time_style": "noon"}, ["no table family is called 'prices'", "no time style is called 'noon'"]),
    ({"total": "z:other", "interval_minutes": 7}, ["the total 'z:other' is none of its series", "an hour does not split into intervals of 7 minutes"]),
])
def test_all_faults_are_reported_at_once(changes, words):
    with pytest.raises(ValueError) as e:
        PR.parse_products(document(**changes))
    assert all(w in str(e.value) for w in words) and str(e.value).startswith("product document: zones: ")


def test_documents_that_are_none():
    for text, word in (("{", "not JSON"), ("[]", "no list of products"), ('{"products": [3]}', "entry 0 is not an object")):
        with pytest.raises(ValueError, match=word):
            PR.parse_products(text)
    two = json.loads(document())["products"] * 2
    with pytest.raises(ValueError, match="zones: declared 2 times"):
        PR.parse_products(json.dumps({"products": two}))


def write(root, product, date, batch, rows, stats=True, **columns):
    """One file of hourly series rows; ``rows``: (hour, series, value, version, source)."""
    at = [dt.datetime.combine(date, dt.time(12)) + dt.timedelta(hours=h) for h, *_ in rows]
    stamp = pa.timestamp("us")
    table = pa.table({"interval_start": pa.array(at, stamp), "interval_minutes": pa.array([60] * len(rows), pa.int32()),
                      "posted_at": pa.array(at, stamp), "ingested_at": pa.array(at, stamp), "source": pa.array([r[4] for r in rows], pa.string()),
                      "schema_version": pa.array([r[3] for r in rows], pa.int32()), "series": [r[1] for r in rows],
                      "value": pa.array([r[2] for r in rows], pa.float64()), "dst_flag": [False] * len(rows)} | columns)
    folder = f"{urlparse(root).path}/curated/product={product}/date={date}/batch={batch}"
    import os

    os.makedirs(folder, exist_ok=True)
    pq.write_table(table, f"{folder}/f.parquet", write_statistics=stats)


ZONES = [(0, "z:a", 1.0, 1, "x"), (0, "z:b", 2.0, 1, "x"), (0, "z:total", 3.0, 1, "x")]


def found(spark, root):
    products = PR.parse_products(_product_document())
    return {(r.product, r["check"], r.detail) for r in verify_lake(spark, root, products, tasks=3).collect()}


def test_the_contract_is_the_declared_schema():
    assert contract_of("series")[-3:] == [("series", "string"), ("value", "double"), ("dst_flag", "boolean")]


def test_a_clean_lake_has_no_findings_and_its_footers_are_enough(spark):
    root = scratch_path(spark, "verify")
    for d in range(4, 9):
        write(root, "zones", dt.date(2024, 1, d), "part-20240110T000000Z", ZONES)
        write(root, "ev-click", dt.date(2024, 1, d), "part-20240110T000000Z", ZONES[:2])
    write(root, "unknown", dt.date(2024, 1, 1), "part-20240110T000000Z", [(0, "q", 1.0, 9, None)])
    assert found(spark, root) == set()


@pytest.mark.parametrize("stats", [True, False])
def test_findings_do_not_depend_on_statistics(spark, stats):
    root = scratch_path(spark, "verify")
    day = lambda d: dt.date(2024, 1, d)
    write(root, "zones", day(1), "part-20240110T000000Z", ZONES, stats)  # before it is collected: no gap from here
    write(root, "zones", day(4), "part-20240110T000000Z", [*ZONES[:2], (0, "z:total", 503.0, 1, "x"), (1, "z:a", 1.0, 1, "x"), (2, "z:b", 9.0, 1, "x"),
                                                          (2, "z:total", 9.0, 1, "x")], stats)
    write(root, "zones", day(6), "part-20240110T000000Z", [(0, "z:a", 1.0, 1, None), (1, "z:a", 1.0, 1, None)], stats)
    write(root, "ev-click", day(4), "part-20240110T000000Z", [(0, "s", 1.0, 1, "x"), (0, "s", 1.0, 3, "x"), (1, "s", 1.0, 2, "x")], stats)
    write(root, "ev-click", day(5), "part-20240110T000000Z", ZONES, stats, note=pa.array(["n"] * 3))
    write(root, "ev-view", day(5), "part-20240110T000000Z", ZONES, stats, value=pa.array([1, 2, 3], pa.int64()))
    b = "batch=part-20240110T000000Z"
    assert found(spark, root) == {
        ("zones", "zones", "2024-01-04 12:00:00 posted 2024-01-04 12:00:00: 2 zones sum 3.0, total 503.0"),
        ("zones", "zones", "2024-01-04 14:00:00 posted 2024-01-04 14:00:00: 1 zones sum 9.0, total 9.0"),
        ("zones", "calendar", "1 missing delivery days: 2024-01-05"),
        ("zones", "nulls", f"date=2024-01-06 {b}: source has 2 NULL"),
        ("ev-click", "keys", "2024-01-04 12:00:00|s posted 2024-01-04 12:00:00 x2"),
        ("ev-click", "versions", f"date=2024-01-04 {b}: versions 1,2,3"),
        ("ev-click", "files", f"date=2024-01-05 {b}: differs from the contract: unexpected note string"),
        ("ev-view", "files", f"date=2024-01-05 {b}: differs from the contract: unexpected value bigint, missing value double")}


def test_only_live_directories_are_verified(spark):
    root = scratch_path(spark, "verify")
    write(root, "zones", dt.date(2024, 1, 4), "part-20240110T000000Z", ZONES)
    SN.start(spark, root)
    write(root, "zones", dt.date(2024, 1, 4), "merged-20240111T000000Z", ZONES)  # written, not committed
    assert found(spark, root) == set()
    SN.commit(spark, root, spark.createDataFrame([("zones", dt.date(2024, 1, 4), "merged-20240111T000000Z")], "product string, date date, batch string"))
    assert {c for _, c, _ in found(spark, root)} == {"keys", "zones"}  # every zone is there twice


def test_listing_stamps_that_cannot_be_read_are_reported(spark):
    rows = [(1, "2024-01-05T10:00:00.000", "a"), (2, "soon", "b"), (3, None, None), (4, "2024-01-06T10:00:00.000", "d")]
    listing = spark.createDataFrame(rows, "doc_id long, post_local_text string, friendly_name string")
    got = [tuple(r) for r in DOC.listing_docs(listing, "2024-01-05 00:00:00", "2024-01-06 00:00:00").collect()]
    assert got == [(2, None, "b", "unreadable posting time: soon"), (3, None, "3", "unreadable posting time: none"),
                   (1, dt.datetime(2024, 1, 5, 16), "a", None)]


def test_error_lines_of_one_time_are_cut_by_their_text(spark):
    at = dt.datetime(2024, 1, 5)
    rows = [(at, f"line {k:02d}") for k in range(40)]
    for seed in range(3):
        df = spark.createDataFrame(rows, "at timestamp_ntz, raw string").orderBy(F.rand(seed)).repartition(4)
        assert {r.text for r in MO.error_digest(df, "2024-01-04 00:00:00", "2024-01-06 00:00:00", n=5).collect()} == {f"line {k:02d}" for k in range(5)}


def test_formats_cover_the_same_names(spark):
    a = spark.createDataFrame([("HB_1",), ("HB_2",), ("N3",), (None,), ("HB_1",)], "p string")
    b = spark.createDataFrame([("HB_1",), ("LZ_9",), ("N4",)], "p string")
    assert tuple(QR.same_names({"api": a, "archive": b}, "p", ("HB_", "LZ_")).first()) == ("same_names", 3, 2)
    assert tuple(QR.same_names({"api": a, "archive": a}, "p").first()) == ("same_names", 3, 0)


def test_a_sample_says_whether_it_is_whole(spark):
    rows = [("f", i, n) for n, i in enumerate([1, 1, 2, 3])] + [("g", i, n) for n, i in enumerate([1, 2, 2])]
    df = spark.createDataFrame(rows, "file string, i int, n int")
    got = {(r.file, r.i, r.n, r.complete) for r in sample_job(df, file="file", order="n", interval="i", point=None).collect()}
    assert got == {("f", 1, 0, True), ("f", 1, 1, True), ("f", 2, 2, True), ("g", 1, 0, False), ("g", 2, 1, False), ("g", 2, 2, False)}


def test_kpis_leave_posting_hours_out(spark):
    day = dt.date(2024, 1, 5)
    cov = spark.createDataFrame([("a", day, "intervals", 96, 4), ("b", day, "postings", 24, 24)],
                                "product string, delivery_date date, unit string, expected long, n_missing int")
    stats = spark.createDataFrame([(10, 1, 0.1)], "invocations long, errors long, error_rate double")
    moved = spark.createDataFrame([("ALARM",), ("OK",), ("ALARM",)], "new string")
    rows = sorted(map(tuple, MO.kpis(cov, stats, F.lit(day), transitions=moved).collect()))
    assert rows == [(1, "covered on 2024-01-05: 95.8 % (4 of 96 missing)"), (2, "alarms within a day: 2"),
                    (3, "runs within a day: 10, 1 failed (10.00%)")]
