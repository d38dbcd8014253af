"""Cases that once lost or changed rows: joins with NULLs, damaged archives, stamps, melts, state."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from asofspark import fixtures as FX
from asofspark.functions import parse as P
from asofspark.functions import time as T
from asofspark.operators import pit
from asofspark.operators import sample as SA
from asofspark.plans import ingest as IN
from asofspark.plans import transform as TR
from asofspark.plans import verify as VF
from asofspark.plans.declare import Declaration
from asofspark.session import scratch_path, shared_dir
from asofspark.sources import archive as AR
from asofspark.sources import lake as LK
from asofspark.streaming import stream as ST


def test_join_answers_alike_for_every_bucket(spark):
    import random

    rng = random.Random(5)
    def when():
        return None if rng.random() < 0.1 else f"2024-01-{rng.randint(1, 9):02d} {rng.randint(0, 23):02d}:00:00"
    keys = ["a", "b", None]
    facts = {(rng.choice(keys), when()): float(k) for k in range(120)}
    facts = [(k, t, v) for (k, t), v in facts.items()]
    decisions = [(n, rng.choice(keys), when()) for n in range(150)]
    f = spark.createDataFrame(facts, "k string, t string, v double").withColumn("t", F.col("t").cast("timestamp_ntz"))
    d = spark.createDataFrame(decisions, "n int, k string, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    want = {}
    for n, k, t in decisions:
        known = [(p, v) for fk, p, v in facts if fk == k and t and p and p <= t]
        want[n] = max(known)[1] if known else None
    for bucket in (None, "1 hour", "1 day"):
        got = pit.point_in_time_join(d, f, on="k", decision_time="t", posted="t", value_cols=["v"], bucket=bucket).collect()
        assert {r.n: r.v for r in got} == want and len(got) == len(decisions), bucket


def zipped(*members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for name, data in members:
            z.writestr(name, data)
    return buf.getvalue()


HEADER = ",".join(FX.EVENTS_DECL_COLUMNS.values())


def test_damaged_archives_are_rows(spark):
    good = zipped(("a.csv", b"x,y\r\n1,2\r\n\r\n"))
    deep = zipped(("in.zip", zipped(("more.zip", good), ("note.txt", b"n"))))
    raw = spark.createDataFrame([("good", bytearray(good)), ("deep", bytearray(deep)), ("junk", bytearray(b"no zip")),
                                 ("none", bytearray(zipped(("a.txt", b"")))), ("blank", bytearray(zipped(("a.csv", b"")))),
                                 ("bytes", bytearray(zipped(("a.csv", b"x\n\xff\xfe"))))], "path string, content binary")
    rows = AR.unpack(raw).collect()
    assert {r.path for r in rows} == {"good", "deep", "junk", "none", "blank", "bytes"}
    assert {r.path for r in rows if r.problem} == {"junk", "none", "blank", "bytes"}
    lines = AR.csv_records(raw).collect()
    assert {(r.path, r.doc, tuple(r.cells)) for r in lines} == {("good", None, ("1", "2")), ("deep", "in.zip", ("1", "2"))}


def test_one_bad_posting_stops_only_its_product(spark):
    line = f"{HEADER}\r\n01/05/2024 10:00:00,N,7,click,1.5,1,2024-01-05 10:00:00.000000\r\n"
    cells = [("ev-click", "2024-01-05 17:00:00", 1, zipped(("a.csv", line))),
             ("ev-click", "2024-01-05 18:00:00", 2, zipped(("a.csv", HEADER + "\r\n"))),  # a good posting without rows
             ("ev-error", "2024-01-05 17:00:00", 3, b"not a zip"), ("ev-error", "2024-01-05 18:00:00", 4, zipped(("a.csv", line))),
             ("ev-view", "2024-01-05 17:00:00", 5, zipped(("a.csv", "Other,Header\r\n"))),
             ("ev-signup", "2024-01-05 17:00:00", 6, zipped(("readme.txt", "x"))),
             ("unknown", "2024-01-05 17:00:00", 7, zipped(("a.csv", line)))]
    raw = spark.createDataFrame([(p, t, d, f"{d}.zip", bytearray(c)) for p, t, d, c in cells],
                                "product string, posted_at string, doc_id bigint, name string, content binary")
    raw = raw.withColumn("posted_at", F.col("posted_at").cast("timestamp_ntz"))
    root = scratch_path(spark, "bad")
    out = {r["product"]: r for r in IN.ingest(spark, raw, FX.event_declarations(), root, ingested_at="2024-02-01 00:00:00").collect()}
    assert (out["ev-click"].docs, out["ev-click"]["rows"], out["ev-click"].failed, str(out["ev-click"].last_posted_at)) == (
        2, 1, 0, "2024-01-05 18:00:00")
    assert {p for p, r in out.items() if r.failed} == {"ev-error", "ev-view", "ev-signup", "unknown"}
    assert out["ev-error"]["rows"] == 0 and out["ev-error"].last_posted_at is None
    assert "drift" in out["ev-view"].error and "declared" in out["unknown"].error
    states = {r["product"]: r for r in IN.read_state(spark, root, "watermarks").collect()}
    assert states["ev-click"].status == "ok" and states["unknown"].status == "error"
    manifests = {r["product"]: r for r in IN.read_state(spark, root, "manifests").collect()}
    assert manifests["ev-click"].docs == 2 and manifests["ev-view"].docs == 0
    # the same second, another document, another run: both stay; the window starts at the watermark
    more = raw.filter("doc_id = 1").withColumn("doc_id", F.lit(11).cast("bigint"))
    IN.ingest(spark, more, FX.event_declarations(), root, ingested_at="2024-02-01 00:00:00", update_progress=False)
    assert spark.read.parquet(f"{root}/curated").count() == 2
    again = IN.ingest(spark, raw.filter("product = 'ev-click'"), FX.event_declarations(), root, ingested_at="2024-02-02 00:00:00",
                      window={"now": "2024-02-02 00:00:00"}, land=False)
    assert again.count() == 0
    kept = {r["product"]: r for r in IN.read_state(spark, root, "manifests").collect()}
    assert kept["ev-click"].docs == 2


def test_crash_before_the_write_and_replay_lose_nothing(spark, monkeypatch):
    landing, root, ckpt = (scratch_path(spark, n) for n in ("landing", "lake", "ckpt"))
    z = FX.posting_zips(spark, "/root/testdata/sf0.001").filter(F.col("day") <= F.lit("2024-01-04").cast("date"))
    late = F.col("day") == F.lit("2024-01-02").cast("date")
    decls = FX.event_declarations()

    def run():
        q = ST.stream_ingest(spark, landing, decls, root, ckpt, ingested_at="2024-02-01 00:00:00", product=FX.event_product)
        q.awaitTermination()

    AR.export_files(z.filter(~late).unionByName(FX.placeholders(z.filter(late))), f"{landing}/drop0").write.format("noop").mode("overwrite").save()
    run()
    held = IN.read_state(spark, root, "pending").count()
    assert held > 0 and "content" not in IN.read_state(spark, root, "pending").columns
    AR.export_files(z.filter(late), f"{landing}/drop1").write.format("noop").mode("overwrite").save()
    whole = LK.write_curated
    monkeypatch.setattr(LK, "write_curated", lambda *a: (_ for _ in ()).throw(OSError("disk")))
    with pytest.raises(Exception, match="disk"):
        run()
    assert IN.read_state(spark, root, "pending").count() == held
    monkeypatch.setattr(LK, "write_curated", whole)
    run()
    want = scratch_path(spark, "batch")
    raw = z.select(FX.event_product(F.col("event_type")).alias("product"), T.local_to_utc("posted_local").alias("posted_at"),
                   "doc_id", F.col("member").alias("name"), "content")
    IN.ingest(spark, raw, decls, want, ingested_at="2024-02-01 00:00:00", land=False)
    rows = [sorted(map(str, spark.read.parquet(f"{r}/curated").drop("ingested_at").collect())) for r in (root, want)]
    assert rows[0] == rows[1]


def test_a_replayed_batch_appends_once(spark):
    path = scratch_path(spark, "counts")
    df = spark.range(3)
    for batch in (0, 1, 1):
        ST._parts_of(path)(df, batch)
    assert ST.read_table(spark, path, "append").count() == 6
    state = scratch_path(spark, "state")
    for n in range(6):
        LK.write_version(spark, spark.range(n), state)
    assert LK.read_version(spark, state).count() == 5 and LK.read_version(spark, state, before=5).count() == 4


def test_stamps_keep_their_fractions_and_offsets(spark):
    texts = ["2024-01-05T10:00:00", "2024-01-05T10:00:00.5", "2024-01-05T10:00:00.123456", "2024-01-05T10:00:00.1234567", "x"]
    got = [r.t for r in spark.createDataFrame([(t,) for t in texts], "s string").select(T.parse_post_local("s").alias("t")).collect()]
    assert [str(g)[11:] if g else None for g in got] == ["10:00:00", "10:00:00.500000", "10:00:00.123456", None, None]
    iso = ["2024-01-05T10:00:00Z", "2024-01-05 10:00:00.25+02:00", "2024-01-05T10:00:00-0530", "2024-01-05T10:00:00.123456789Z", "no"]
    got = [r.t for r in spark.createDataFrame([(t,) for t in iso], "s string").select(P.iso_timestamp(F.col("s")).alias("t")).collect()]
    assert [str(g)[11:] if g else None for g in got] == ["10:00:00", "08:00:00.250000", "15:30:00", "10:00:00.123456", None]


def test_a_blank_series_row_keeps_its_time_problem(spark):
    decl = Declaration(product="p", table="series", interval_minutes=60, time_style="hour_ending",
                       columns={"delivery_date": "D", "hour_ending": "H", "a": "A", "b": "B"}, series={"a": "a", "b": "b"})
    rec = spark.createDataFrame([("1", ["D", "H", "A", "B"], ["01/05/2024", "99", "", ""]), ("2", ["D", "H", "A", "B"], ["01/05/2024", "1", "", "3"])],
                                "posting string, header array<string>, cells array<string>")
    rec = rec.withColumn("posted_at", F.lit("2024-01-05 00:00:00").cast("timestamp_ntz")).withColumn("ingested_at", F.col("posted_at"))
    rows = TR.transform(rec, decl)
    status = {r.posting: r.status for r in TR.posting_status(rows).collect()}
    assert status == {"1": "failed", "2": "ok"} and rows.filter("posting = 2").count() == 1


def test_zone_sums_name_their_zones_and_need_a_total(spark):
    at = "timestamp_ntz'2024-01-05 06:00:00'"
    base = (f"SELECT 'p' AS product, date'2024-01-05' AS date, 'part-x' AS batch, {at} AS interval_start, {at} AS posted_at, "
            "'archive' AS source, 60 AS interval_minutes, 1 AS schema_version, {0} AS ingested_at, '{1}' AS series, {2}D AS value")
    def lake(rows):
        return spark.sql(" UNION ALL ".join(base.format(at, s, v) for s, v in rows))
    zones = {"p": (["z_a", "z_b"], "z_total")}
    ok = VF.verify(lake([("z_a", 1), ("z_b", 2), ("z_total", 3)]), ["interval_start", "series"], zone_sums=zones)
    assert ok.count() == 0
    # without a total there is nothing to compare, whatever zones there are
    for rows in ([("z_a", 1), ("z_b", 2)], [("z_a", 1)]):
        assert VF.verify(lake(rows), ["interval_start", "series"], zone_sums=zones).count() == 0, rows
    for rows in ([("z_a", 1), ("z_total", 3)], [("z_a", 1), ("z_b", 500), ("z_total", 3)]):
        out = VF.verify(lake(rows), ["interval_start", "series"], zone_sums=zones).collect()
        assert [r.check for r in out] == ["zone_sum"], rows


def test_sample_keeps_every_hub_and_the_first_others(spark):
    rows = [("f", n // 20, n, ("HB_" if n % 4 == 0 else "P") + str(n)) for n in range(60)]
    df = spark.createDataFrame(rows, "file string, i int, n int, point string")
    got = {r.n for r in SA.sample(df, file="file", order="n", interval="i", point="point", intervals=2, others=3).collect()}
    want = set()
    for i in (0, 1):
        own = [r for r in rows if r[1] == i]
        want |= {r[2] for r in own if r[3].startswith("HB_")} | {r[2] for r in own if not r[3].startswith("HB_")} .intersection(
            sorted(r[2] for r in own if not r[3].startswith("HB_"))[:3])
    assert got == want


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="share"):
        shared_dir(Session())
