"""A listing as a data source: every document once, few pages opened, replays alike."""

import json
import os
import random
from urllib.parse import urlparse

import pytest

from asofspark.session import scratch_path
from asofspark.sources import listing as LS


def land(root, poll, docs, size=10, total=None, skip=()):
    folder = f"{urlparse(root).path}/poll={poll}"
    os.makedirs(folder, exist_ok=True)
    docs = sorted(docs, reverse=True)
    pages = [docs[s:s + size] for s in range(0, len(docs), size)] or [[]]
    for k, page in enumerate(pages, 1):
        if k not in skip:
            body = {"_meta": {"totalPages": total or len(pages)},
                    "archives": [{"docId": d, "postDatetime": f"2024-01-01T00:{d % 60:02d}:00", "friendlyName": None if d % 7 == 0 else f"n{d}"} for d in page]}
            with open(f"{folder}/page-{k:06d}.json", "w") as f:
                json.dump(body, f)
    return len(pages)


def drain(spark, root, out, ckpt):
    (LS.stream_listing(spark, root).writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
     .trigger(availableNow=True).start().awaitTermination())
    return sorted((r.doc_id, r.page) for r in spark.read.parquet(out).collect())


def test_a_batch_read_is_the_newest_complete_poll(spark):
    root = scratch_path(spark, "listing")
    assert not os.path.exists(urlparse(root).path)
    land(root, 1, range(5, 40))
    land(root, 2, range(5, 60), skip=[3])  # still being written
    got = LS.read_listing(spark, root).collect()
    assert sorted(r.doc_id for r in got) == list(range(5, 40)) and {r.page for r in got} == {1, 2, 3, 4}
    assert {r.friendly_name for r in got if r.doc_id == 7} == {None} and got[0].post_local_text.startswith("2024-01-01T00:")


def test_no_polls(spark):
    root = scratch_path(spark, "listing")
    assert LS.read_listing(spark, root).count() == 0
    land(root, 1, [])
    assert LS.read_listing(spark, root).count() == 0


def test_a_stream_resumes_from_its_offset(spark):
    root, out, ckpt = (scratch_path(spark, n) for n in ("listing", "out", "ckpt"))
    land(root, 1, range(100, 150))
    assert [d for d, _ in drain(spark, root, out, ckpt)] == list(range(100, 150))
    assert [d for d, _ in drain(spark, root, out, ckpt)] == list(range(100, 150))  # nothing new
    land(root, 2, range(100, 150))  # the same documents again
    land(root, 3, range(100, 175))
    land(root, 4, range(100, 190), skip=[1])  # not complete
    got = drain(spark, root, out, ckpt)
    assert [d for d, _ in got] == list(range(100, 175))
    assert {p for d, p in got if d >= 150} == {1, 2, 3} and all(p <= 3 for d, p in got if d >= 150)
    land(root, 4, range(100, 190))
    assert [d for d, _ in drain(spark, root, out, ckpt)] == list(range(100, 190))


@pytest.mark.parametrize("seed", range(5))
def test_pages_are_found_by_bisection(spark, seed):
    rng = random.Random(seed)
    root = scratch_path(spark, "listing")
    docs = sorted(rng.sample(range(5000), 640))
    pages = land(root, 0, docs)
    polls = LS.Polls(root)
    for doc in (-1, docs[0], docs[-1], *rng.sample(range(5000), 20)):
        opened = []
        real = LS.Polls.page
        polls.page = lambda poll, k: opened.append(k) or real(polls, poll, k)
        found = polls.pages_after(0, doc)
        want = sum(any(d > doc for d in sorted(docs, reverse=True)[s:s + 10]) for s in range(0, 640, 10))
        assert found == want and len(opened) <= 8 and pages == 64
        rows = [r[0] for k in range(1, found + 1) for r in real(polls, 0, k)["archives"] and LS.Polls(root).rows(0, k, doc, docs[-1])]
        assert sorted(rows) == [d for d in docs if d > doc]


def test_a_micro_batch_reads_the_same_rows_again(spark):
    root = scratch_path(spark, "listing")
    land(root, 1, range(30))
    reader = LS.ListingStreamReader({"path": root})
    start, end = reader.initialOffset(), reader.latestOffset()
    first = [r for p in reader.partitions(start, end) for r in reader.read(p)]
    land(root, 2, range(80))
    again = LS.ListingStreamReader({"path": root})
    assert [r for p in again.partitions(start, json.loads(json.dumps(end))) for r in again.read(p)] == first and len(first) == 30
    later = again.latestOffset()
    assert later["poll"] == 2 and sorted(r[0] for p in again.partitions(end, later) for r in again.read(p)) == list(range(30, 80))


def test_polls_are_written_in_pages(spark):
    root = scratch_path(spark, "listing")
    docs = spark.range(1, 100, 3).selectExpr("id AS doc_id", "'t' AS post_local_text", "CAST(NULL AS STRING) AS friendly_name")
    assert LS.write_poll(docs, root, 7, size=20) == 5
    got = LS.read_listing(spark, root).collect()
    assert sorted(r.doc_id for r in got) == list(range(1, 100, 3)) and {r.page for r in got} == {1, 2, 3, 4, 5}
    assert LS.write_poll(docs.limit(0), root, 8) == 1
