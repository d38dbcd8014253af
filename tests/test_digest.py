"""Order-free digests: equal for equal multisets, additive, and never the last word where they disagree."""

import random

import pytest
from pyspark.sql import functions as F

from asofspark.operators import digest as DG
from asofspark.plans import compact as CP
from asofspark.sources import archive as AR

ROWS = "day int, batch string, merged string, a int, b string"


def held(spark, rows, fn=CP.held_batches):
    df = spark.createDataFrame(rows, ROWS).repartition(4)
    return {(r.day, r.batch): (r.n_rows, r.held) for r in fn(df, batch="batch", merged="merged", by=["day"]).collect()}


def test_digests_do_not_depend_on_order_and_add_up(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(3), f"b{rng.randrange(4)}", None, rng.choice([1, 2, None]), rng.choice(["x", None])) for _ in range(300)]
    get = lambda df, by: {tuple(r[c] for c in by): (r.n, r.s1, r.s2) for r in df.collect()}
    one = DG.digests(spark.createDataFrame(rows, ROWS).repartition(5), ["day", "batch"], ["a", "b"])
    two = DG.digests(spark.createDataFrame(rows[::-1], ROWS).coalesce(1), ["day", "batch"], ["b", "a"])
    assert get(one, ["day", "batch"]) == get(two, ["day", "batch"])
    whole = DG.digests(spark.createDataFrame(rows, ROWS), ["day"], ["a", "b"])
    assert get(DG.added(one, ["day"]), ["day"]) == get(whole, ["day"])


def test_nulls_repeats_and_places_count(spark):
    sets = [[(1, None)], [(None, 1)], [(1, 1)], [(1, 1), (1, 1)], [(None, None)], []]
    found = set()
    for rows in sets:
        df = spark.createDataFrame([("g", *r) for r in rows], "g string, a int, b int")
        found.add(tuple(map(tuple, DG.digests(df, ["g"]).collect())))
    assert len(found) == len(sets)


@pytest.mark.parametrize("seed", range(3))
def test_held_batches_are_those_of_the_rows(spark, seed):
    rng = random.Random(seed)
    rows = []
    for day in range(8):
        source = [(day, f"part-{rng.randrange(3)}", "merged-1", rng.choice([1, 2, None]), rng.choice("xy")) for _ in range(20)]
        merged = [(day, "merged-1", "merged-1", a, b) for _, _, _, a, b in source]
        if day % 4 == 1:  # a batch that came after the merge
            source += [(day, "part-9", "merged-1", 5, "z")]
        if day % 4 == 2:  # a row of the merged batch lost
            merged.pop(rng.randrange(len(merged)))
        if day % 4 == 3:  # no merged batch
            merged, source = [], [(d, b, None, x, y) for d, b, _, x, y in source]
        rows += source + merged
    want = held(spark, rows, CP.held_rows)
    assert held(spark, rows) == want and {h for _, h in want.values()} == {True, False}


def test_rows_are_compared_only_where_digests_disagree(spark):
    asked = []

    def exact(df):
        asked.append(sorted({r.day for r in df.select("day").distinct().collect()}))
        return CP.held_rows(df, batch="batch", merged="merged", by=["day"])

    rows = [(d, b, "m", a, "x") for d in (1, 2, 3) for b in ("p", "q", "m") for a in ((1, 2) if b != "m" else (1, 2, 1, 2))]
    rows.append((2, "p", "m", 9, "x"))
    df = spark.createDataFrame(rows, ROWS)
    got = {(r.day, r.batch): r.held for r in DG.held_by_digest(df, batch="batch", merged="merged", by=["day"], exact=exact).collect()}
    assert asked == [[2]] and got == {(1, "p"): True, (1, "q"): True, (2, "p"): False, (2, "q"): True, (3, "p"): True, (3, "q"): True}


def test_a_collision_of_one_hash_takes_the_exact_way(spark, monkeypatch):
    real = DG.row_hash
    monkeypatch.setattr(DG, "row_hash", lambda columns, seed: F.lit(1).cast("decimal(38,0)") if seed == DG.SEEDS[0] else real(columns, seed))
    rows = [(1, "p", "m", 1, "x"), (1, "m", "m", 2, "x")]
    assert held(spark, rows) == {(1, "p"): (1, False)}


def test_differences_are_found_from_the_top(spark):
    base = [(f"p{p}", d, f"b{b}", x) for p in range(3) for d in range(4) for b in range(2) for x in range(5)]
    schema = "product string, date int, batch string, x int"
    levels = [["product"], ["product", "date"], ["product", "date", "batch"]]
    a = DG.digests(spark.createDataFrame(base, schema), levels[-1])
    assert DG.differing(a, a, levels).count() == 0
    other = [r for r in base if r[:3] != ("p0", 1, "b1")] + [("p2", 3, "b7", 1), ("p9", 0, "b0", 1)]
    other[other.index(("p1", 2, "b0", 3))] = ("p1", 2, "b0", 99)
    b = DG.digests(spark.createDataFrame(other, schema), levels[-1])
    got = {tuple(r) for r in DG.differing(a, b, levels).collect()}
    assert got == {("p0", 1, "b1", 5, None), ("p1", 2, "b0", 5, 5), ("p2", 3, "b7", None, 1), ("p9", 0, "b0", None, 1)}


def test_carried_columns_keep_their_values(spark, monkeypatch):
    import datetime as dt

    monkeypatch.setattr(AR, "_FLUSH_ROWS", 3)
    z = [AR.zip_members([("a.csv", AR.csv_bytes(["X"], [[str(k)] for k in range(n)]))]) for n in (5, 0, 4)]
    at = dt.datetime(2024, 1, 1, 0, 0, 0, 123456)
    rows = [("a", bytearray(z[0]), 2**60 + 1, at), ("b", bytearray(z[1]), None, None), ("c", bytearray(z[2]), -1, at), ("d", bytearray(b"no"), 7, None)]
    raw = spark.createDataFrame(rows, "path string, content binary, doc_id bigint, posted_at timestamp_ntz").coalesce(1)
    got = AR.unpack(raw, carry=["doc_id", "posted_at"]).collect()
    assert {(r.path, r.doc_id, r.posted_at) for r in got} == {(p, d, t) for p, _, d, t in rows}
    assert sorted((r.path, r.cells[0]) for r in got if r.cells) == [("a", str(k)) for k in range(5)] + [("c", str(k)) for k in range(4)]
    assert len(got) == 5 + 1 + 1 + 4 + 1 + 1
