"""Nearest neighbours by the forest against brute force."""

import numpy as np
import pytest

from asofspark.llm import annforest, queries

INF, NAN = float("inf"), float("nan")


def table(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, query_id string, v int").repartition(5, "v")


def make(seed=1, n=4000, dims=24):
    """Clusters, an evenly spread part, a third of copies of one vector, near copies, and unusable vectors."""
    rng = np.random.default_rng(seed)
    spread = rng.normal(size=(n, dims))
    spread[: n // 3] = rng.normal(size=(20, dims))[rng.integers(0, 20, n // 3)] + 0.05 * rng.normal(size=(n // 3, dims))
    spread = spread.astype(np.float32)
    rows = [(k, spread[k].tolist(), "x", k % 7) for k in range(n)]
    rows += [(n + k, spread[7].tolist(), "x", k % 7) for k in range(n // 2)]  # copies
    rows += [rows[0], rows[100], rows[100]]  # repeated rows
    bad = [None, [0.0] * dims, [1.0] * (dims - 1), [], [NAN] * dims, [INF] + [1.0] * (dims - 1), [None] + [1.0] * (dims - 1)]
    rows += [(100_000 + 100 * k, v, None, None) for k, v in enumerate(bad)] + [(None, [1.0] * dims, "x", 1)]
    return rows, {i: np.array(v, np.float32).astype(float) for i, v, _, _ in rows if i is not None and i < 100_000}


def brute(vectors, query_ids, k=10):
    ids = np.array(sorted(vectors))
    x = np.stack([vectors[i] for i in ids])
    out = {}
    for q in query_ids:
        d = np.sqrt(((x - vectors[q]) ** 2).sum(1))
        order = [j for j in np.lexsort((ids, d)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), float(d[j])) for j in order]
    return out


def grouped(out):
    got = {}
    for r in sorted(out.collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return got


@pytest.mark.parametrize("cell", [None, 150])
def test_recall_and_exact_scores(spark, cell):
    rows, vectors = make()
    df = table(spark, rows)
    got = grouped(annforest.nearest(spark, df, df.where("vec_id % 100 = 0"), sample=1000, cell=cell))
    want = brute(vectors, [i for i in vectors if i % 100 == 0])
    assert set(got) == set(want)
    hits = 0
    for q, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, 11))
        assert all(s == np.sqrt(((vectors[i] - vectors[q]) ** 2).sum()) and i != q for _, i, s in found)
        assert [(s, i) for _, i, s in found] == sorted((s, i) for _, i, s in found) and len({i for _, i, _ in found}) == 10
        hits += sum(s <= want[q][-1][1] for _, _, s in found)
    assert hits / (10 * len(want)) >= 0.95


def test_searching_all_leaves_is_exact(spark):
    rows, vectors = make(seed=2, n=600)
    df = table(spark, rows)
    got = grouped(annforest.nearest(spark, df, df.where("vec_id % 10 = 0"), sample=200, cell=90, probes=10**6))
    want = brute(vectors, [i for i in vectors if i % 10 == 0])
    assert {q: [(i, s) for _, i, s in f] for q, f in got.items()} == want


def test_the_shared_queue_takes_leaves_by_penalty():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 8))
    forest = annforest.Forest(x, 3, 8, 1)
    assert (forest.depth, forest.leaves) == (5, 32)
    margins, penalties = forest.margins(x[:20]), forest.penalties(x[:20])
    for k in range(20):
        found = forest.probe(margins[k].tolist(), 40)
        assert len(set(found)) == 40 and set(forest.leaf_of(x[k:k + 1])[0]) <= set(found)
        assert np.allclose(penalties[k][found], np.sort(penalties[k])[:40])


def test_a_leaf_beyond_the_bound_is_split():
    cells = annforest.Cells(np.array([10, 10, 95, 5, 40, 0, 0, 60]), 4, 50)
    assert cells.of_leaf.tolist() == [0, 0, 1, 2, 3, 3, 3, 4] and cells.pieces == [1, 2, 1, 1, 2]
    assert cells.first.tolist() == [0, 1, 3, 4, 5, 7]


def test_few_rows_and_no_rows(spark):
    few = table(spark, [(0, [1.0, 0.0], "x", 1), (100, [0.0, 1.0], "x", 1), (3, [1.0, 0.5], "x", 1), (4, [1.0, 0.5], "x", 1)], "double")
    got = grouped(annforest.nearest(spark, few, few.where("vec_id % 100 = 0")))
    assert got == {0: [(1, 3, 0.5), (2, 4, 0.5), (3, 100, 2 ** 0.5)], 100: [(1, 3, 1.25 ** 0.5), (2, 4, 1.25 ** 0.5), (3, 0, 2 ** 0.5)]}
    one = few.where("vec_id = 0")
    assert annforest.nearest(spark, one, one).count() == 0
    none = few.limit(0)
    assert annforest.nearest(spark, none, none).count() == 0
    assert annforest.nearest(spark, table(spark, [(0, [0.0, 0.0], "x", 1), (1, None, "x", 1)]), few).count() == 0


def test_query_recall_on_the_driver_tables(spark):
    import pyarrow.parquet as pq

    got = grouped(queries.op11_ann_forest(spark, "/root/testdata/sf0.1"))
    t = pq.read_table("/root/testdata/sf0.1/embeddings.parquet")
    vectors = {i: np.array(v, np.float32).astype(float) for i, v in zip(t["vec_id"].to_pylist(), t["embedding"].to_pylist(), strict=True)}
    want = brute(vectors, [i for i in vectors if i % 100 == 0])
    assert set(got) == set(want)
    assert sum(len({i for _, i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) / (10 * len(want)) >= 0.9
