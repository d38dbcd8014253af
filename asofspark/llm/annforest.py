"""Approximate nearest neighbours: a forest of random-projection trees and one queue for all of them.

* Fit. A bounded sample of the vectors (``SAMPLE``, the smallest hashes) grows the trees: at
  every node a random direction, cut at the median of the node's sample, down to leaves of some ``LEAF``
  sample vectors. The planes are a table of fixed size and travel to the tasks.
* Index. Every row is dealt to its leaf in every tree, as part of a cell: neighbouring leaves of
  a tree with at most ``CELL_BYTES`` of vectors together. A leaf that holds more alone is split into pieces by
  the rows' ids, so a cell never grows with the data, whatever the rows' density.
* Search. All trees' roots start in one priority queue. The node with the least penalty (the sum of
  squared distances to the planes that were crossed against the query's side) is taken and
  followed to its leaf, while the other sides join the queue, until ``probes`` leaves are found, in
  whichever trees they lie. How many: the sample is searched with sample queries, and the number
  that finds ``recall`` of their true neighbours there is taken for all rows, whose
  neighbours are nearer and so found more easily.
* Reranking. A query visits the cells that hold its leaves, one task each, where the cell's rows are held and
  queries stream by. Candidates are ranked by matrix products, and the leading ones once more by exact
  distances in double precision. The best of all cells are merged by rows.

Queries with equal vectors are searched once. Equal rows count once.

Cases: vectors that are null, all zero, of another length than most, or hold null or non-finite
components take no part, nor do rows without an id. Ties go to the smaller id. A query leaves out rows
of its own id; ids are taken to name one vector (of an id with several, each is a row of its own, and as a query
it has the nearest of all of them). Fewer candidates than k: all of them. An empty table gives no
rows. Columns other than id and vector are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from asofspark.llm.common import bounded_batches, shuffle_width, written

TREES = 4
SAMPLE = 16_384
LEAF = 16
CELL_BYTES = 12 << 20
RECALL = 0.98
SEED = 20240229
_CHUNK = 256  # queries ranked at once
_TRIED = 256  # sample queries that choose the number of leaves


# ---- the forest ------------------------------------------------------------------------------------

class Forest:
    """Complete binary trees over a sample: planes of inner nodes, row by row, tree after tree."""

    def __init__(self, sample: np.ndarray, trees: int, leaf: int, seed: int):
        rng = np.random.default_rng(seed)
        self.dims = sample.shape[1]
        self.trees = trees
        self.depth = max(0, int(np.log2(max(1, len(sample) / leaf))))
        self.leaves = 1 << self.depth
        inner = self.leaves - 1
        self.planes = rng.normal(size=(trees * inner, self.dims))
        self.planes /= np.maximum(np.linalg.norm(self.planes, axis=1, keepdims=True), 1e-300)
        self.cuts = np.zeros(trees * inner)
        for t in range(trees):
            groups = [np.arange(len(sample))]
            for node in range(inner):
                rows = groups[node]
                side = sample[rows] @ self.planes[t * inner + node]
                cut = np.median(side) if len(rows) else 0.0
                self.cuts[t * inner + node] = cut
                groups += [rows[side < cut], rows[side >= cut]]

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row of ``x`` in every tree, numbered through all trees."""
        inner, out = self.leaves - 1, np.zeros((len(x), self.trees), np.int64)
        for t in range(self.trees):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = t * inner + node
                node = 2 * node + 1 + ((x * self.planes[at]).sum(1) >= self.cuts[at])
            out[:, t] = t * self.leaves + node - inner
        return out

    def margins(self, x: np.ndarray) -> np.ndarray:
        return x @ self.planes.T - self.cuts

    def probe(self, margins: list[float], probes: int) -> list[int]:
        """The first ``probes`` leaves that the queue shared by all trees gives for a query."""
        inner, found = self.leaves - 1, []
        queue = [(0.0, t, 0) for t in range(self.trees)]
        while queue and len(found) < probes:
            penalty, t, node = heapq.heappop(queue)
            base = t * inner
            while node < inner:
                m = margins[base + node]
                right = 2 * node + 2
                near, far = (right, right - 1) if m >= 0 else (right - 1, right)
                heapq.heappush(queue, (penalty + m * m, t, far))
                node = near
            found.append(t * self.leaves + node - inner)
        return found

    def penalties(self, x: np.ndarray) -> np.ndarray:
        """The penalty of every leaf of every tree: what orders the queue."""
        inner, margins, out = self.leaves - 1, self.margins(x), []
        for t in range(self.trees):
            p = np.zeros((len(x), 1))
            for level in range(self.depth):
                m = margins[:, t * inner + (1 << level) - 1:t * inner + (2 << level) - 1]
                p = np.stack([p + np.maximum(m, 0) ** 2, p + np.minimum(m, 0) ** 2], 2).reshape(len(x), -1)
            out.append(p)
        return np.concatenate(out, 1)

    def probes_for(self, sample: np.ndarray, k: int, recall: float) -> int:
        """How many leaves find ``recall`` of the k nearest of sample queries in the sample."""
        n = len(sample)
        if n < 2:
            return self.trees
        tried = sample[:: max(1, n // _TRIED)][:_TRIED]
        at = np.arange(0, n, max(1, n // _TRIED))[:_TRIED]
        k = min(k, n - 1)
        far = squared(tried, sample)
        far[np.arange(len(at)), at] = np.inf
        nearest = np.argpartition(far, k - 1, axis=1)[:, :k]
        order = np.argsort(np.argsort(self.penalties(tried), axis=1, kind="stable"), axis=1)
        leaf = self.leaf_of(sample)
        rank = order[np.arange(len(at))[:, None, None], leaf[nearest]].min(axis=2)
        return int(max(self.trees, np.quantile(rank, recall, method="higher") + 1))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances by products: near the exact ones, for ranking only."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T), 0)


# ---- vectors as rows ---------------------------------------------------------------------------------

def _dtype(df: DataFrame, vec_col: str) -> str:
    return "<f4" if df.schema[vec_col].dataType.simpleString() == "array<float>" else "<f8"


def _usable(column: pa.Array, dims: int, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """``(rows, vectors)`` of the usable vectors of a list column."""
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lengths == dims)
    flat = column.take(pa.array(rows)).flatten().cast(pa.float32() if dtype == "<f4" else pa.float64())
    x = flat.fill_null(float("nan")).to_numpy(zero_copy_only=False).astype(dtype).reshape(-1, dims)
    ok = np.isfinite(x).all(1) & (x != 0).any(1)
    return rows[ok], x[ok]


def _vector_rows(df: DataFrame, id_col: str, vec_col: str, dims: int, dtype: str) -> DataFrame:
    """``(id, h1, h2, v)``: usable vectors as bytes, with a 128-bit hash. Equal rows of a batch count once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, x = _usable(b.column(1), dims, dtype)
            ids, seen, kept, hashes, vectors = b.column(0), set(), [], [], []
            for r, v in zip(rows.tolist(), x + 0.0, strict=True):  # -0.0 becomes 0.0
                v = v.tobytes()
                key = (ids[r].as_py(), v)
                if key[0] is not None and key not in seen:
                    seen.add(key), kept.append(key[0]), vectors.append(v)
                    h = xxhash.xxh3_128_intdigest(v)
                    hashes.append((h >> 64, h & (1 << 64) - 1))
            h = np.array(hashes, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.record_batch([pa.array(kept, pa.int64()), pa.array(np.ascontiguousarray(h[:, 0])),
                                   pa.array(np.ascontiguousarray(h[:, 1])), pa.array(vectors, pa.binary())],
                                  names=["id", "h1", "h2", "v"])

    slim = df.select(df[id_col].cast("long").alias("id"), df[vec_col].alias("v"))
    return slim.mapInArrow(run, "id long, h1 long, h2 long, v binary")


def sample_of(rows: DataFrame, id_col: str, vec_col: str, size: int, dtype: str) -> np.ndarray:
    """Usable vectors with the smallest hashes, about ``size`` and never more than twice as many."""
    known = rows.select(rows[id_col].alias("id"), rows[vec_col].alias("v")).where(
        "id is not null and exists(v, x -> x <> 0) and not exists(v, x -> x is null or isnan(x) or abs(x) = double('inf'))")
    n = known.count()
    share = min(1.0, size / max(n, 1))
    picked = known.withColumn("h", F.xxhash64("id", "v", F.lit(SEED)))
    if share < 1:
        picked = picked.where(F.col("h") < int(-(1 << 63) + share * ((1 << 64) - 1)))
    # equal rows have equal hashes and count once
    got = picked.distinct().limit(2 * size).toArrow().sort_by([("h", "ascending"), ("id", "ascending")]).combine_chunks()
    column = got.column("v").combine_chunks() if got.num_rows else pa.array([], got.schema.field("v").type)
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    lengths, many = np.unique(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), return_counts=True)
    if not len(lengths):
        return np.zeros((0, 0))
    return _usable(column, int(lengths[np.argmax(many)]), dtype)[1].astype(np.float64)


# ---- cells -------------------------------------------------------------------------------------------

class Cells:
    """Neighbouring leaves joined into cells of bounded rows; a leaf beyond the bound in pieces."""

    def __init__(self, counts: np.ndarray, leaves: int, cell: int):
        self.of_leaf = np.zeros(len(counts), np.int64)
        self.pieces: list[int] = []
        held = 0
        for leaf, n in enumerate(counts.tolist()):
            if leaf % leaves == 0 or held + n > cell:
                self.pieces.append(1)
                held = 0
            held += n
            self.of_leaf[leaf] = len(self.pieces) - 1
            self.pieces[-1] = max(1, -(-held // cell))
        self.first = np.r_[0, np.cumsum(self.pieces)].astype(np.int64)

    @property
    def groups(self) -> int:
        return int(self.first[-1])


def _leaf_counts(vectors: DataFrame, forest: Forest, dtype: str) -> np.ndarray:
    """Rows of every leaf; one row per leaf reaches the driver, and leaves are as many as the sample allows."""
    total = forest.trees * forest.leaves

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(total, np.int64)
        for b in batches:
            n += np.bincount(forest.leaf_of(_matrix(b.column(0), forest.dims, dtype)).ravel(), minlength=total)
        at = np.flatnonzero(n)
        yield pa.record_batch([pa.array(at), pa.array(n[at])], names=["leaf", "n"])

    counts = np.zeros(total, np.int64)
    for r in vectors.select("v").mapInArrow(run, "leaf long, n long").groupBy("leaf").agg(F.sum("n").alias("n")).collect():
        counts[r.leaf] = r.n
    return counts


def _matrix(column: pa.Array, dims: int, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, dims).astype(np.float64)


_DEALT = "grp long, kind int, a long, b long, leaf int, v binary, probed binary"


def _dealt_rows(vectors: DataFrame, forest: Forest, cells: Cells, dtype: str) -> DataFrame:
    """Every row once in every tree, with its group (a cell's piece) and leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            leaf = forest.leaf_of(_matrix(b.column(1), forest.dims, dtype))
            n = len(ids)
            turn = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            for t in range(forest.trees):
                cell = cells.of_leaf[leaf[:, t]]
                piece = (turn % np.array(cells.pieces, np.uint64)[cell]).astype(np.int64)
                yield pa.record_batch([pa.array(cells.first[cell] + piece), pa.array(np.zeros(n, np.int32)), b.column(0),
                                       pa.array(np.zeros(n, np.int64)), pa.array(leaf[:, t].astype(np.int32)), b.column(1),
                                       pa.nulls(n, pa.binary())], schema=_arrow(b))

    return vectors.select("id", "v").mapInArrow(run, _DEALT)


def _arrow(_: object = None) -> pa.Schema:
    return pa.schema([("grp", pa.int64()), ("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("leaf", pa.int32()),
                      ("v", pa.binary()), ("probed", pa.binary())])


def _dealt_queries(queries: DataFrame, forest: Forest, cells: Cells, probes: int, dtype: str) -> DataFrame:
    """Every distinct query vector once for every group that holds leaves it probes, with those leaves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for s in range(0, whole.num_rows, _CHUNK):
                b = whole.slice(s, _CHUNK)
                h1, h2, vs = (b.column(c).to_pylist() for c in range(3))
                margins = forest.margins(_matrix(b.column(2), forest.dims, dtype))
                out = [[], [], [], [], []]
                for k in range(b.num_rows):
                    leaves = np.sort(np.array(forest.probe(margins[k].tolist(), probes), np.int32))
                    cell = cells.of_leaf[leaves]
                    cuts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1], True])
                    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                        own = leaves[lo:hi].tobytes()
                        for g in range(cells.first[cell[lo]], cells.first[cell[lo] + 1]):
                            for to, value in zip(out, (g, h1[k], h2[k], vs[k], own), strict=True):
                                to.append(value)
                n = len(out[0])
                yield pa.record_batch([pa.array(out[0], pa.int64()), pa.array(np.ones(n, np.int32)), pa.array(out[1], pa.int64()),
                                       pa.array(out[2], pa.int64()), pa.nulls(n, pa.int32()), pa.array(out[3], pa.binary()),
                                       pa.array(out[4], pa.binary())], schema=_arrow())

    return queries.select("h1", "h2", "v").mapInArrow(run, _DEALT)


class _Cell:
    """The rows of one group, held while its queries stream by."""

    def __init__(self, ids: list, leaves: list, vectors: list, dims: int, dtype: str):
        ids, leaves = np.array(ids, np.int64), np.array(leaves, np.int64)
        x = np.frombuffer(b"".join(vectors), dtype).reshape(-1, dims).astype(np.float64)
        _, one = np.unique(np.array([xxhash.xxh3_64_intdigest(v, i & (1 << 64) - 1) for i, v in zip(ids.tolist(), vectors, strict=True)],
                                    np.uint64), return_index=True)  # equal rows count once
        order = one[np.argsort(leaves[one], kind="stable")]
        self.ids, self.leaves, self.x = ids[order], leaves[order], x[order]

    def nearest(self, q: np.ndarray, probed: list[np.ndarray], k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per query its best candidates: (query, ids, exact distances)."""
        wanted = np.unique(np.concatenate(probed))
        rows = np.flatnonzero(np.isin(self.leaves, wanted))
        if not len(rows):
            return
        x, ids = self.x[rows], self.ids[rows]
        at = np.searchsorted(wanted, self.leaves[rows])
        far = squared(q, x)
        slack = 1e-9 * ((q * q).sum(1) + (x * x).sum(1).max())
        for i in range(len(q)):
            own = np.zeros(len(wanted), bool)
            own[np.searchsorted(wanted, probed[i])] = True
            candidates = np.flatnonzero(own[at])
            d = far[i, candidates]
            if len(d) > k:
                candidates = candidates[d <= np.partition(d, k - 1)[k - 1] + slack[i]]
            if len(candidates):
                exact = np.sqrt(((x[candidates] - q[i]) ** 2).sum(1))
                best = np.lexsort((ids[candidates], exact))[:k]
                yield i, ids[candidates][best], exact[best]


def _ranked_in_cells(dealt: DataFrame, dims: int, dtype: str, k: int) -> DataFrame:
    """``(h1, h2, vec_id, score)``: each query's best of every group. Rows come first in a group, queries after."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["h1", "h2", "vec_id", "score"]
        group, held, cell = None, ([], [], []), None
        for whole in batches:
            for s in range(0, whole.num_rows, _CHUNK):
                b = whole.slice(s, _CHUNK)
                grp, kind, a, b_, leaf, v, probed = (b.column(c).to_pylist() for c in range(7))
                edges = [0, *[r for r in range(1, len(grp)) if (grp[r], kind[r]) != (grp[r - 1], kind[r - 1])], len(grp)]
                for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                    if grp[lo] != group:
                        group, held, cell = grp[lo], ([], [], []), None
                    if kind[lo] == 0:
                        for to, values in zip(held, (a, leaf, v), strict=True):
                            to.extend(values[lo:hi])
                        continue
                    if not held[0] and cell is None:
                        continue  # a group of leaves without rows
                    if cell is None:
                        cell, held = _Cell(*held, dims, dtype), ([], [], [])
                    q = np.frombuffer(b"".join(v[lo:hi]), dtype).reshape(-1, dims).astype(np.float64)
                    found = list(cell.nearest(q, [np.frombuffer(p, np.int32) for p in probed[lo:hi]], k))
                    if found:
                        n = [len(f[1]) for f in found]
                        yield pa.record_batch([
                            pa.array(np.repeat([a[lo + f[0]] for f in found], n), pa.int64()),
                            pa.array(np.repeat([b_[lo + f[0]] for f in found], n), pa.int64()),
                            pa.array(np.concatenate([f[1] for f in found])), pa.array(np.concatenate([f[2] for f in found]))], names=names)

    return dealt.mapInArrow(run, "h1 long, h2 long, vec_id long, score double")


def nearest(spark: SparkSession, rows: DataFrame, queries: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding",
            k: int = 10, trees: int = TREES, sample: int = SAMPLE, leaf: int = LEAF, cell: int | None = None,
            recall: float = RECALL, probes: int | None = None, seed: int = SEED) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: of every row of ``queries`` its ``k`` nearest found among ``rows``.

    ``probes`` leaves are searched for a query; without it as many as find ``recall`` in the sample.
    ``cell`` bounds a cell's rows.
    """
    bounded_batches(spark)
    dtype = _dtype(rows, vec_col)
    fitted = sample_of(rows, id_col, vec_col, sample, dtype)
    if not fitted.size:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    forest = Forest(fitted, trees, leaf, seed)
    probes = probes or forest.probes_for(fitted, k, recall)
    vectors = _vector_rows(rows, id_col, vec_col, forest.dims, dtype)
    asked = written(spark, _vector_rows(queries, id_col, vec_col, forest.dims, dtype), "ann-queries")
    cells = Cells(_leaf_counts(vectors, forest, dtype), forest.leaves, cell or max(1, CELL_BYTES // (8 * forest.dims)))

    distinct = asked.groupBy("h1", "h2").agg(F.first("v").alias("v"))
    dealt = _dealt_rows(vectors, forest, cells, dtype).union(_dealt_queries(distinct, forest, cells, probes, dtype))
    tasks = max(1, min(cells.groups, 16 * shuffle_width(spark)))
    dealt = dealt.repartitionById(tasks, (F.col("grp") % tasks).cast("int")).sortWithinPartitions("grp", "kind")
    # one more than k: a query's own row is among them
    best = _ranked_in_cells(dealt, forest.dims, dtype, k + 1)
    best = best.groupBy("h1", "h2", "vec_id", "score").agg(F.lit(1).alias("one")).drop("one")
    order = Window.partitionBy("h1", "h2").orderBy("score", "vec_id")
    best = written(spark, best.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1).drop("r"), "ann-found")
    own = asked.select(F.col("id").alias("query_id"), "h1", "h2")
    pairs = own.join(best, ["h1", "h2"]).where("query_id <> vec_id").select("query_id", "vec_id", "score").distinct()
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
