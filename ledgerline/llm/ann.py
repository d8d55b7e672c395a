"""Nearest neighbours by inner product: low-dimensional stable projections indexed by kd-trees.

Vectors get one more component that makes all norms equal, so the largest inner product is the smallest
Euclidean distance. ``PROJECTIONS`` Gaussian (2-stable) projections keep distances up to a chi-square
factor: projected distance squared / distance squared follows chi-square with ``PROJECTIONS`` degrees. A
query goes through kd-tree leaves in order of projected distance and verifies their vectors, until the
test says that with probability ``confidence`` no nearer vector is left: chi2_cdf(next leaf's projected
distance squared / distance squared of the k-th best) >= confidence.

The upper kd-tree, fitted on a bounded sample, deals vectors to cells (one task's work each); every cell
has its own lower tree. A query first searches its home cell, then those cells that its k-th best
distance cannot rule out by the same test.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import cut

PROJECTIONS = 8
CONFIDENCE = 0.97
CELL_ROWS = 4_096
SAMPLE_ROWS = 65_536
LEAF_ROWS = 256
LEAVES_AT_ONCE = 8


def chi2_cdf(x: float, degrees: int) -> float:
    """For an even number of degrees: 1 - exp(-x/2) * sum of (x/2)^i / i!."""
    term = total = 1.0
    for i in range(1, degrees // 2):
        term *= x / 2 / i
        total += term
    return 1 - math.exp(-x / 2) * total


def chi2_quantile(p: float, degrees: int) -> float:
    low, high = 0.0, 1.0
    while chi2_cdf(high, degrees) < p:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_cdf(middle, degrees) < p else (low, middle)
    return high


def split(points: np.ndarray, leaf_rows: int, least: int = 1) -> tuple[list[np.ndarray], list[tuple]]:
    """kd-tree by medians of the widest dimension: leaves (row indices) and nodes (dimension, value, left, right).

    A negative child -1 - i is leaf i. Points that cannot be split (all equal) stay one leaf.
    """
    leaves: list[np.ndarray] = []
    nodes: list[tuple] = []

    def grow(rows: np.ndarray) -> int:
        if len(rows) > max(leaf_rows, least):
            own = points[rows]
            dim = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
            value = float(np.median(own[:, dim]))
            low = own[:, dim] < value
            if not low.any():
                low = own[:, dim] <= value
            if low.any() and not low.all():
                at = len(nodes)
                nodes.append(())
                nodes[at] = (dim, value, bool((own[low][:, dim] < value).all()), grow(rows[low]), grow(rows[~low]))
                return at
        leaves.append(rows)
        return -len(leaves)

    grow(np.arange(len(points)))
    return leaves, nodes


class Cells:
    """The upper tree: which cell a projected point lies in, and how far it is from each cell's region."""

    def __init__(self, points: np.ndarray, n_cells: int):
        leaves, self.nodes = split(points, max(1, -(-len(points) // max(1, n_cells))))
        dims = points.shape[1]
        self.low, self.high = np.full((len(leaves), dims), -np.inf), np.full((len(leaves), dims), np.inf)
        if self.nodes:
            self._bound(0, np.full(dims, -np.inf), np.full(dims, np.inf))

    def _bound(self, node: int, low: np.ndarray, high: np.ndarray) -> None:
        if node < 0:
            self.low[-node - 1], self.high[-node - 1] = low, high
            return
        dim, value, _, left, right = self.nodes[node]
        below, above = high.copy(), low.copy()
        below[dim] = above[dim] = value
        self._bound(left, low, below)
        self._bound(right, above, high)

    def cell_of(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), dtype=np.int32)
        todo = [(0, np.arange(len(points)))] if self.nodes else []
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = -node - 1
            elif len(rows):
                dim, value, strict, left, right = self.nodes[node]
                low = points[rows, dim] < value if strict else points[rows, dim] <= value
                todo += [(left, rows[low]), (right, rows[~low])]
        return out

    def distances(self, point: np.ndarray) -> np.ndarray:
        """Squared projected distance to every cell's region."""
        return (np.maximum(np.maximum(self.low - point, point - self.high), 0) ** 2).sum(axis=1)


def _matrix(column) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(lists)
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 0))


def _lift(vectors: np.ndarray, longest: float) -> np.ndarray:
    """The component that brings every norm to ``longest``."""
    return np.sqrt(np.maximum(longest - (vectors ** 2).sum(axis=1), 0))


def _to_cells(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions, longest, cells = shared.value
        for b in batches:
            v = _matrix(b.column("v"))
            p = np.hstack([v, _lift(v, longest)[:, None]]) @ directions if len(v) else np.zeros((0, directions.shape[1]))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cells.cell_of(p), pa.int32())], names=[*b.schema.names, "cell"])

    return run


def _home_cell(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions, _, cells = shared.value
        for b in batches:
            v = _matrix(b.column("v"))
            p = v @ directions[:-1] if len(v) else np.zeros((0, directions.shape[1]))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(v), -1.0)), pa.array(cells.cell_of(p), pa.int32())],
                                             names=[*b.schema.names, "reach", "cell"])

    return run


def _other_cells(shared, limit: float):
    """mapInArrow: (qid, v, home, kth) -> a row for every other cell that the k-th best distance does not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions, _, cells = shared.value
        for b in batches:
            v = _matrix(b.column("v"))
            homes, kth = b.column("home").to_numpy(), b.column("kth").to_numpy()
            for i in range(len(v)):
                open_ = cells.distances(v[i] @ directions[:-1]) < limit * kth[i]
                open_[homes[i]] = False
                some = np.flatnonzero(open_).astype(np.int32)
                if len(some):
                    yield pa.RecordBatch.from_arrays(
                        [b.column("qid").slice(i, 1).take(pa.array(np.zeros(len(some), np.int32))),
                         b.column("v").slice(i, 1).take(pa.array(np.zeros(len(some), np.int32))),
                         pa.array(np.full(len(some), kth[i])), pa.array(some)], names=["qid", "v", "reach", "cell"])

    return run


class Cell:
    """The vectors of one cell under a lower kd-tree."""

    def __init__(self, vectors: np.ndarray, ids: list[list[int]], directions: np.ndarray, longest: float):
        projected = np.hstack([vectors, _lift(vectors, longest)[:, None]]) @ directions
        leaves, _ = split(projected, LEAF_ROWS)
        order = np.concatenate(leaves)
        self.start = np.cumsum([0, *map(len, leaves)])
        self.low = np.array([projected[r].min(axis=0) for r in leaves])
        self.high = np.array([projected[r].max(axis=0) for r in leaves])
        self.vectors, self.ids = vectors[order], [ids[i] for i in order]
        self.first_id = np.array([x[0] for x in self.ids], dtype=np.int64)
        self.n_ids = np.array([len(x) for x in self.ids])
        self.directions, self.longest = directions, longest

    def search(self, q: np.ndarray, k: int, limit: float, reach: float) -> tuple[list[tuple[float, int]], float]:
        """The k best (score, id) found, nearest first, and the distance squared of the last (infinite if fewer).

        ``reach``: the query's k-th best distance squared elsewhere, or negative.
        """
        gap = np.maximum(np.maximum(self.low - q @ self.directions[:-1], q @ self.directions[:-1] - self.high), 0)
        near = (gap ** 2).sum(axis=1)
        order = np.argsort(near, kind="stable")
        length, best, best_rows = float(q @ q) + self.longest, np.zeros(0), np.zeros(0, np.int64)
        bound = reach if reach >= 0 else math.inf
        kth = math.inf
        tolerance = 1e-9 * math.sqrt(float(q @ q) * self.longest)
        for i in range(0, len(order), LEAVES_AT_ONCE):
            if near[order[i]] >= limit * bound:
                break
            rows = np.concatenate([np.arange(self.start[x], self.start[x + 1]) for x in order[i:i + LEAVES_AT_ONCE]])
            scores = np.concatenate([best, self.vectors[rows] @ q])
            rows = np.concatenate([best_rows, rows])
            if len(rows) > k:
                # Equal scores may differ by rounding in a matrix product: keep all that could be among the k.
                edge = np.partition(scores, len(scores) - k)[len(scores) - k]
                keep = scores >= edge - tolerance
                scores, rows = scores[keep], rows[keep]
                if len(rows) > 4 * k:  # by the scores that also decide at the end
                    keep = np.lexsort((self.first_id[rows], -(self.vectors[rows] * q).sum(axis=1)))[:4 * k]
                    scores, rows = scores[keep], rows[keep]
            best, best_rows = scores, rows
            ordered = np.argsort(-best)
            enough = np.searchsorted(np.cumsum(self.n_ids[best_rows[ordered]]), k)
            if enough < len(ordered):
                kth = max(0.0, length - 2 * float(best[ordered[enough]]))
                bound = min(bound, kth)
        exact = (self.vectors[best_rows] * q).sum(axis=1)
        found = sorted((-float(s), i) for s, r in zip(exact, best_rows) for i in self.ids[r])[:k]
        return [(-s, i) for s, i in found], kth


def _search_cell(shared, k: int, limit: float):
    """cogroup applyInArrow: a cell's vectors and the queries that visit it -> (qid, home, kth, ids, scores)."""

    def run(data: pa.Table, queries: pa.Table) -> pa.Table:
        directions, longest, _ = shared.value
        out = []
        if len(data) and len(queries):
            cell = Cell(_matrix(data.column("v")), data.column("ids").to_pylist(), directions, longest)
            vectors = _matrix(queries.column("v"))
            for qid, q, reach in zip(queries.column("qid").to_pylist(), vectors, queries.column("reach").to_pylist()):
                found, kth = cell.search(q, k, limit, reach)
                out.append((qid, kth, [i for _, i in found], [s for s, _ in found]))
        elif len(queries):
            out = [(qid, math.inf, [], []) for qid in queries.column("qid").to_pylist()]
        home = queries.column("cell")[0].as_py() if len(queries) else 0
        return pa.table({"qid": pa.array([x[0] for x in out], pa.int64()), "home": pa.array([home] * len(out), pa.int32()),
                         "kth": pa.array([x[1] for x in out], pa.float64()), "found": pa.array([x[2] for x in out], pa.list_(pa.int64())),
                         "scores": pa.array([x[3] for x in out], pa.list_(pa.float64()))})

    return run


_FOUND = "qid long, home int, kth double, found array<long>, scores array<double>"


def nearest(df: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
            confidence: float = CONFIDENCE, cell_rows: int = CELL_ROWS, seed: int = 10) -> DataFrame:
    """For every row where ``is_query`` (a Column over ``id``) holds, its ``k`` nearest other rows by inner product.

    Returns query_id, rank (from 1), vec_id, score: the inner product in double precision, nearest
    first, ties to the smaller id. Approximate: a true neighbour is missed with probability
    ``1 - confidence`` at most. Null ids and vectors that are null, empty, zero or hold null or
    non-finite components take no part, nor do those of another length than most (the shorter, if
    undecided). Rows that share an id count once (the least vector). Equal vectors are indexed once with
    their k + 1 smallest ids, which is all that can be among k nearest, so a vector repeated in a third of the rows
    is one point. Other columns are not read. An empty frame gives an empty frame.
    """
    spark = df.sparkSession
    rows = (df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
            .filter(F.col("id").isNotNull() & F.col("v").isNotNull())
            .filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
                    & F.exists("v", lambda x: x != 0)))
    sizes = sorted(rows.groupBy(F.size("v").alias("d")).count().collect(), key=lambda r: (-r["count"], r["d"]))
    schema = "query_id long, rank int, vec_id long, score double"
    if not sizes:
        return spark.createDataFrame([], schema)
    dim = sizes[0]["d"]
    rows = cut(rows.filter(F.size("v") == dim).groupBy("id").agg(F.min("v").alias("v")))
    by_vector = Window.partitionBy("v").orderBy("id")
    points = (rows.withColumn("place", F.row_number().over(by_vector)).filter(F.col("place") <= k + 1)
              .groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")))  # k + 1 ids at most
    asked = rows.filter(is_query(F.col("id")))
    queries = cut(asked.groupBy("v").agg(F.min("id").alias("qid")))

    n, longest = rows.agg(F.count("*"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).first()
    rng = np.random.default_rng(seed)
    directions = rng.standard_normal((dim + 1, PROJECTIONS))
    sample = np.array([r["v"] for r in rows.select("v").orderBy(F.xxhash64("v"), "id").limit(min(SAMPLE_ROWS, max(1, 64_000_000 // (8 * dim) // 4))).collect()])
    cells = Cells(np.hstack([sample, _lift(sample, longest)[:, None]]) @ directions, -(-n // cell_rows))
    shared = spark.sparkContext.broadcast((directions, longest, cells))
    limit = chi2_quantile(confidence, PROJECTIONS)

    placed = cut(points.mapInArrow(_to_cells(shared), "v array<double>, ids array<long>, cell int"))
    first = cut(placed.groupBy("cell").cogroup(
        queries.mapInArrow(_home_cell(shared), "v array<double>, qid long, reach double, cell int").groupBy("cell"))
        .applyInArrow(_search_cell(shared, k + 1, limit), _FOUND))
    visits = queries.join(first.select("qid", "home", "kth"), "qid").select("qid", "v", "home", "kth").mapInArrow(
        _other_cells(shared, limit), "qid long, v array<double>, reach double, cell int")
    more = placed.groupBy("cell").cogroup(visits.groupBy("cell")).applyInArrow(_search_cell(shared, k + 1, limit), _FOUND)
    found = first.union(more).select("qid", F.explode(F.arrays_zip("found", "scores")).alias("x")).select("qid", "x.found", "x.scores")
    best = Window.partitionBy("qid").orderBy(F.desc("scores"), "found")
    merged = found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1)

    own = asked.join(queries, "v").select(F.col("id").alias("query_id"), "qid")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("scores"), "found")
    return (own.join(merged, "qid").filter("query_id != found").withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
            .select("query_id", "rank", F.col("found").alias("vec_id"), F.col("scores").alias("score")))
