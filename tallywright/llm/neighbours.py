"""Approximate nearest neighbours: low-dimensional stable projections in a kd-tree, verified until a chi-square test stops.

Vectors are scaled to length one, where nearness by cosine is nearness by distance, and projected to `DIMS` dimensions by Gaussian
(2-stable) directions: for a pair at squared distance d, the squared distance of its projections is d times a chi-square variable with
`DIMS` degrees of freedom. A query takes vectors in the order of their projected distance, as far as boxes of a kd-tree tell it, and verifies
them in full. Once what is left lies farther than `q * d_k` (d_k: squared distance of the k-th best so far, q: the chi-square
quantile), a vector nearer than the k-th best would have landed nearer with probability `CONFIDENCE`: the search stops.

The upper part of the tree are cells of the projected space, fitted on a bounded sample (`SAMPLE_ROWS` rows by a hash of their id); every row is
dealt to its cell, and a cell of many rows to blocks by a hash of the id. A query first searches its own cell; the k-th best of all its blocks is
the bound with which it then visits only the other cells whose boxes, of all rows in them, pass the test. In a block the lower
part of the tree gives leaves in order of distance, and only those vectors of a leaf are verified whose own projection passes. `search` reports how
many were.

Defined cases: null, zero or non-finite vectors take no part; vectors of another length are searched among themselves; repeated rows of the same id and
vector are one; an id with several vectors is a query and a candidate with each, but never a candidate of its own id; equal vectors score the
same and are taken by smaller id (a block needs only the k + 1 smallest ids of each); fewer candidates than k give fewer rows; without
queries or candidates there are no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallywright.llm.common import cut, query, read

DIMS = 12
#: probability that the stopping test does not lose a true neighbour
CONFIDENCE = 0.99
LEAF = 128
#: vectors of one block and queries answered together
BLOCK_ROWS, QUERY_ROWS = 4_096, 8_192
#: rows on which the cells are fitted, and of them in one cell
SAMPLE_ROWS, CELL_SAMPLE = 20_000, 64
#: cells of one vector length are numbered below this
CELLS = 1 << 20


@lru_cache
def chi_square_quantile(p: float, df: int) -> float:
    """Inverse of the chi-square distribution for even degrees of freedom, by bisection on its closed form."""
    def cdf(x):
        term, total = 1.0, 0.0
        for i in range(df // 2):
            total += term
            term *= x / 2 / (i + 1)
        return 1 - np.exp(-x / 2) * total
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if cdf(mid) < p else (low, mid)
    return high


def directions(width: int, dims: int) -> np.ndarray:
    return np.random.default_rng(20240501).standard_normal((width, dims))


class KdTree:
    """Leaves of at most LEAF points, each with the box of its points."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.leaves: list[np.ndarray] = []
        stack = [np.arange(len(points))]
        while stack:
            at = stack.pop()
            spread = np.ptp(points[at], axis=0) if len(at) else np.zeros(1)
            if len(at) <= leaf or spread.max() == 0:
                self.leaves.append(at)
                continue
            axis = int(spread.argmax())
            half = len(at) // 2
            order = np.argpartition(points[at, axis], half)
            stack += [at[order[:half]], at[order[half:]]]
        self.low = np.stack([points[at].min(0) for at in self.leaves])
        self.high = np.stack([points[at].max(0) for at in self.leaves])

    def distances(self, q: np.ndarray) -> np.ndarray:
        """(queries, leaves) squared distances of the queries to the boxes."""
        out = np.zeros((len(q), len(self.leaves)))
        for d in range(q.shape[1]):
            gap = np.maximum(np.maximum(self.low[None, :, d] - q[:, None, d], q[:, None, d] - self.high[None, :, d]), 0)
            out += gap * gap
        return out


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Pairwise cosines of the rows of a and b in double precision."""
    return (a @ b.T) / np.sqrt((a * a).sum(1))[:, None] / np.sqrt((b * b).sum(1))[None, :]


def exact_cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise cosines; the same pair gives the same bits wherever it is computed."""
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; powers of two first tame huge and tiny components."""
    x = scaled(x)
    return x / np.sqrt((x * x).sum(1))[:, None]


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two, which keep every cosine exactly."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None])


def search_block(ids: np.ndarray, vectors: np.ndarray, points: np.ndarray, q_ids: np.ndarray, q_vectors: np.ndarray, q_points: np.ndarray, bounds: np.ndarray,
                 k: int, stop: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(queries, k) rows of the block nearest to each query, by score, then id, -1 where there are fewer; their scores; rows verified.

    bounds: the k-th best score that each query has from elsewhere. stop: the chi-square quantile.
    """
    tree = KdTree(points)
    gaps = tree.distances(q_points)
    order = np.argsort(gaps, axis=1, kind="stable")
    best = np.full((len(q_ids), k), -1, np.int64)
    score = np.full((len(q_ids), k), -np.inf)
    verified = np.zeros(len(q_ids), np.int64)
    active = np.arange(len(q_ids))
    reach = lambda rows: stop * np.maximum(2 - 2 * np.maximum(score[rows, -1], bounds[rows]), 1e-12)
    for step in range(len(tree.leaves)):
        leaf = order[active, step]
        go = gaps[active, leaf] <= reach(active)
        active, leaf = active[go], leaf[go]
        if not len(active):
            break
        by = np.argsort(leaf, kind="stable")
        for group in np.split(by, np.flatnonzero(np.diff(leaf[by])) + 1):
            rows, members = active[group], tree.leaves[leaf[group[0]]]
            apart = ((q_points[rows] ** 2).sum(1)[:, None] + (points[members] ** 2).sum(1)[None, :] - 2 * q_points[rows] @ points[members].T)
            near = (apart <= reach(rows)[:, None] + 1e-9) & (q_ids[rows][:, None] != ids[members][None, :])
            verified[rows] += near.sum(1)
            some = near.any(0)
            members, near = members[some], near[:, some]
            if not len(members):
                continue
            got = np.where(near, cosines(q_vectors[rows], vectors[members]), -np.inf)
            at = np.concatenate([best[rows], np.broadcast_to(members, got.shape)], 1)
            value = np.concatenate([score[rows], got], 1)
            names = np.where(at >= 0, ids[at], np.iinfo(np.int64).max)
            pick = np.lexsort((names, -np.round(value, 12)), axis=1)[:, :k]
            best[rows], score[rows] = np.take_along_axis(at, pick, 1), np.take_along_axis(value, pick, 1)
    best[score == -np.inf] = -1
    return best, score, verified


class Cells:
    """Splits of the projected space, fitted on sample points: at most CELL_SAMPLE of them in a cell."""

    def __init__(self, points: np.ndarray):
        self.splits: list[tuple[int, float, int, int]] = []
        self.count = 0
        self._split(points)

    def _split(self, points: np.ndarray) -> int:
        """The number of the node: splits from 0 on, cells below 0."""
        spread = np.ptp(points, axis=0) if len(points) else np.zeros(1)
        axis = int(spread.argmax())
        middle = float(np.median(points[:, axis])) if len(points) > CELL_SAMPLE else 0.0
        if len(points) <= CELL_SAMPLE or not (points[:, axis] < middle).any():
            self.count += 1
            return -self.count
        here = len(self.splits)
        self.splits.append((axis, middle, 0, 0))
        below = points[:, axis] < middle
        self.splits[here] = (axis, middle, self._split(points[below]), self._split(points[~below]))
        return here

    def of(self, points: np.ndarray) -> np.ndarray:
        node = np.full(len(points), 0 if self.splits else -1)
        while (inner := np.flatnonzero(node >= 0)).size:
            axis, middle, left, right = (np.array(x) for x in zip(*self.splits, strict=True))
            at = node[inner]
            node[inner] = np.where(points[inner, axis[at]] < middle[at], left[at], right[at])
        return -node - 1


def smallest_copies(ids: np.ndarray, vectors: np.ndarray, keep: int) -> np.ndarray:
    """Rows without those copies of a vector beyond the `keep` smallest ids: no other can be among the nearest."""
    if not len(ids):
        return np.zeros(0, np.int64)
    order = np.lexsort((ids, *vectors.T[::-1]))
    new = np.ones(len(order), bool)
    new[1:] = (vectors[order[1:]] != vectors[order[:-1]]).any(1)
    start = np.flatnonzero(new)
    nth = np.arange(len(order)) - np.repeat(start, np.diff(np.append(start, len(order))))
    return np.sort(order[nth < keep])


def usable(table: DataFrame, id_column: str, vector: str) -> DataFrame:
    """id, v (array<double>) of vectors that take part."""
    rows = table.select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("v").isNotNull() & F.col("id").isNotNull() & (F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0))


def placed(rows: DataFrame, dims: int, cells: dict[int, Cells] | None = None) -> DataFrame:
    """id, v, width, p (projection), cell of rows (id, v); without cells all rows of a width are in one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            width = pdf["v"].map(len).to_numpy()
            for w in np.unique(width).tolist():
                part = pdf[width == w]
                points = unit(np.stack(part["v"].to_list())) @ directions(w, dims)
                cell = cells[w].of(points) if cells and w in cells else np.zeros(len(part), np.int64)
                yield part.assign(width=w, p=list(points), cell=w * CELLS + cell)

    return rows.select("id", "v").mapInPandas(run, "id long, v array<double>, width int, p array<double>, cell long")


def fitted_cells(rows: DataFrame, dims: int) -> dict[int, Cells]:
    """Cells of each vector length, from about SAMPLE_ROWS rows in all."""
    share = min(1.0, SAMPLE_ROWS / max(1, rows.count()))
    chosen = rows.where(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = placed(chosen, dims).select("width", "p").toPandas()
    return {int(w): Cells(np.stack(part["p"].to_list())) for w, part in sample.groupby("width")}


def _asked(found: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The queries with the k-th best score found so far."""
    nth = W.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    kth = found.where("vec_id IS NOT NULL").withColumn("rank", F.row_number().over(nth)).where(F.col("rank") == k).select("query", F.col("score").alias("bound"))
    return queries.join(kth, "query", "left").withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))


def _visits(asked: DataFrame, boxes: pd.DataFrame, stop: float) -> DataFrame:
    """Each query with every other cell whose box passes the test."""
    cell, width = boxes["cell"].to_numpy(), boxes["width"].to_numpy()
    low, high = (np.stack(boxes[c].to_list()) if len(boxes) else np.zeros((0, 1)) for c in ("low", "high"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for begin in range(0, len(pdf), 256):
                part = pdf.iloc[begin : begin + 256]
                points = np.stack(part["p"].to_list())
                gap = np.maximum(np.maximum(low[None] - points[:, None], points[:, None] - high[None]), 0)
                reach = stop * np.maximum(2 - 2 * part["bound"].to_numpy(), 1e-12)
                go = ((gap * gap).sum(2) <= reach[:, None] + 1e-9) & (width[None] == part["width"].to_numpy()[:, None]) & (cell[None] != part["cell"].to_numpy()[:, None])
                row, at = np.nonzero(go)
                yield part.iloc[row].assign(cell=cell[at])

    return asked.mapInPandas(run, asked.schema)


def _searched(visits: DataFrame, rows: DataFrame, sizes: DataFrame, k: int, stop: float, block_rows: int, query_rows: int) -> DataFrame:
    """query, query_id, vec_id, score, verified: the best of each block, and one row without vec_id with the number of rows verified."""
    load = visits.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / query_rows).cast("int").alias("batches"))
    load = cut(sizes.select("cell", F.ceil(F.col("n") / block_rows).cast("long").alias("blocks")).join(load, "cell"))
    # the stated queries against the rows of a cell, in blocks: a block meets each batch of queries once
    left = rows.join(load, "cell").select("cell", F.pmod(F.xxhash64("id"), F.col("blocks")).alias("block"), "id", "v", "p", F.explode(F.sequence(F.lit(0), F.col("batches") - 1)).alias("batch"))
    right = visits.join(load, "cell").select("cell", F.pmod("query", F.col("batches")).cast("int").alias("batch"), "query", "id", "v", "p", "bound", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))

    def search(mine: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(mine) or not len(asked):
            return pd.DataFrame({"query": [], "query_id": [], "vec_id": [], "score": [], "verified": []}, dtype=float)
        mine = mine.iloc[smallest_copies(mine["id"].to_numpy(), np.stack(mine["v"].to_list()), k + 1)]
        ids, q_ids, query = mine["id"].to_numpy(), asked["id"].to_numpy(), asked["query"].to_numpy()
        vectors, q_vectors = scaled(np.stack(mine["v"].to_list())), scaled(np.stack(asked["v"].to_list()))
        best, _, verified = search_block(ids, vectors, np.stack(mine["p"].to_list()), q_ids, q_vectors, np.stack(asked["p"].to_list()), asked["bound"].to_numpy(), k, stop)
        at, nth = np.nonzero(best >= 0)
        found = best[at, nth]
        hits = pd.DataFrame({"query": query[at], "query_id": q_ids[at], "vec_id": pd.array(ids[found], "Int64"), "score": exact_cosine(q_vectors[at], vectors[found]), "verified": 0})
        counts = pd.DataFrame({"query": query, "query_id": q_ids, "vec_id": pd.array([None] * len(query), "Int64"), "score": np.nan, "verified": verified})
        return pd.concat([hits, counts])

    keys = ["cell", "block", "batch"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        search, "query long, query_id long, vec_id long, score double, verified long")


def search(queries: DataFrame, rows: DataFrame, k: int = 5, dims: int = DIMS, confidence: float = CONFIDENCE, block_rows: int = BLOCK_ROWS,
           query_rows: int = QUERY_ROWS) -> DataFrame:
    """query, query_id, vec_id, score, verified: candidates for the k nearest, and for every visit of a block how many rows were verified."""
    rows = rows.dropDuplicates(["id", "v"])
    rows = cut(placed(rows, dims, fitted_cells(rows, dims)))
    ends = [f(F.col("p")[d]) for f in (F.min, F.max) for d in range(dims)]
    sizes = cut(rows.groupBy("cell").agg(F.first("width").alias("width"), F.count(F.lit(1)).alias("n"), F.array(*ends[:dims]).alias("low"), F.array(*ends[dims:]).alias("high")))
    boxes = sizes.select("cell", "width", "low", "high").toPandas()
    stop = chi_square_quantile(confidence, dims)
    asked = cut(rows.join(queries.select("id").distinct(), "id", "left_semi").withColumn("query", F.xxhash64("id", "v")))
    home = cut(_searched(asked.withColumn("bound", F.lit(float("-inf"))), rows, sizes, k, stop, block_rows, query_rows))
    visits = cut(_visits(_asked(home, asked, k), boxes, stop))
    return home.unionByName(_searched(visits, rows, sizes, k, stop, block_rows, query_rows))


def nearest(queries: DataFrame, rows: DataFrame, k: int = 5, dims: int = DIMS, confidence: float = CONFIDENCE, block_rows: int = BLOCK_ROWS,
            query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score. queries and rows: id, v; queries are rows too. A query never finds a row of its own id."""
    found = search(queries, rows, k, dims, confidence, block_rows, query_rows).where("vec_id IS NOT NULL")
    best = W.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


@query("op10_projected_neighbours")
def projected_neighbours(spark, sf_dir):
    rows = cut(usable(read(spark, sf_dir, "embeddings"), "vec_id", "embedding"))
    return nearest(rows.where(F.col("id") % 50 == 0), rows)
