"""Nearest neighbours by inner product with a vantage-point tree for each shard.

Every vector gets one more coordinate so that all vectors of a shard have the same length; then the
largest inner product is the smallest Euclidean distance, which is a metric.  A tree splits its vectors
at the median distance from a vantage point and remembers the interval of distances of each half.  A
search visits the nearer half first and leaves out a half whose interval is, by the triangle inequality,
farther away than the k-th result so far.  ``factor`` stretches that bound: one restores exact search,
more prunes earlier.

The index is a table with one serialised tree for each shard of at most ``SHARD_ROWS`` distinct vectors;
every vector with a valid embedding is in it.  Queries are searched in blocks against every shard (a
stated query set against all rows); a cell of one shard and one block is one task's group, both of bounded
size.  Each cell keeps the k best of each query, and the cells of a query are merged by a top-k window
that prunes before its shuffle.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite component take no part.
Vectors of different lengths are never compared.  Rows with the same id are the same row: one of the
vectors is used.  Equal vectors of one shard are one point with a list of ids, so thousands of copies do
not slow a search, and the smallest ids come first.  Equal scores go to the smaller id, also at the k-th place.  An empty table
gives no rows.
"""

from __future__ import annotations

import io
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from martlet.llm.common import keep

K = 20
QUERY_EVERY = 20
FACTOR = 4.0
SHARD_ROWS = 16384
BLOCK_ROWS = 8192
LEAF = 256
_SLACK = 1e-12  # of a score, as a share of both lengths: more than sums of any order differ
_REACH = 1e-6  # of a distance, as a share of the length: the root of what sums differ
_PAIRS = 1 << 16


# ------------------------------------------------------------------ one tree


@dataclass
class Tree:
    """Points in tree order; node n covers points[start[n]:stop[n]] and has its vantage point at start[n]."""

    points: np.ndarray  # distinct vectors
    lift: np.ndarray  # the additional coordinate
    ids: np.ndarray  # ids of all rows, by point, ascending within a point
    ends: np.ndarray  # where the ids of each point end
    start: np.ndarray
    stop: np.ndarray
    left: np.ndarray  # child nodes, -1 for a leaf
    right: np.ndarray
    spans: np.ndarray  # (low, high) distance from the vantage point of the left and the right child
    norm: float

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{k: np.asarray(v) for k, v in vars(self).items()})
        return out.getvalue()

    @staticmethod
    def load(raw: bytes) -> Tree:
        with np.load(io.BytesIO(raw), allow_pickle=False) as held:
            own = {k: held[k] for k in held.files}
        own["norm"] = float(own["norm"])
        return Tree(**own)


def build(ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF, seed: int = 5) -> Tree:
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    first = np.concatenate([[True], ids[1:] != ids[:-1]])
    ids, vectors = ids[first], vectors[first]
    points, owner = np.unique(vectors, axis=0, return_inverse=True)
    owner = owner.reshape(-1)
    rng = np.random.default_rng(seed)
    squares = np.einsum("ij,ij->i", points, points)
    norm = float(np.sqrt(squares.max()))
    lift = np.sqrt(np.maximum(squares.max() - squares, 0))
    place = np.arange(len(points))
    start, stop, left, right, spans = [], [], [], [], []

    def node(a: int, b: int) -> int:
        own = len(start)
        start.append(a), stop.append(b), left.append(-1), right.append(-1), spans.append((0.0, 0.0, 0.0, 0.0))
        if b - a <= leaf:
            return own
        pick = a + int(rng.integers(b - a))
        place[[a, pick]] = place[[pick, a]]
        rest = place[a + 1 : b]
        dot = points[rest] @ points[place[a]] + lift[rest] * lift[place[a]]
        far = np.sqrt(np.maximum(2 * norm * norm - 2 * dot, 0))
        by = np.argsort(far, kind="stable")
        place[a + 1 : b], far = rest[by], far[by]
        half = len(rest) // 2
        spans[own] = (far[0], far[half - 1], far[half], far[-1])
        left[own] = node(a + 1, a + 1 + half)
        right[own] = node(a + 1 + half, b)
        return own

    node(0, len(points))
    by_point = np.lexsort((ids, np.argsort(place)[owner]))
    ends = np.cumsum(np.bincount(np.argsort(place)[owner], minlength=len(points)))
    return Tree(
        points[place], lift[place], ids[by_point], ends, np.array(start), np.array(stop), np.array(left), np.array(right),
        np.array(spans), norm,
    )


class _Search:
    """k nearest points of each query, query by query pruned, node by node evaluated.

    Points are ordered by score, then by their smallest id.  A product of matrices tells which points may be
    among the best; their scores are then summed one by one, so that equal vectors have equal scores.
    """

    def __init__(self, tree: Tree, queries: np.ndarray, k: int, factor: float):
        self.tree, self.k, self.factor = tree, k, factor
        self.least = tree.ids[np.concatenate([[0], tree.ends[:-1]])]  # the smallest id of each point
        self.queries = queries
        self.lengths = np.linalg.norm(queries, axis=1)
        self.score = np.full((len(queries), k), -np.inf)
        self.point = np.full((len(queries), k), -1)
        self.visit(0, np.arange(len(queries)))

    def distances(self, scores: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Distances to the queries as they would be with the length of the points."""
        norm = self.tree.norm
        return np.sqrt(np.maximum(2 * norm * norm - 2 * scores * (norm / self.lengths[own]), 0))

    def keep(self, own: np.ndarray, a: int, b: int) -> None:
        about = self.queries[own] @ self.tree.points[a:b].T
        least = self.score[own, -1]
        if b - a > self.k:
            least = np.maximum(least, np.partition(about, -self.k, axis=1)[:, -self.k])
        row, at = np.nonzero(about >= (least - _SLACK * self.tree.norm * self.lengths[own])[:, None])
        score = np.concatenate(
            [
                (self.tree.points[at[c : c + _PAIRS] + a] * self.queries[own[row[c : c + _PAIRS]]]).sum(axis=1)
                for c in range(0, len(row), _PAIRS)
            ]
            or [np.zeros(0)]
        )
        some = np.unique(row)
        held = own[some]
        row = np.concatenate([np.repeat(some, self.k), row])
        score = np.concatenate([self.score[held].reshape(-1), score])
        point = np.concatenate([self.point[held].reshape(-1), at + a])
        order = np.lexsort((self.least[point], point < 0, -score, row))
        starts = np.searchsorted(row[order], some)
        best = order[starts[:, None] + np.arange(self.k)]
        self.score[held], self.point[held] = score[best], point[best]

    def visit(self, n: int, own: np.ndarray) -> None:
        t = self.tree
        a, b = int(t.start[n]), int(t.stop[n])
        if t.left[n] < 0:
            self.keep(own, a, b)
            return
        self.keep(own, a, a + 1)
        d = self.distances(self.queries[own] @ t.points[a], own)
        low1, high1, low2, high2 = t.spans[n]
        nearer = d <= (high1 + low2) / 2
        for first, second, some in ((t.left[n], t.right[n], nearer), (t.right[n], t.left[n], ~nearer)):
            if not some.any():
                continue
            group, dist = own[some], d[some]
            for child in (first, second):
                low, high = (low1, high1) if child == t.left[n] else (low2, high2)
                bound = np.maximum(np.maximum(low - dist, dist - high), 0) * self.factor
                # points as far as the last one are looked at: a smaller id may be among them
                open_ = bound <= self.distances(self.score[group, -1], group) + _REACH * t.norm
                if open_.any():
                    self.visit(int(child), group[open_])


def search(tree: Tree, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float) -> pd.DataFrame:
    """The k best rows of one shard for each query, the query's own row left out."""
    found = _Search(tree, queries, min(k + 1, len(tree.points)), factor)
    starts = np.concatenate([[0], tree.ends[:-1]])
    out: list[tuple[np.ndarray, ...]] = []
    for q in range(len(queries)):
        points = found.point[q][found.point[q] >= 0]
        score = found.score[q][found.point[q] >= 0]
        names = [tree.ids[starts[p] : min(tree.ends[p], starts[p] + k + 1)] for p in points]
        many = np.repeat(score, [len(n) for n in names])
        ids = np.concatenate(names)
        other = ids != query_ids[q]
        ids, many = ids[other], many[other]
        best = np.lexsort((ids, -many))[:k]
        out.append((np.full(len(best), query_ids[q]), ids[best], many[best]))
    if not out:
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
    columns = [np.concatenate(c) for c in zip(*out)]
    return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns)))


# ------------------------------------------------------------------ on Spark


def valid_vectors(rows: DataFrame) -> DataFrame:
    """vec_id, embedding as doubles and its length, of the rows that take part."""
    vector = F.col("embedding").cast("array<double>")
    bad = F.exists("_v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("_v", lambda x: x != 0)
    out = rows.select("vec_id", vector.alias("_v")).filter(F.col("_v").isNotNull() & F.col("vec_id").isNotNull())
    return out.filter(~bad & some).select("vec_id", "_v", F.size("_v").alias("_dim"))


def build_index(vectors: DataFrame, shard_rows: int = SHARD_ROWS, leaf: int = LEAF) -> DataFrame:
    """One tree for each shard: ``_dim``, ``_shard``, ``_tree``.  Shards are dealt by a hash of the id."""
    sizes = {r["_dim"]: r["count"] for r in vectors.groupBy("_dim").count().collect()}  # one row for each length

    def tree(part: pd.DataFrame) -> pd.DataFrame:
        held = build(part["vec_id"].to_numpy(), np.stack(part["_v"].to_numpy()), leaf)
        return pd.DataFrame({"_dim": part["_dim"].iloc[:1], "_shard": part["_shard"].iloc[:1], "_tree": [held.dump()]})

    return (
        vectors.withColumn("_shard", F.pmod(F.xxhash64("vec_id"), _per_dim(sizes, shard_rows)).cast("int"))
        .groupBy("_dim", "_shard")
        .applyInPandas(tree, "_dim int, _shard int, _tree binary")
    )


def _per_dim(sizes: dict[int, int], rows: int):
    """How many parts of at most about ``rows`` rows each length needs."""
    out = F.lit(1)
    for dim, n in sorted(sizes.items()):
        out = F.when(F.col("_dim") == dim, -(-n // rows)).otherwise(out)
    return out.cast("bigint")


def nearest(
    index: DataFrame, queries: DataFrame, k: int = K, factor: float = FACTOR, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest rows that the search finds."""
    blocks = {r["_dim"]: r["count"] for r in queries.groupBy("_dim").count().collect()}
    shards = {r["_dim"]: r["n"] for r in index.groupBy("_dim").agg((F.max("_shard") + 1).alias("n")).collect()}
    counted = _per_dim(blocks, block_rows)
    asked = queries.withColumn("_block", F.pmod(F.xxhash64("vec_id"), counted).cast("int"))
    asked = asked.withColumn("_shard", F.explode(F.sequence(F.lit(0), (_per_dim(shards, 1) - 1).cast("int"))))
    held = index.withColumn("_block", F.explode(F.sequence(F.lit(0), (counted - 1).cast("int"))))
    cell = ["_dim", "_shard", "_block"]

    def answer(trees: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        if not len(trees) or not len(part):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        vectors = np.stack(part["_v"].to_numpy())
        return search(Tree.load(trees["_tree"].iloc[0]), part["vec_id"].to_numpy(), vectors, k, factor)

    found = (
        held.groupBy(*cell)
        .cogroup(asked.groupBy(*cell))
        .applyInPandas(answer, "query_id bigint, vec_id bigint, score double")
    )
    best = W.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op3_vantage_point_search(spark: SparkSession, folder: str) -> DataFrame:
    vectors = valid_vectors(spark.read.parquet(f"{folder}/embeddings.parquet"))
    index = keep(build_index(vectors), "vantage-trees")
    queries = vectors.filter(F.col("vec_id") % QUERY_EVERY == 0)
    # one row for each query id
    return nearest(index, queries.groupBy("vec_id", "_dim").agg(F.min("_v").alias("_v")))
