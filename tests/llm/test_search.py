import numpy as np
import pytest
from pyspark.sql import functions as F

from martlet.llm import vantage

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, k, every=1):
    """Straight from the definition: {query: [(vec_id, score)]}."""
    good = {}
    for vec_id, v in rows:
        if vec_id is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        good[vec_id] = np.array(v, dtype=np.float32).astype(float)
    out = {}
    for q, x in good.items():
        if q % every:
            continue
        scores = [(-float((y * x).sum()), i) for i, y in good.items() if i != q and len(y) == len(x)]
        out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def found(frame):
    out = {}
    for r in frame.collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: [(i, s) for _, i, s in sorted(own)] for q, own in out.items()}


def search(spark, rows, k, factor=1.0, **sizes):
    vectors = vantage.valid_vectors(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA))
    index = vantage.build_index(vectors, sizes.get("shard_rows", 200), sizes.get("leaf", 8))
    queries = vectors.groupBy("vec_id", "_dim").agg(F.min("_v").alias("_v"))
    return found(vantage.nearest(index, queries, k, factor, sizes.get("block_rows", 150)))


@pytest.mark.parametrize("scale", [False, True])
def test_factor_one_is_exact(spark, scale):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(500, 6))
    v *= rng.uniform(0.1, 3, (500, 1)) if scale else 1 / np.linalg.norm(v, axis=1, keepdims=True)
    rows = [(int(i), [float(x) for x in r.astype(np.float32)]) for i, r in enumerate(v)]
    got, want = search(spark, rows, 7), brute(rows, 7)
    assert {q: [i for i, _ in own] for q, own in got.items()} == {q: [i for i, _ in own] for q, own in want.items()}
    assert all(abs(a[1] - b[1]) < 1e-12 for q in want for a, b in zip(got[q], want[q]))


def test_pruning_leaves_points_out_and_keeps_recall():
    rng = np.random.default_rng(0)
    v = rng.normal(size=(4000, 3))
    tree = vantage.Tree.load(vantage.build(np.arange(4000), v, leaf=16).dump())
    seen = []
    original = vantage._Search.keep
    try:
        vantage._Search.keep = lambda self, own, a, b: (seen.append(len(own) * (b - a)), original(self, own, a, b))[1]
        exact = vantage.search(tree, np.arange(50), v[:50], 10, 1.0)
        cost, seen[:] = sum(seen), []
        relaxed = vantage.search(tree, np.arange(50), v[:50], 10, 1.2)
    finally:
        vantage._Search.keep = original
    assert cost < 50 * 4000 * 0.7 and sum(seen) < cost
    same = exact.merge(relaxed, on=["query_id", "vec_id"])
    assert len(same) >= 0.8 * len(exact)


def test_ties_copies_and_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0]) for i in range(40)] + [(i, [2.0, 1.0]) for i in range(40, 45)]
    rows += [(50, None), (51, []), (52, [0.0, 0.0]), (53, [nan, 1.0]), (54, [inf, 1.0]), (55, [None, 1.0]), (None, [1.0, 1.0])]
    rows += [(60, [1.0, 0.0, 0.0]), (61, [2.0, 0.0, 0.0]), (62, [-1.0, -1.0]), (40, [2.0, 1.0])]
    got = search(spark, rows, 5, shard_rows=10, leaf=2)
    want = brute(rows, 5)
    assert got == want


def test_factor_one_is_exact_where_many_scores_are_equal():
    rng = np.random.default_rng(8)
    v = np.unique(rng.integers(-3, 4, (3000, 5)).astype(float), axis=0)
    v = v[(v != 0).any(axis=1)]
    ids = rng.permutation(len(v))
    tree = vantage.Tree.load(vantage.build(ids, v, leaf=32).dump())
    got = vantage.search(tree, ids[:150], v[:150], 20, 1.0)
    for q in range(150):
        best = sorted((-s, i) for s, i in zip(v @ v[q], ids) if i != ids[q])[:20]
        own = got[got["query_id"] == ids[q]]
        assert list(own["vec_id"]) == [i for _, i in best] and list(own["score"]) == [-s for s, _ in best]


def test_empty_and_single(spark):
    assert search(spark, [], 3) == {}
    assert search(spark, [(1, [1.0])], 3) == {}


def test_recall_of_the_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    want = brute(rows, vantage.K, vantage.QUERY_EVERY)
    got = found(vantage.op3_vantage_point_search(spark, folder))
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
