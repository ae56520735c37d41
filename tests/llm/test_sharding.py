import random
import zlib
from collections import Counter, defaultdict

import pytest

from martlet.llm import sharding

from .conftest import odd_rows


def slow_best_fit(sizes, capacity):
    bins = []
    for size in sorted(sizes, reverse=True):
        fits = [b for b in range(len(bins)) if bins[b] >= size]
        if fits:
            bins[min(fits, key=lambda b: (bins[b], b))] -= size
        else:
            bins.append(capacity - size)
    return sorted(capacity - b for b in bins)


@pytest.mark.parametrize("seed", range(8))
def test_runs_equal_one_by_one_best_fit(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([3, 7, 11, 20, 33, 50, rng.randrange(1, 60)]) for _ in range(300)]
    runs, opened = sharding.best_fit_decreasing(dict(Counter(sizes)), 100)
    filled = defaultdict(int)
    for r in runs:
        filled[r.shard] += r.size * r.count
    assert sorted(filled.values()) == slow_best_fit(sizes, 100) and len(filled) == opened
    assert {s: sum(r.count for r in runs if r.size == s) for s in set(sizes)} == Counter(sizes)


def test_tree_gives_the_tightest_bin():
    rng = random.Random(1)
    tree, held = sharding.BinTree(), []
    for name in range(2000):
        if held and rng.random() < 0.4:
            size = rng.randrange(1, 1000)
            want = min((b for b in held if b[0] >= size), default=None)
            assert tree.take_tightest(size) == want
            if want:
                held.remove(want)
        else:
            held.append((rng.randrange(1, 1000), name))
            tree.add(*held[-1])


@pytest.mark.parametrize("seed", range(5))
def test_packing_into_a_number_of_shards(seed):
    rng = random.Random(seed)
    sizes = Counter(rng.randrange(1, 500) for _ in range(1000)) + Counter({20_000: 1} if seed % 2 else {})
    runs = sharding.pack_into(dict(sizes), 10)
    filled, placed = defaultdict(int), Counter()
    for r in runs:
        filled[r.shard] += r.size * r.count
        placed[r.size] += r.count
        assert r.first >= 0 and r.first + r.count <= sizes[r.size]
    assert placed == sizes and set(filled) == set(range(10))
    rest = [v for s, v in filled.items() if v != 20_000 or not seed % 2]
    assert max(rest) <= 1.02 * sum(rest) / len(rest)


def check(rows, texts, shards):
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _ in texts)
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r["shard"]].append(r)
    for own in by_shard.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    assert set(by_shard) <= set(range(shards))
    return by_shard


def test_documents(spark):
    folder = "/root/testdata/sf0.01"
    rows = sharding.op6_best_fit_sharding(spark, folder).collect()
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    by_shard = check(rows, texts, 40)
    known = dict(texts)
    groups = defaultdict(set)
    for r in rows:
        raw = known[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
        groups[raw].add(r["shard"])
    assert all(len(s) == 1 for s in groups.values())
    filled = [sum(r["size"] for r in own) for own in by_shard.values()]
    assert len(filled) == 40 and max(filled) < 1.01 * min(filled)


def test_a_group_larger_than_a_share_is_cut(spark):
    rows = [(k, "the same text") for k in range(400)] + [(k, f"text {k}") for k in range(400, 1000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    by_shard = check(sharding.Shards(docs, 10).numbered().collect(), rows, 10)
    filled = [sum(r["size"] for r in own) for own in by_shard.values()]
    assert len(filled) == 10 and max(filled) < 1.05 * min(filled)


def test_odd_rows(odd, empty):
    rows = sharding.Shards(odd, 4).numbered().collect()
    check(rows, [(r[0], r[1]) for r in odd_rows()], 4)
    assert {r["size"] for r in rows if r["doc_id"] in (3, 4)} == {16}
    assert sharding.Shards(empty, 4).numbered().count() == 0
