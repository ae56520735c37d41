import random

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F

from martlet.llm import setjoin, similar

from .conftest import odd_rows, row, words


def slow_set(text):
    parts = text.encode().lower().split()
    return {tuple(parts[i : i + 5]) for i in range(max(len(parts) - 4, 1))} if parts else set()


def slow_groups(texts):
    """texts: {id: text}; {id: smallest reachable id} over all pairs of similarity 0.8 or more."""
    sets = {k: slow_set(t) for k, t in texts.items()}
    label = {k: k for k in texts}
    pairs = []
    for a in texts:
        for b in texts:
            both, either = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if a < b and 5 * both >= 4 * either:
                pairs.append((a, b))
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            least = min(label[a], label[b])
            changed |= label[a] != label[b]
            label[a] = label[b] = least
    return label


def edited(text, places, rng):
    parts = text.split()
    for at in rng.sample(range(len(parts)), places):
        parts[at] = f"new{rng.randrange(1000)}"
    return " ".join(parts)


def near_copies():
    """Copies of 300 words with 1 to 9 changed ones, of similarity 0.73 to 0.97 to their first text; chains; a large group."""
    rng = random.Random(8)
    texts = []
    for k in range(12):
        first = words(100 + k, 300)
        texts += [first, *[edited(first, n, rng) for n in range(1, 10)]]
    chain = words(50, 300)
    for _ in range(12):
        texts.append(chain)
        chain = edited(chain, 4, rng)
    first = words(60, 300)
    texts += [edited(first, rng.randrange(2, 6), rng) for _ in range(60)]
    rng.shuffle(texts)
    return dict(enumerate(texts))


def test_groups_against_brute_force(spark, odd):
    texts = near_copies()
    docs = spark.createDataFrame([row(k, t) for k, t in texts.items()], odd.schema)
    want = slow_groups(texts)
    got = {r["doc_id"]: r["component_id"] for r in similar.SimilarGroups(docs).groups().collect()}
    assert got == want and len(set(want.values())) < len(texts) / 2
    kept = corpus_pipeline.near_stage(spark, docs, "")
    assert {r["doc_id"] for r in kept.collect()} == set(want.values())


def test_groups_of_documents(documents):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    got = {r["doc_id"]: r["component_id"] for r in similar.SimilarGroups(documents).groups().collect()}
    assert got == slow_groups(texts)


def test_odd_rows(odd, empty):
    rows = similar.SimilarGroups(odd).groups().collect()
    assert len(rows) == len(odd_rows())
    own = {r["doc_id"]: r["component_id"] for r in rows}
    assert own[3] == own[4] == own[8] == 3 and own[2] == own[12] == 1 and own[6] == 5
    kept = similar.SimilarGroups(odd).survivors()
    assert kept.columns == odd.columns
    assert similar.SimilarGroups(empty).survivors().count() == 0


def test_a_shared_passage_makes_few_candidates(spark, odd):
    """3,000 texts around one passage of 60 words beside 40 of their own: similarity near 0.4, no link is right."""
    passage = words(1, 60)
    texts = [f"{passage} {words(10 + k, 40, 10**6)}" for k in range(3000)]
    texts += [edited(texts[0], 1, random.Random(k)) for k in range(3)]
    docs = spark.createDataFrame([row(k, t) for k, t in enumerate(texts)], odd.schema)
    found = similar.SimilarGroups(docs).found
    assert sum(pairs.count() for pairs in found.tried) < 10 * len(texts)
    assert found.found().count() >= 3


def test_the_grid_of_fingerprints_finds_links_first(spark, odd):
    """Long texts with one changed word have fingerprints within two bits: the grid links them, the exact search the rest."""
    rng = random.Random(4)
    texts = []
    for k in range(20):
        first = words(300 + k, 3000, 10**6)
        texts += [first, edited(first, 1, rng), edited(first, 100, rng)]
    docs = spark.createDataFrame([row(k, t) for k, t in enumerate(texts)], odd.schema)
    groups = similar.SimilarGroups(docs)
    first = {r["doc_id"]: r["_print"] for r in groups.rows.collect()}
    found = {(r["a"], r["b"]) for r in groups.grid.collect()}
    right = {tuple(sorted((first[k], first[k + 1]))) for k in range(0, 60, 3)}
    assert found <= right and len(found) >= 10
    assert {r["doc_id"]: r["component_id"] for r in groups.groups().collect()} == slow_groups(dict(enumerate(texts)))


def test_a_group_that_just_fails_to_link_makes_few_candidates(spark, odd):
    """150 texts of similarity near 0.71 to each other: 11,175 pairs share rare shingles, hardly one is right."""
    first = words(60, 300, 10**6)
    texts = [edited(first, 5, random.Random(k)) for k in range(150)]
    docs = spark.createDataFrame([row(k, t) for k, t in enumerate(texts)], odd.schema)
    groups = similar.SimilarGroups(docs)
    assert sum(pairs.count() for pairs in groups.found.tried) < 10 * len(texts)
    got = {r["doc_id"]: r["component_id"] for r in groups.groups().collect()}
    assert got == slow_groups(dict(enumerate(texts)))


def test_sketches_bound_what_sets_differ_in():
    rng = np.random.default_rng(5)
    for n in (1, 30, 300, 5000):
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        for changed in (0, 1, n // 20, n):
            b = np.concatenate([a[changed:], rng.integers(0, 1 << 63, changed, dtype=np.uint64)])
            bits = sum(int(x).bit_count() for x in (setjoin.sketch(a) ^ setjoin.sketch(b)).view(np.uint64))
            assert bits <= len(np.setxor1d(a, b))


def test_buckets_of_few_rows_meet_once(spark, odd):
    """Fours of texts that share half of their words and do not link: no hubs, and no pair is verified."""
    texts = []
    for k in range(100):
        shared = words(500 + k, 60, 10**6)
        texts += [f"{shared} {words(10_000 + 4 * k + j, 60, 10**6)}" for j in range(4)]
    texts += [edited(texts[0], 1, random.Random(1))]
    docs = spark.createDataFrame([row(k, t) for k, t in enumerate(texts)], odd.schema)
    groups = similar.SimilarGroups(docs)
    assert groups.found.wide_rows == 0 and sum(pairs.count() for pairs in groups.found.tried) < 10
    assert {r["doc_id"]: r["component_id"] for r in groups.groups().collect()} == slow_groups(dict(enumerate(texts)))


def test_the_sieve_lets_all_wanted_rows_and_few_others_through(spark):
    rows = spark.range(200_000).select("id", F.xxhash64("id").alias("_place"))
    wanted = rows.filter("id % 100 = 7").select("_place")
    left = setjoin.sieved(rows, wanted)
    assert left.filter("id % 100 = 7").count() == 2000 and left.count() < 2300
    plan = left._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastNestedLoopJoin" in plan and "SortMergeJoin" not in plan
    assert setjoin.sieved(rows, wanted.limit(0)).count() == 0


def test_a_set_of_repeated_rows_is_read_once(spark, odd):
    """Rows repeated in full and rows of no id: every set that is wanted comes once, others do not."""
    texts = [words(k, 30) for k in range(40)]
    rows = [row(k, t) for k, t in enumerate(texts)] * 3 + [row(None, words(99, 30))] * 2
    docs = spark.createDataFrame(rows, odd.schema)
    groups = similar.SimilarGroups(docs)
    place = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_mark"))
    classes = groups.rows.groupBy("_print").agg(place.alias("_first"))
    nodes = groups.rows.filter("doc_id is null or doc_id < 10").select(F.col("_print").alias("node")).distinct()
    found = setjoin.sets_of(docs, classes, nodes, 5).collect()
    assert len(found) == 11 and {r["node"] for r in found} == {r["node"] for r in nodes.collect()}
