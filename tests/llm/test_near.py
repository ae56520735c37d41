import random

import xxhash
from pyspark.sql import functions as F

from martlet.llm import near
from martlet.llm.components import components
from martlet.sources.store import Store

from .conftest import odd_rows


def slow_print(text, words=3):
    """Bit by bit, straight from the definition."""
    parts = [p for p in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if p]
    if not parts:
        return 0
    shingles = [" ".join(parts[i : i + words]) for i in range(len(parts) - words + 1)] or [" ".join(parts)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints, bits=2):
    """prints: {node: fingerprint}; {node: smallest reachable node}."""
    label = {n: n for n in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= bits and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints_by_definition(odd):
    got = sorted((r["doc_id"], r["_print"]) for r in near.fingerprints(odd).collect() if r["doc_id"] is not None)
    assert got == sorted((r[0], signed(slow_print(r[1] or ""))) for r in odd_rows() if r[0] is not None)


def test_segment_counts(spark):
    values = [0, -1, 1, 0x7FFFFFFFFFFFFFFF, -(1 << 63), 0x123456789ABCDEF0]
    rows = spark.createDataFrame([(v,) for v in values], "v bigint").select("v", near.segment_counts(F.col("v")).alias("c"))
    for v, c in rows.collect():
        digits = [((v >> 4 * k) & 15).bit_count() for k in range(16)]
        assert c == sum(d << 4 * k for k, d in enumerate(digits))


def test_links_are_exactly_the_close_pairs(spark):
    rng = random.Random(3)
    prints = set()
    for _ in range(25):
        centre = rng.getrandbits(64)
        prints.add(centre)
        for _ in range(12):
            other = centre
            for bit in rng.sample(range(64), rng.randrange(1, 5)):
                other ^= 1 << bit
            prints.add(other)
    own = [signed(p) for p in prints]
    got = near.links(spark.createDataFrame([(p,) for p in own], "_print bigint")).collect()
    want = {(a, b) for a in own for b in own if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2}
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_components_of_long_paths(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, 101), (101, 102), (100, 102)]
    got = components(spark.createDataFrame(edges, "a bigint, b bigint"), Store(spark, "test-components")).collect()
    assert {r["node"]: r["label"] for r in got} == {**{k: 0 for k in range(61)}, 100: 100, 101: 100, 102: 100}


def test_groups_against_brute_force(documents):
    prints = {r["doc_id"]: slow_print(r["text"]) for r in documents.collect()}
    want = slow_components(prints)
    got = {r["doc_id"]: r["component_id"] for r in near.NearGroups(documents).groups().collect()}
    assert got == want


def test_odd_rows(odd):
    rows = near.NearGroups(odd).groups().collect()
    assert len(rows) == len(odd_rows())
    own = {r["doc_id"]: r["component_id"] for r in rows}
    assert own[3] == own[4] == own[8] == 3 and own[2] == own[12] == 1 and own[6] == 5
    assert own[None] is None
    kept = near.NearGroups(odd).survivors()
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(None) == 1 and {1, 3, 5, 9, 11} <= set(ids) and not {2, 4, 6, 8, 12} & set(ids)
    assert len(kept.collect()) == len({(r["component_id"], r["_stays"]) for r in rows})


def test_empty_table(empty):
    assert near.NearGroups(empty).groups().count() == 0
    assert near.NearGroups(empty).survivors().count() == 0
