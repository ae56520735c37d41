import hashlib
import math

import numpy as np
import pytest

from martlet.llm import lloyd

SCHEMA = "vec_id bigint, embedding array<float>, label int, code string, part string, _row int"


def brute(rows, positions, entries, rounds):
    """Plain Lloyd straight from the definition: the rows that are kept with code, error and label error, and the hash."""
    kept = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v], label)
        for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    width = len(kept[0][1]) // positions
    first = {}
    for i, q, _ in kept:
        first[i] = min(first.get(i, q), q)
    seeds = [first[i] for i in sorted(first, key=lambda i: (i is None, i or 0))[:entries]]
    books = [[q[p * width : (p + 1) * width] for q in seeds] for p in range(positions)]

    def choose(part, book):
        far = [sum((a - b) ** 2 for a, b in zip(part, center)) for center in book]
        return far.index(min(far)), min(far)

    def assigned():
        return [[choose(q[p * width : (p + 1) * width], books[p]) for p in range(positions)] for _, q, _ in kept]

    for _ in range(rounds):
        codes = assigned()
        for p in range(positions):
            for e in range(len(books[p])):
                own = [q[p * width : (p + 1) * width] for (_, q, _), code in zip(kept, codes) if code[p][0] == e]
                if own:
                    books[p][e] = [sum(axis) // len(own) for axis in zip(*own)]
    out = [(i, "".join(f"{e:02x}" for e, _ in c), sum(d for _, d in c), label) for (i, _, label), c in zip(kept, assigned())]
    whole = ",".join(str(x) for book in books for center in book for x in center)
    sums = {}
    for _, _, error, label in out:
        sums[label] = sums.get(label, 0) + error
    return [(i, c, e, sums[label]) for i, c, e, label in out], hashlib.sha256(whole.encode()).hexdigest()


def check(spark, rows, **options):
    frame = spark.createDataFrame([(i, v, label, "x", "y", 9) for i, v, label in rows], SCHEMA).repartition(3)
    got = lloyd.compress(frame, **options).collect()
    want, digest = brute(rows, options.get("positions", 16), options.get("entries", 64), options.get("rounds", 2))
    order = lambda r: (r[0] is None, *r)
    found = [(r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got]
    assert sorted(found, key=order) == sorted(want, key=order)
    assert {r["codebooks_sha256"] for r in got} == {digest}


def drawn(n, dim, seed=1):
    rng = np.random.default_rng(seed)
    return [(int(i), [float(x) for x in rng.normal(0, 0.2, dim)], int(rng.integers(4))) for i in range(n)]


@pytest.mark.parametrize("owner_rows", [65_536, 50])
def test_against_brute_force(spark, owner_rows):
    check(spark, drawn(400, 32), positions=4, entries=16, rounds=3, owner_rows=owner_rows)


def test_contract_sizes_with_odd_rows(spark):
    rows = drawn(150, 64, seed=2)
    rows += rows[:20]  # repeated rows
    rows += [(3, [0.5] * 64, 1), (None, [0.25] * 64, None), (None, [-0.25] * 64, 2), (900, [0.0] * 64, None)]
    rows += [(901, None, 1), (902, [0.1] * 63 + [None], 1), (903, [float("nan")] + [0.1] * 63, 1), (904, [float("inf")] * 64, 1)]
    check(spark, rows)


def test_hot_entry_and_ties(spark):
    same = [(i, [0.1, -0.1, 0.3, 0.2], 0) for i in range(300)]  # one entry of each position holds most rows
    check(spark, same + drawn(60, 4, seed=3), positions=2, entries=8, rounds=2, owner_rows=40)


def test_only_members_that_change_their_entry_move(spark):
    frame = spark.createDataFrame([(i, v, label, "x", "y", 9) for i, v, label in drawn(500, 8)], SCHEMA)
    model = lloyd.ResidentLloyd(lloyd.whole_vectors(frame, 2), positions=2, entries=8, rounds=4)
    assert model.moves.members == 1000 and len(model.moves.moved) == 3
    assert all(0 < n < 500 for n in model.moves.moved) and model.moves.moved[0] > model.moves.moved[-1]
    dealt = model.store.get("members-2", model.members.select("_row", "position", "entry", "salt", "part"))
    assert dealt.count() == model.moves.moved[0]


def test_lengths_few_ids_and_empty_tables(spark):
    rows = drawn(5, 32, seed=4)  # fewer ids than entries
    check(spark, rows)
    other = [(50, [0.1] * 31, 1), (51, [0.1] * 16, 1), (52, [], 1)]
    frame = spark.createDataFrame([(i, v, label, "x", "y", 9) for i, v, label in rows + other], SCHEMA)
    assert {r["vec_id"] for r in lloyd.compress(frame).collect()} == {0, 1, 2, 3, 4}
    columns = ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]
    none = lloyd.compress(spark.createDataFrame([], SCHEMA))
    assert none.columns == columns and none.count() == 0
    assert lloyd.compress(spark.createDataFrame([(1, [0.1] * 3, 1, "x", "y", 9)], SCHEMA)).count() == 0
    huge = lloyd.compress(spark.createDataFrame([(1, [3e38] * 16, 1, "", "", 0), (2, [-3e38] * 16, None, "", "", 0)], SCHEMA))
    assert [r["error"] for r in huge.collect()] == [0, 0]
