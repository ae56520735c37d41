import re
from itertools import permutations

import numpy as np
import pytest

from martlet.llm import audit

from .conftest import words

SCHEMA = "doc_id bigint, text string, source string, part string, _mask int, quality int"


def failures(docs):
    """The letters that each document fails, from the definitions."""
    out = []
    for doc_id, text, _ in docs:
        text = text or ""
        tokens = re.findall(r"[^\x20\x09-\x0D]+", text)
        own = set()
        if len(tokens) < 50:
            own.add("A")
        if 100 * len(set(tokens)) < 65 * len(tokens):
            own.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text):
            own.add("C")
        if re.search("[#$%&*|]", text):
            own.add("D")
        if doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in docs):
            own.add("E")
        out.append(own)
    return out


def brute(docs, labels):
    fails = failures(docs)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows, shapley = {}, {}
    for part in {s or "" for _, _, s in docs}:
        inside = [(i, f) for (i, _, s), f in zip(docs, fails) if (s or "") == part]
        for order in permutations("ABCDE"):
            left = inside
            for step, letter in enumerate(order, 1):
                out = [(i, f) for i, f in left if letter in f]
                left = [(i, f) for i, f in left if letter not in f]
                failing = sum(letter in f for _, f in inside)
                rows[part, "".join(order), step] = (
                    len(left), len(out), failing - len(out), sum(f == {letter} for _, f in inside),
                    sum(i in good for i, _ in out), sum(i in toxic for i, _ in out),
                )
                shapley[part, letter] = shapley.get((part, letter), 0) + len(out)
    return {(p, o, k): (*v, shapley[p, o[k - 1]]) for (p, o, k), v in rows.items()}


def run(spark, docs, labels):
    frame = spark.createDataFrame([(i, t, s, "p", 7, 0) for i, t, s in docs], SCHEMA).repartition(3)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    rows = audit.audit(audit.cells(audit.masked(frame), marks)).collect()
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in audit.STEP_COLUMNS) for r in rows}


def mixed_docs():
    odd = [
        (1, None, "a"), (2, "", "a"), (3, " \t\n", None), (None, "", "b"), (None, words(5, 80), "b"),
        (4, words(5, 80), "b"), (5, words(5, 80), "c"), (5, words(5, 80), "c"), (6, words(5, 80), None),
        (7, words(6, 60, 10), "a"), (8, words(7, 70, 5000) + " 50% #", "a"), (9, words(8, 70, 5000).upper(), "a"),
        (10, words(9, 70, 5000), "a"), (11, "Été ñandú 東京 😀 " * 20, "a"), (12, "A" * 3 + "b" * 57, "c"),
        (13, words(10, 30_000, 100_000), "c"), (14, "x\x1fy\x85z \x0b q", ""),
    ]
    hot = [(100 + k, words(11, 55, 5000), "src0") for k in range(60)]
    return odd + hot


LABELS = [(1, 1, 0), (4, 1, 1), (5, 0, 1), (7, None, 1), (8, 1, 0), (9, 0, 0), (9, 1, None), (110, 1, 1), (999, 1, 1), (None, 1, 1)]


def test_against_brute_force(spark):
    docs = mixed_docs()
    got = run(spark, docs, LABELS)
    assert got == brute(docs, LABELS)
    assert len(got) == 600 * len({s or "" for _, _, s in docs})


def test_given_documents(spark, documents):
    docs = [tuple(r) for r in documents.select("doc_id", "text", "source").collect()]
    assert run(spark, docs, LABELS) == brute(docs, LABELS)


@pytest.mark.parametrize("filters", [1, 3, 5])
def test_walk_equals_counting_each_subset(filters):
    rng = np.random.default_rng(filters)
    cells = rng.integers(0, 50, (4, 1 << filters, 3))
    states = audit.walk(cells)
    for subset in range(1 << filters):
        alive = [mask for mask in range(1 << filters) if not mask & subset]
        assert (states[subset] == cells[:, alive].sum(axis=1)).all()


def test_empty_table(spark):
    assert run(spark, [], LABELS) == {}
