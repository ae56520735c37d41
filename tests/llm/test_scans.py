import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from martlet.llm import markov, pii
from martlet.llm.spans import joined

from .conftest import odd_rows

PII_TEXT = st.lists(
    st.sampled_from(["a.b", "@", "x-y.com", "é", " ", "1.2.3.4", ".", "256", "+1 (", "555) 01-23", "4111 1111 1111 1111", "-", "9", "%+", "..", "@a.b@c.d"]),
    max_size=12,
).map("".join)
SECRET_TEXT = st.lists(
    st.sampled_from(["password", "api_key", "APIKEY", "ſecret", "token", '"', "'", " ", ":", "=", "abcdef012345", "AKIA", "AKIAABCDEFGHIJKLMN", "0123456789abcdef", "Z", "é", "_.=-"]),
    max_size=12,
).map("".join)


def plain_pii(text):
    """The contract's patterns as they stand."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        total = sum(d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(reversed(digits)))
        if 12 <= len(digits) <= 19 and total % 10 == 0:
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15:
            out.append(("phone", m.start(), m.end()))
    return joined(out, pii.KINDS)


def plain_secrets(text):
    out = []
    for m in re.finditer(
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        text,
    ):
        if len(m[2]) >= 12:
            out.append(("assign", m.start(), m.end()))
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return joined(out, markov.KINDS)


@settings(max_examples=400, deadline=None)
@given(PII_TEXT)
def test_pii_patterns(text):
    assert joined(pii.base_spans(text), pii.KINDS) == plain_pii(text)


@settings(max_examples=400, deadline=None)
@given(SECRET_TEXT)
def test_secret_patterns(text):
    assert joined(markov.base_spans(text), markov.KINDS) == plain_secrets(text)


def test_patterns_of_documents(documents):
    for r in documents.collect():
        assert joined(pii.base_spans(r["text"]), pii.KINDS) == plain_pii(r["text"])
        assert joined(markov.base_spans(r["text"]), markov.KINDS) == plain_secrets(r["text"])


@pytest.mark.parametrize("unit", ["a", "1", "1.", "@", "a@", "+1", " ", "-", "1 ", "password", "=", "AKIA", "."])
def test_long_runs_take_no_quadratic_time(unit):
    text = unit * (300_000 // len(unit))
    began = time.process_time()
    pii.base_spans(text), markov.base_spans(text)
    pii.graph_of(text[:50_000])
    assert time.process_time() - began < 5


# ------------------------------------------------------------------ the field


def brute_marginals(field, graph):
    """Sum over all labellings."""
    n = len(graph.spans)
    own = graph.features @ field.unary
    table = field.edge_potentials(graph.edges[:, 2])
    total = np.zeros((n, pii.LABELS))
    for labels in np.ndindex(*[pii.LABELS] * n):
        score = sum(own[k, y] for k, y in enumerate(labels))
        score += sum(table[e][labels[a], labels[b]] for e, (a, b, _) in enumerate(graph.edges))
        for k, y in enumerate(labels):
            total[k, y] += np.exp(score)
    return total / total.sum(axis=1, keepdims=True)


def test_belief_propagation_is_exact_on_trees():
    rng = np.random.default_rng(2)
    field = pii.Field(rng.normal(size=(pii.FEATURES, pii.LABELS)), rng.normal(size=(pii.LABELS, pii.LABELS)), np.array([1.0, 0.5]))
    edges = np.array([(0, 1, pii.CHAIN), (1, 2, pii.SAME), (1, 3, pii.SHAPE), (3, 4, pii.CHAIN)])
    graph = pii.Graph(np.zeros((5, 2), int), rng.integers(0, 2, (5, pii.FEATURES)), edges)
    assert np.allclose(pii.marginals(field, graph, damping=0.1, settled=1e-9), brute_marginals(field, graph), atol=1e-6)


def test_skip_edges_make_repeated_tokens_agree():
    graph = pii.graph_of("x 12345 words " * 1 + "more words without numbers " * 20 + "12345 end")
    assert [tuple(e) for e in graph.edges] == [(0, 1, pii.SAME)]
    unary = np.zeros((pii.FEATURES, pii.LABELS))
    field = pii.Field(unary, np.zeros((pii.LABELS, pii.LABELS)), np.array([3.0, 0.0]))
    graph.features[:] = 0
    graph.features[0, 0] = 1
    field.unary[0, 3] = 4.0  # only the first token has evidence for a card
    chance = pii.marginals(field, graph)
    assert chance[1].argmax() == 3 and chance[1, 3] > 0.5


@pytest.mark.parametrize("repeats", [20, 60, 1000])
def test_all_repeats_of_a_token_get_its_label(repeats):
    text = "12345 word other 777 word " * repeats
    graph = pii.graph_of(text)
    field = pii.Field(np.zeros((pii.FEATURES, pii.LABELS)), np.zeros((pii.LABELS, pii.LABELS)), np.array([3.0, 0.0]))
    graph.features[:] = 0
    graph.features[0, 0] = 1
    field.unary[0, 3] = 4.0  # evidence of one occurrence only
    chance = pii.marginals(field, graph)
    assert (chance[::2].argmax(axis=1) == 3).all() and np.allclose(chance[1::2], 1 / pii.LABELS)
    assert np.allclose(chance, pii.marginals(field, graph, settled=1e-12), atol=1e-4)


def test_a_text_settles_by_itself():
    rng = np.random.default_rng(6)
    field = pii.Field(rng.normal(size=(pii.FEATURES, pii.LABELS)), rng.normal(size=(pii.LABELS, pii.LABELS)), np.array([1.0, 0.5]))
    texts = ["a 1 b 2 3 4", "9 8 7 9 8 7 " * 40, "call +1 22 33", "5 x 5 y 6 z " * 9]
    graphs = [pii.graph_of(t) for t in texts]
    ends = np.cumsum([len(g.spans) for g in graphs])[:-1]
    for own, part in zip(graphs, np.split(pii.marginals(field, pii.together(graphs)), ends)):
        assert np.allclose(pii.marginals(field, own), part, atol=1e-12)


def test_messages_that_never_agree_end():
    field = pii.Field(np.eye(pii.FEATURES, pii.LABELS) * 3, -4 * np.eye(pii.LABELS), np.array([5.0, -5.0]))
    graph = pii.graph_of("1 2 1 3 2 1 44 2 5 1 " * 30)
    chance = pii.marginals(field, graph)
    assert np.isfinite(chance).all() and np.allclose(chance.sum(axis=1), 1)


def test_repeats_have_shape_edges_and_training_takes_whole_stretches():
    edges = {tuple(e) for e in pii.graph_of("12 x 34 x 12 x 34").edges}
    assert {(0, 2, pii.SAME), (1, 3, pii.SAME), (0, 1, pii.SHAPE), (1, 3, pii.SHAPE)} - edges == {(1, 3, pii.SHAPE)}
    text = " ".join(f"a@b{k}.org {k}" for k in range(500))
    graph, labels = pii.stretch(text, pii.graph_of(text), 100)
    assert len(labels) == len(graph.spans) == 100 and (labels == 1).sum() == 50
    assert (graph.edges[:, 2] == pii.CHAIN).sum() == 99
    assert len(pii.stretch(text, pii.graph_of(text))[1]) == 1000


def test_training_learns_the_patterns(spark, documents):
    field = pii.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    texts = [r["text"] for r in documents.collect()]
    right = wrong = 0
    for text in texts:
        graph = pii.graph_of(text)
        if graph is not None and len(graph.spans):
            labels = pii.token_labels(graph, pii.base_spans(text))
            hit = pii.marginals(field, graph).argmax(axis=1) == labels
            right, wrong = right + hit.sum(), wrong + (~hit).sum()
    assert right > 20 * max(wrong, 1) / 2 and right >= 20
    ((_, more),) = pii.find(["pay 4465758382889437 4465758382889437 now"], field)
    assert more == [("card", 4, 20), ("card", 21, 37)]


def test_pii_of_odd_rows(spark, odd, empty):
    field = pii.fit(odd)
    rows = pii.scan(odd, field).collect()
    assert len(rows) == len(odd_rows())
    nothing = next(r for r in rows if r["doc_id"] == 3)
    assert nothing["spans"] == "" and nothing["base_sha256"] == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert pii.scan(empty, pii.fit(empty)).count() == 0
    kept = pii.find(["mail a@b.example.com, host 10.0.0.1"], pii.Field(field.unary * 0, field.pair * 0, field.agree * 0))
    assert joined(sum(kept[0], []), pii.KINDS) == "email:5:20,ip:27:35"


# ------------------------------------------------------------------ the chains


def test_random_strings_stand_out(spark):
    rng = np.random.default_rng(0)
    model = markov.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    letters = np.array(list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"))
    caught = [bool(markov.find("x " + "".join(rng.choice(letters, 32)) + " y", model)[1]) for _ in range(50)]
    assert np.mean(caught) > 0.9
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert sum(len(markov.find(t, model)[1]) for t in texts) <= 2
    # spans of the patterns stay, and added ones never meet them
    secret = "token = 0123456789abcdef0123 " + "".join(rng.choice(letters, 40))
    base, more = markov.find(secret, model)
    assert {s[0] for s in base} == {"assign", "hex"} and all(s[1] > base[0][2] for s in more)


def names_of_code():
    """Ordinary identifiers that no training saw: names of the standard library, camel case, dates and paths."""
    import argparse, asyncio, decimal, email.message, http, inspect, logging.handlers, os, socket, ssl, tarfile, threading, typing, unittest

    modules = [argparse, asyncio, decimal, email.message, http, inspect, logging.handlers, os, socket, ssl, tarfile, threading, typing, unittest]
    names = set()
    for module in modules:
        for name in dir(module):
            names.update([name, *dir(getattr(module, name))])
    names = sorted(n for n in names if 12 <= len(n) <= 41)
    camel = ["".join(w.title() for w in n.split("_")) for n in names if n.islower() and n.strip("_").count("_") >= 2]
    more = ["getElementsByClassNameAndTagName", "2024-01-02T03-04-05", "src/main/java/com/example/web/App", "release-notes-2023-11-30"]
    return names, camel, more


def test_ordinary_identifiers_are_left_alone_and_random_strings_found(spark):
    model = markov.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))

    def shares(texts):
        return np.mean([bool(markov.find(f"see {t} there", model)[1]) for t in texts])

    names, camel, more = names_of_code()
    assert len(names) > 500 and len(camel) > 50
    assert shares(names) <= 0.02 and shares(camel) <= 0.02 and shares(more) == 0
    rng = np.random.default_rng(3)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"))
    for size in (24, 32):
        alone = ["".join(rng.choice(letters, size)) for _ in range(200)]
        assert shares(alone) >= 0.95
        assert shares([f"0123456789abcdef/{r}" for r in alone]) >= 0.95
        path = [markov.find(f"at src/main/resources/config/{r}", model)[1] for r in alone]
        assert np.mean([spans == [("markov", 29, 29 + size)] for spans in path]) >= 0.95
        joint = [f"{r[:12]}-{r[12:]}" for r in alone]
        assert shares(joint) >= 0.95


@pytest.mark.parametrize("copies", [1, 10])
def test_secrets_planted_in_the_fitted_table_are_found(spark, copies):
    """One document in a hundred holds a random string that no pattern meets; some strings stand in ten documents."""
    rng = np.random.default_rng(4)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"))
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = sorted(tuple(r) for r in docs.collect())
    planted, text = {}, ""
    for k, at in enumerate(range(0, len(rows), 100)):
        text = text if k % copies else "".join(rng.choice(letters, 32))
        doc_id, own = rows[at]
        planted[doc_id] = (len(own) + 1, len(own) + 33)
        rows[at] = (doc_id, f"{own} {text} end")
    model = markov.fit(spark.createDataFrame(rows, docs.schema))
    found = {(doc_id, a, b) for doc_id, own in rows for _, a, b in markov.find(own, model)[1]}
    want = {(doc_id, a, b) for doc_id, (a, b) in planted.items()}
    assert len(want) == 10 and found >= want and len(found - want) <= 2


def test_a_run_is_scored_without_its_own_counts():
    rng = np.random.default_rng(5)
    random = rng.integers(0, 5, (markov._STATES, markov._STATES)).astype(float)
    chains = [rng.integers(1, markov._STATES, 20) for _ in range(30)]
    counts = [markov._transitions(c, np.array([0]), np.array([20])) for c in chains]
    chain = markov.Identifiers(sum(counts[1:]))
    chain.single = markov.Identifiers(sum(counts)).single  # how often letters are found alone stays as it is
    known = markov._random_shares(random)
    steps = known - chain.log_steps(markov._FROM, markov._TO).reshape(known.shape)
    want = sum(steps[a, b] for a, b in zip([0, *chains[0]], chains[0]))
    assert abs(markov.held_out_ratio(random, sum(counts))(chains[0]) - want) < 1e-9


def test_ratio_matches_a_loop():
    rng = np.random.default_rng(1)
    steps = rng.normal(size=(markov._STATES, markov._STATES))
    text = "é abcdefghijklmn-XYZ_0123 end"
    codes = markov._codes(text)
    starts, ends = markov._candidates(markov._STATE[codes], [])
    (got,) = markov._scores(markov._STATE[codes], starts, ends, steps)
    run = text[starts[0] : ends[0]]
    states = [0, *[markov.ALPHABET.index(c) + 1 for c in run]]
    assert run == "abcdefghijklmn-XYZ_0123"
    assert abs(got - sum(steps[a, b] for a, b in zip(states, states[1:]))) < 1e-9


def test_secrets_of_odd_rows(odd, empty):
    rows = markov.scan(odd, markov.fit(odd)).collect()
    assert len(rows) == len(odd_rows())
    assert all(r["spans"] == "" for r in rows if r["doc_id"] in (3, 4, 8))
    assert markov.scan(empty, markov.fit(empty)).count() == 0
