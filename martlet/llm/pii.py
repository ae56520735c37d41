"""Personal data: fixed patterns, and a skip-chain conditional random field over a document's tokens.

The patterns find emails, addresses of hosts, cards and phones.  The field labels every token that has a
digit or an at sign (any other token is outside by definition, which leaves it out of the sums without
changing them).  Its potentials are weights of token features, weights of label pairs of neighbouring
tokens, and agreement weights of skip edges: a token is joined to an earlier token of the document with the
same content, however far away, and to an earlier one of the same shape.  Occurrence i of a content or shape
is joined to occurrence (i - 1) // 2, so any two are within a few edges of each other, however many there
are.  Loopy belief propagation passes messages over all edges until those of a document settle, so
labels of repeated or similar tokens agree across it.  Documents share a step but settle one by one: what is
found in one does not depend on its neighbours.  A token that the field gives a kind and that no pattern span meets becomes a span of that
kind, together with its neighbours of that kind.

Weights are trained by the gradient of the pseudo-likelihood on a bounded sample (``SAMPLE_ROWS`` rows
with such tokens, the ones with the smallest id hashes), labelled by the patterns.  A text of more than
``STRETCH`` such tokens trains on one unbroken stretch of that many, with all edges inside it.

Defined cases: a null text is empty and has no spans.  Rows with a null id do not train; an id that
repeats trains on its smallest text.  Without any token in the sample all weights are
zero and the field adds nothing.  Equal marginals go to the outside label, then to the kind listed first.
Repeated rows give equal results.  An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.llm.common import documents, sampled_texts, slices
from martlet.llm.spans import Cover, Span, digest, joined

SAMPLE_ROWS = 3000
STRETCH = 2000  # neighbouring tokens of one sampled text that train
DAMPING = 0.3
SETTLED = 1e-6
PATIENCE = 200  # turns before the steps shrink, so that messages which go back and forth settle too
SHRINK = 0.99
_EDGES = 1 << 15
STEPS = 300
RATE = 1.0
RIDGE = 1e-4

# Kinds in order and their patterns (written so that no text makes them slow).
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
EDGES = "\"'()[]{}<>,;:!?*#$%&|.=`~_-"

LABELS = len(KINDS) + 1  # 0 is outside
CHAIN, SAME, SHAPE = range(3)


# ------------------------------------------------------------------ patterns


def luhn(digits: str) -> bool:
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 * (d > 9) for d in doubled)) % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """At each at sign with a domain: the run before it, as far as the match before has left it."""
    free = 0
    for m in DOMAIN.finditer(text):
        at, start = m.start(), m.start()
        while start > free and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        if start < at:
            yield ("email", start, m.end())
            free = m.end()


def base_spans(text: str) -> list[Span]:
    out = list(_emails(text)) if "@" in text else []
    if DIGIT.search(text):
        if "." in text:
            for m in IP.finditer(text):
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                    out.append(("ip", m.start(), m.end()))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                    out.append(("phone", m.start(), m.end()))
    return out


# ------------------------------------------------------------------ the graph of a text


@dataclass
class Graph:
    """Tokens with features and edges; tokens of many texts may lie in one graph."""

    spans: np.ndarray  # start and end of each token, trimmed
    features: np.ndarray  # one row of 0 and 1 for each token
    edges: np.ndarray  # rows of (token, later token, edge kind)
    texts: np.ndarray | None = None  # which text each token is from, if there are several


def _features(core: str, before: str, after: str) -> list[int]:
    digits = "".join(c for c in core if "0" <= c <= "9")
    n, dots = len(digits), core.count(".")
    groups = core.split(".")
    quad = len(groups) == 4 and all(g.isdigit() and g.isascii() for g in groups)
    return [
        1,
        "@" in core,
        "@" in core and "." in core.rpartition("@")[2].strip("."),
        n == 0,
        0 < n <= 3,
        4 <= n <= 7,
        8 <= n <= 11,
        12 <= n <= 19,
        n >= 20,
        dots == 3,
        0 < dots < 3,
        dots > 3,
        quad,
        quad and all(len(g) <= 3 and int(g) <= 255 for g in groups),
        core.startswith("+"),
        "+" in before,
        "+" in after,
        "(" in core or ")" in core,
        "(" in before or ")" in before,
        "(" in after or ")" in after,
        "-" in core.strip("-"),
        any(c.isalpha() for c in core),
        12 <= n <= 19 and luhn(digits),
        12 <= n <= 19 and n == len(core.replace("-", "")),
        any("0" <= c <= "9" for c in before),
        any("0" <= c <= "9" for c in after),
        "=" in core or ":" in core,
    ]


FEATURES = len(_features("", "", ""))
WHOLE = [1, 7, 12]  # places of the features for an at sign, 12 to 19 digits and four groups


def _shape(core: str) -> str:
    return re.sub(r"[0-9]+", "9", re.sub(r"[^\W\d_]+", "a", core))


def _active(token: str) -> bool:
    return "@" in token or DIGIT.search(token) is not None


def _joined(held: list[int], me: int) -> int | None:
    """Add a token to the earlier ones; the one it is joined to, half-way to the first."""
    held.append(me)
    return held[(len(held) - 2) // 2] if len(held) > 1 else None


def graph_of(text: str) -> Graph | None:
    """None if no token has a digit or an at sign."""
    if "@" not in text and not DIGIT.search(text):
        return None
    spans, features, edges = [], [], []
    same: dict[str, list[int]] = {}
    alike: dict[str, list[int]] = {}
    tokens = TOKEN.finditer(text)
    before, token = "", next(tokens, None)
    last_active = -2
    place = 0
    while token is not None:
        after = next(tokens, None)
        own = token[0]
        if _active(own):
            bare = own.lstrip(EDGES)
            start = token.start() + len(own) - len(bare)
            core = bare.rstrip(EDGES)
            me = len(spans)
            spans.append((start, start + len(core)))
            features.append(_features(core if core else own, before, after[0] if after else ""))
            if last_active == place - 1:
                edges.append((me - 1, me, CHAIN))
            twin = _joined(same.setdefault(core.lower(), []), me)
            kin = _joined(alike.setdefault(_shape(core), []), me)
            if twin is not None:
                edges.append((twin, me, SAME))
            if kin is not None and kin != twin:
                edges.append((kin, me, SHAPE))
            last_active = place
        before, token = own, after
        place += 1
    return Graph(
        np.array(spans).reshape(-1, 2), np.array(features, dtype=np.int8).reshape(-1, FEATURES), np.array(edges, dtype=np.int64).reshape(-1, 3)
    )


def together(graphs: list[Graph]) -> Graph:
    shift = np.cumsum([0, *[len(g.spans) for g in graphs]])
    edges = [g.edges + np.array([s, s, 0]) for g, s in zip(graphs, shift)]
    return Graph(
        np.concatenate([g.spans for g in graphs]),
        np.concatenate([g.features for g in graphs]),
        np.concatenate(edges),
        np.repeat(np.arange(len(graphs)), [len(g.spans) for g in graphs]),
    )


# ------------------------------------------------------------------ the field


@dataclass
class Field:
    unary: np.ndarray  # features by labels
    pair: np.ndarray  # label of a token by label of the next token
    agree: np.ndarray  # weight of agreement on SAME and SHAPE edges

    def edge_potentials(self, kinds: np.ndarray) -> np.ndarray:
        same = np.eye(LABELS)
        table = np.stack([self.pair, self.agree[0] * same, self.agree[1] * same])
        return table[kinds]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def _beliefs(own: np.ndarray, a: np.ndarray, b: np.ndarray, ahead: np.ndarray, back: np.ndarray) -> np.ndarray:
    out = own.copy()
    np.add.at(out, b, ahead)
    np.add.at(out, a, back)
    return out


def _turn(field: Field, held: np.ndarray, edges: np.ndarray, ahead: np.ndarray, back: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The next messages of all edges, some edges at a time."""
    to_b, to_a = np.empty_like(ahead), np.empty_like(back)
    for c in range(0, len(edges), _EDGES):
        at = slice(c, c + _EDGES)
        a, b, kind = edges[at].T
        table = field.edge_potentials(kind)
        to_b[at] = _log_sum((held[a] - back[at])[:, :, None] + table, 1)
        to_a[at] = _log_sum((held[b] - ahead[at])[:, None, :] + table, 2)
    return to_b - to_b.max(axis=1, keepdims=True), to_a - to_a.max(axis=1, keepdims=True)


def marginals(field: Field, graph: Graph, damping: float = DAMPING, settled: float = SETTLED) -> np.ndarray:
    """Label probabilities of each token by loopy belief propagation (exact where the graph is a forest).

    A text whose messages change by less than ``settled`` keeps them and takes no further turn.
    """
    own = graph.features @ field.unary
    edges = graph.edges
    texts = graph.texts if graph.texts is not None else np.zeros(len(own), np.int64)
    ahead, back = np.zeros((len(edges), LABELS)), np.zeros((len(edges), LABELS))  # messages to the later token and back
    moving, step, turn = np.arange(len(edges)), 1 - damping, 0
    while len(moving):
        # the edges of the texts that have not settled, until half of these have
        tokens, ends = np.unique(edges[moving, :2], return_inverse=True)
        part = np.column_stack([ends.reshape(-1, 2), edges[moving, 2]])
        names, text = np.unique(texts[edges[moving, 0]], return_inverse=True)
        open_, mine, go, come = np.ones(len(names), bool), own[tokens], ahead[moving], back[moving]
        while 2 * open_.sum() > len(open_):
            held = _beliefs(mine, part[:, 0], part[:, 1], go, come)
            to_b, to_a = _turn(field, held, part, go, come)
            move_b, move_a = step * (to_b - go), step * (to_a - come)
            change = np.zeros(len(names))
            np.maximum.at(change, text, np.maximum(np.abs(move_b).max(axis=1), np.abs(move_a).max(axis=1)))
            some = open_[text]
            go[some] += move_b[some]
            come[some] += move_a[some]
            open_ &= change >= settled
            turn += 1
            step *= SHRINK if turn > PATIENCE else 1
        ahead[moving], back[moving] = go, come
        moving = moving[open_[text]]
    out = _beliefs(own, edges[:, 0], edges[:, 1], ahead, back)
    return np.exp(out - _log_sum(out, 1)[:, None])


def train(graph: Graph, labels: np.ndarray, steps: int = STEPS) -> Field:
    """Gradient ascent on the pseudo-likelihood: each token given the labels of its neighbours."""
    field = Field(np.zeros((FEATURES, LABELS)), np.zeros((LABELS, LABELS)), np.zeros(2))
    n = len(labels)
    if not n:
        return field
    a, b, kind = graph.edges.T
    known = np.eye(LABELS)[labels]
    x = graph.features.astype(float)
    speed = [np.full_like(w, 1e-8) for w in (field.unary, field.pair, field.agree)]
    chain, skips = kind == CHAIN, [kind == SAME, kind == SHAPE]
    for _ in range(steps):
        score = x @ field.unary
        np.add.at(score, b[chain], field.pair[labels[a[chain]]])
        np.add.at(score, a[chain], field.pair[:, labels[b[chain]]].T)
        for w, some in zip(field.agree, skips):
            np.add.at(score, b[some], w * known[a[some]])
            np.add.at(score, a[some], w * known[b[some]])
        gap = known - np.exp(score - _log_sum(score, 1)[:, None])
        pair = known[a[chain]].T @ gap[b[chain]] + gap[a[chain]].T @ known[b[chain]]
        agree = [(gap[b[s]] * known[a[s]]).sum() + (gap[a[s]] * known[b[s]]).sum() for s in skips]
        for w, g, s in zip((field.unary, field.pair, field.agree), (x.T @ gap, pair, np.array(agree)), speed):
            g = g / n - RIDGE * w
            s += g * g
            w += RATE * g / np.sqrt(s) * 0.3
    return field


def token_labels(graph: Graph, base: list[Span]) -> np.ndarray:
    """The kind of the pattern span that meets each token, the one listed first if several do."""
    out = np.zeros(len(graph.spans), dtype=np.int64)
    for k in range(len(KINDS), 0, -1):
        cover = Cover([s for s in base if s[0] == KINDS[k - 1]])
        if cover.merged:
            meets = [cover.meets(int(s), max(int(e), int(s) + 1)) for s, e in graph.spans]
            out[np.array(meets)] = k
    return out


def stretch(text: str, graph: Graph, tokens: int = STRETCH) -> tuple[Graph, np.ndarray]:
    """Graph and labels of a text, or of the unbroken stretch of ``tokens`` tokens that a hash of the text picks."""
    base = base_spans(text)
    more = len(graph.spans) - tokens
    if more > 0:
        first = zlib.crc32(text.encode()) % (more + 1)
        a, b = int(graph.spans[first, 0]), int(graph.spans[first + tokens - 1, 1])
        base = [(kind, max(start, a) - a, min(end, b) - a) for kind, start, end in base if start < b and end > a]
        graph = graph_of(text[a:b])
    return graph, token_labels(graph, base)


def added_spans(graph: Graph, chance: np.ndarray, base: list[Span]) -> list[Span]:
    """Runs of neighbouring tokens of one kind that meet no pattern span.

    A token that is whole by itself (an address, four groups, a long number) is a span of its own.
    """
    kinds = chance.argmax(axis=1)
    whole = graph.features[:, WHOLE].any(axis=1)
    linked = {int(later) for earlier, later, kind in graph.edges if kind == CHAIN}
    cover, out = Cover(base), []
    for k, (start, end) in enumerate(graph.spans.tolist()):
        if kinds[k] == 0 or end <= start or cover.meets(start, end):
            continue
        kind = KINDS[kinds[k] - 1]
        part = k in linked and not (whole[k] or whole[k - 1])
        if part and out and out[-1][0] == kind and out[-1][2] == int(graph.spans[k - 1][1]):
            if not cover.meets(out[-1][1], end):
                out[-1] = (kind, out[-1][1], end)
                continue
        out.append((kind, start, end))
    return out


# ------------------------------------------------------------------ on Spark


def fit(docs: DataFrame, rows: int = SAMPLE_ROWS) -> Field:
    """Graphs of the sample are made in parallel; one task trains on them."""
    sample = sampled_texts(docs.filter(F.col("text").rlike("[0-9@]")), rows)

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            packed = []
            for text in texts:
                graph = graph_of(text)
                if graph is None:
                    packed.append(None)
                    continue
                graph, labels = stretch(text, graph)
                sizes = np.array([len(labels), len(graph.edges)])
                parts = [sizes, labels, graph.features.astype(np.int64).reshape(-1), graph.edges.reshape(-1)]
                packed.append(np.concatenate(parts).astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["doc_id", "graph"])

    def learn(part: pd.DataFrame) -> pd.DataFrame:
        graphs, labels = [], []
        for raw in part.sort_values("doc_id")["graph"]:
            held = np.frombuffer(raw, "<i8")
            tokens, edges = held[:2]
            at = np.cumsum([2, tokens, tokens * FEATURES, edges * 3])
            labels.append(held[at[0] : at[1]])
            features = held[at[1] : at[2]].reshape(-1, FEATURES)
            graphs.append(Graph(np.zeros((tokens, 2), dtype=np.int64), features, held[at[2] : at[3]].reshape(-1, 3)))
        field = train(together(graphs), np.concatenate(labels))
        parts = [field.unary.reshape(-1), field.pair.reshape(-1), field.agree]
        return pd.DataFrame({"weights": [np.concatenate(parts).astype("<f8").tobytes()]})

    ready = sample.mapInArrow(prepare, "doc_id bigint, graph binary").filter(F.col("graph").isNotNull())
    learned = ready.groupBy(F.lit(0).alias("_all")).applyInPandas(learn, "weights binary").collect()
    if not learned:
        return Field(np.zeros((FEATURES, LABELS)), np.zeros((LABELS, LABELS)), np.zeros(2))
    held = np.frombuffer(learned[0]["weights"], "<f8")
    cut = FEATURES * LABELS
    return Field(held[:cut].reshape(FEATURES, LABELS), held[cut:-2].reshape(LABELS, LABELS), held[-2:])


def find(texts: list[str], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """Pattern spans and added spans of each text; messages pass over all texts at once."""
    base = [base_spans(t) for t in texts]
    graphs = [graph_of(t) for t in texts]
    active = [k for k, g in enumerate(graphs) if g is not None and len(g.spans)]
    more: dict[int, list[Span]] = {}
    if active:
        chance = marginals(field, together([graphs[k] for k in active]))
        ends = np.cumsum([len(graphs[k].spans) for k in active])
        for k, part in zip(active, np.split(chance, ends[:-1])):
            more[k] = added_spans(graphs[k], part, base[k])
    return [(own, more.get(k, [])) for k, own in enumerate(base)]


def scan(docs: DataFrame, field: Field) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(field)  # a few hundred weights
    names = ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            rows = []
            for base, more in find(texts, shared.value):
                n = [sum(s[0] == kind for s in base) for kind in KINDS]
                rows.append((*n, digest(joined(base, KINDS)), joined(base + more, KINDS), len(more)))
            kinds = [pa.int64()] * len(KINDS) + [pa.string(), pa.string(), pa.int64()]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return docs.select("doc_id", "text").mapInArrow(
        work, f"doc_id bigint, {counts}, base_sha256 string, spans string, n_added bigint"
    )


def op2_skip_chain_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return scan(docs, fit(docs))
