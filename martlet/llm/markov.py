"""Secrets: fixed patterns, and character Markov models that tell random strings from identifiers.

Two first-order Markov models over characters are trained from labelled samples: the values that the
patterns find are the random strings, the other runs of the same alphabet are the ordinary identifiers and
words.  A stretch of at least ``MIN_RUN`` characters outside the pattern spans is a secret if its
log-likelihood ratio exceeds ``LOG_ODDS``, a fixed value: one in e^7 (about 1,100) is taken to be a secret
before it is looked at.  Stretches are looked at whole and in pieces between ``/``, ``=``, ``_`` and ``-``:
a random piece at the end of a path is found alone, and random pieces whose rest is random too are one secret.

Both chains step from character to character.  The random one is smoothed towards characters drawn at random.
Of ordinary identifiers a sample shows but a few, so their chain is tied: a step between kinds of characters
(small letter, capital, digit, mark) times a step between letters of either case.  The step between kinds is
mixed with a fixed share of steps of common styles of writing (``STYLES``), the step between letters with a
share of letters drawn alike, for names and languages that the sample lacks; a capital behind a small letter
starts a word.

The sample holds secrets that no pattern meets.  They must not pass for identifiers, so each distinct run
counts once, and the runs whose ratio exceeds ``LOG_ODDS`` with their own steps taken off the counts
are left out of the second and last count.

The sample is the ``SAMPLE_ROWS`` rows with the smallest id hashes; transitions are counted in parallel
and two small matrices reach the driver.  Every whole text is then scanned with array operations.

Defined cases: a null text is empty and has no spans.  Rows with a null id do not train; an id that
repeats trains on its smallest text.  Without any random string or identifier in the
sample, its model is the smoothing alone.  Ties do not arise: spans are ordered by start, then kind.
Repeated rows give equal results.  An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.llm.common import documents, keep, sampled_texts, slices
from martlet.llm.spans import Span, digest, joined

SAMPLE_ROWS = 20_000
MIN_RUN = 12
TRAIN_RUN = 4
RANDOM_PRIOR = 4.0
LETTER_PRIOR = 20.0
ANY_LETTER = 0.3  # share of letters drawn alike in a step to a letter
STYLE = 0.5  # share of STYLES in a step between kinds of characters
LOG_ODDS = 7.0

# The base patterns, their kinds in order, and the alphabet of runs.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
HEX = "0123456789abcdef"

_STATES = len(ALPHABET) + 1  # state 0 is the outside
_STATE = np.zeros(129, dtype=np.int64)
_STATE[[ord(c) for c in ALPHABET]] = np.arange(1, _STATES)
_KIND = np.repeat([0, 1, 2, 3, 4], [1, 26, 26, 10, 5])  # of each state: outside, small, capital, digit, mark
_LETTER = np.concatenate([[0], np.arange(1, 27), np.arange(1, 27), np.zeros(15, np.int64)])
_SPLITS = np.isin(np.arange(_STATES), [ALPHABET.index(c) + 1 for c in "/=_-"])
_IS_HEX = np.zeros(129, dtype=bool)
_IS_HEX[[ord(c) for c in HEX]] = True


def _codes(text: str) -> np.ndarray:
    """Code points, those beyond ASCII as 128."""
    return np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), 128)


def _runs(inside: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the longest stretches of True that have at least ``least`` places."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], inside.view(np.int8), [0]])))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= least
    return starts[long], ends[long]


def base_spans(text: str, codes: np.ndarray | None = None) -> list[Span]:
    out: list[Span] = []
    if "=" in text or ":" in text:
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    starts, ends = _runs(_IS_HEX[_codes(text) if codes is None else codes], 16)
    return out + [("hex", int(a), int(b)) for a, b in zip(starts, ends)]


def _transitions(states: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Counts of (state, next state) inside the runs, the step into each run included."""
    out = np.zeros(_STATES * _STATES)
    for a, b in zip(starts, ends):
        chain = np.concatenate([[0], states[a:b]])
        out += np.bincount(chain[:-1] * _STATES + chain[1:], minlength=_STATES * _STATES)
    return out.reshape(_STATES, _STATES)


@dataclass
class Ratio:
    """Log-likelihood ratio of each transition, and the ratio that a secret exceeds."""

    steps: np.ndarray
    threshold: float


def _random_shares(counts: np.ndarray) -> np.ndarray:
    own = counts + RANDOM_PRIOR
    own[:, 0] = 0  # a run never steps outside
    return np.log(np.maximum(own, 1e-300) / own.sum(axis=1, keepdims=True))


def _tied(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the steps a to b between kinds (5 x 5) and between letters (27 x 27; row 0 starts a word)."""
    starts = (_LETTER[a] == 0) | ((_KIND[a] == 1) & (_KIND[b] == 2))
    return _KIND[a] * 5 + _KIND[b], np.where(starts, 0, _LETTER[a]) * 27 + _LETTER[b]


_FROM, _TO = (x.reshape(-1) for x in np.indices((_STATES, _STATES)))
_KIND_CELLS, _LETTER_CELLS = _tied(_FROM, _TO)
# How names in any style of writing step from outside, small letter, capital, digit and mark to each of these,
# and which marks of "+/_=-" they use: a prior, not fitted to any table.
STYLES = np.array(
    [
        [0.0, 0.5, 0.3, 0.1, 0.1],
        [0.0, 0.85, 0.06, 0.03, 0.06],
        [0.0, 0.3, 0.55, 0.05, 0.1],
        [0.0, 0.15, 0.15, 0.5, 0.2],
        [0.0, 0.45, 0.3, 0.15, 0.1],
    ]
).reshape(-1)
MARKS = np.array([0.04, 0.3, 0.3, 0.06, 0.3])
_ALONE = np.concatenate([np.full(63, 1 / 10), MARKS])  # of each state that is no letter, among its kind


class Identifiers:
    """The chain of ordinary identifiers from the counts of their steps."""

    def __init__(self, counts: np.ndarray):
        self.kinds = np.bincount(_KIND_CELLS, counts.reshape(-1), 25)
        self.letters = np.bincount(_LETTER_CELLS, counts.reshape(-1), 27 * 27)
        self.letters[::27] = 0
        self.of_kind, self.of_letter = self.kinds.reshape(5, 5).sum(axis=1), self.letters.reshape(27, 27).sum(axis=1)
        single = self.letters.reshape(27, 27).sum(axis=0) + 1
        self.single = single / single[1:].sum()

    def log_steps(self, a: np.ndarray, b: np.ndarray, without: bool = False) -> np.ndarray:
        """Logarithms of the chances of steps; with ``without`` these steps themselves are taken off the counts."""
        kind, letter = _tied(a, b)
        k, k_all = self.kinds[kind], self.of_kind[kind // 5]
        n, n_all = self.letters[letter], self.of_letter[letter // 27]
        is_letter = _LETTER[b] > 0
        if without:
            k, k_all = k - np.bincount(kind)[kind], k_all - np.bincount(kind // 5)[kind // 5]
            n = n - np.bincount(letter[is_letter], minlength=27 * 27)[letter]
            n_all = n_all - np.bincount(letter[is_letter] // 27, minlength=27)[letter // 27]
        known = (k + STYLES[kind]) / (k_all + 1)
        drawn = (n + LETTER_PRIOR * self.single[letter % 27]) / (n_all + LETTER_PRIOR)
        inside = np.where(is_letter, (1 - ANY_LETTER) * drawn + ANY_LETTER / 26, _ALONE[b])
        return np.log(np.maximum((1 - STYLE) * known + STYLE * STYLES[kind], 1e-300)) + np.log(inside)


def ratios(random: np.ndarray, ordinary: np.ndarray) -> np.ndarray:
    steps = Identifiers(ordinary).log_steps(_FROM, _TO).reshape(_STATES, _STATES)
    out = _random_shares(random) - steps
    out[:, 0] = 0
    return out


def held_out_ratio(random: np.ndarray, ordinary: np.ndarray) -> Callable[[np.ndarray], float]:
    """The ratio of a run that ``ordinary`` counts, its own steps taken off."""
    known, chain = _random_shares(random), Identifiers(ordinary)

    def ratio(states: np.ndarray) -> float:
        a, b = np.concatenate([[0], states[:-1]]), states
        return float((known[a, b] - chain.log_steps(a, b, without=True)).sum())

    return ratio


def _candidates(states: np.ndarray, base: list[Span], least: int = MIN_RUN, pieces: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of the alphabet outside the pattern spans, or of their pieces."""
    inside = (states > 0) & ~_SPLITS[states] if pieces else states > 0
    for _, start, end in base:
        inside[start:end] = False
    return _runs(inside, least)


def _scores(states: np.ndarray, starts: np.ndarray, ends: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Ratio of each stretch."""
    gain = np.concatenate([[0.0], steps[states[:-1], states[1:]].cumsum()]) if len(states) else np.zeros(1)
    return steps[0, states[starts]] + gain[ends - 1] - gain[starts]


def _value(text: str, span: Span) -> tuple[int, int]:
    """Where the random string of a pattern span lies."""
    if span[0] == "assign":
        found = ASSIGN.match(text, span[1])
        return found.start(2), found.end(2)
    return span[1], span[2]


def _count(runs: DataFrame, counts: np.ndarray | None = None) -> np.ndarray:
    """Transitions of the random strings and of the identifiers; with ``counts``, without the secrets among these."""
    odd = None if counts is None else held_out_ratio(*counts)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, _STATES, _STATES))
        for batch, texts in slices(batches):
            for ordinary, text in zip(batch.column(1).to_pylist(), texts):
                states = _STATE[_codes(text)]
                if not (ordinary and odd and odd(states) > LOG_ODDS):
                    sums[int(ordinary)] += _transitions(states, np.array([0]), np.array([len(states)]))
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums.reshape(-1)[at])], names=["at", "n"])

    # at most 2 * 68 * 68 sums
    out = np.zeros(2 * _STATES * _STATES)
    for at, n in runs.mapInArrow(work, "at bigint, n double").groupBy("at").agg(F.sum("n")).collect():
        out[at] = n
    return out.reshape(2, _STATES, _STATES)


def fit(docs: DataFrame, rows: int = SAMPLE_ROWS) -> Ratio:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in slices(batches):
            random, ordinary = set(), set()
            for text in texts:
                codes = _codes(text)
                base = base_spans(text, codes)
                random.update(text[slice(*_value(text, s))] for s in base)
                ordinary.update(text[a:b] for a, b in zip(*_candidates(_STATE[codes], base, TRAIN_RUN)))
            found = [pa.array([*random, *ordinary], pa.string()), pa.array([False] * len(random) + [True] * len(ordinary))]
            yield pa.RecordBatch.from_arrays(found, names=["text", "ordinary"])

    found = sampled_texts(docs, rows).mapInArrow(cut, "text string, ordinary boolean")
    runs = keep(found.distinct(), "secrets-runs")
    random, ordinary = _count(runs, _count(runs))
    return Ratio(ratios(random, ordinary), LOG_ODDS)


def find(text: str, model: Ratio | None) -> tuple[list[Span], list[Span]]:
    """Pattern spans and the spans that the models add."""
    codes = _codes(text)
    base = base_spans(text, codes)
    if model is None:
        return base, []
    states = _STATE[codes]
    starts, ends = _candidates(states, base)
    if not len(starts):
        return base, []
    whole = _scores(states, starts, ends, model.steps)
    firsts, lasts = _candidates(states, base, pieces=True)
    single = _scores(states, firsts, lasts, model.steps)
    firsts, lasts, single = (x[single > model.threshold] for x in (firsts, lasts, single))
    owner = np.searchsorted(starts, firsts, side="right") - 1
    rest = whole - np.bincount(owner, single, len(starts))
    some = np.bincount(owner, minlength=len(starts)) > 0
    high = (whole > model.threshold) & (~some | (rest > 0))
    spans = [*zip(starts[high], ends[high]), *zip(firsts[~high[owner]], lasts[~high[owner]])]
    return base, [("markov", int(a), int(b)) for a, b in sorted(spans)]


def scan(docs: DataFrame, model: Ratio) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two small matrices
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_markov"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            rows = []
            for text in texts:
                base, more = find(text, shared.value)
                n = [sum(s[0] == kind for s in base) for kind in KINDS[:3]]
                rows.append((*n, digest(joined(base, KINDS)), joined(base + more, KINDS), len(more)))
            kinds = [pa.int64()] * 3 + [pa.string(), pa.string(), pa.int64()]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    return docs.select("doc_id", "text").mapInArrow(
        work,
        "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_markov bigint",
    )


def op4_markov_secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return scan(docs, fit(docs))
