"""Quality scores from supervised subword embeddings, trained by stochastic gradient descent in numpy.

Every word of a text (with a mark at each side) and its character n-grams are hashed into buckets; each
bucket has a learned vector, a text is the average of the vectors of its features, and a softmax layer
gives the probability of label 1.  Training reads a bounded sample of labelled rows (``SAMPLE_ROWS``, the
rows with the smallest id hashes) and runs in one task over their features; scoring streams over all rows.
As the softmax input is linear in the average, a bucket's share of it is computed once and scoring adds
up one number for each feature, which is the same sum in another order.

Texts are lower-cased nowhere and read whole.  Labels, language, source and id are no features.

Defined cases: a null text equals an empty one, which has the single feature of an empty word and so a
score.  A null label does not take part in training; a labelled id that occurs in several rows trains on
the smallest of their texts.  Without any usable label, or with labels of one kind only, every score is
the share of label 1 in the sample (0.5 without labels).  Repeated rows get equal scores.  An empty table
gives no rows.  Columns of other names are not read by ``scores`` and kept by ``accepted``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.llm.common import documents, fold, sample_by_hash, slices

SAMPLE_ROWS = 6000
BUCKET_BITS = 16
DIMENSIONS = 8
EPOCHS = 8
RATE = 2.0
NGRAMS = (3, 4)
FOLDS = 5
THRESHOLD = 0.3
_BLOCK_BYTES = 1 << 17

# Odd multipliers for hashing (fixed values): one for polynomial word hashes, one for mixing.
_POLYNOMIAL = 0x9E3779B97F4A7C15
_MIX = 0xD6E8FEB86659FD93
_MASK = (1 << 64) - 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & _MASK, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_POWERS = _powers(_POLYNOMIAL, _BLOCK_BYTES * 2)
_INVERSES = _powers(pow(_POLYNOMIAL, -1, 1 << 64), _BLOCK_BYTES * 2)


def _bucket(hashes: np.ndarray, kind: int, bits: int) -> np.ndarray:
    mixed = (hashes ^ np.uint64(kind)) * np.uint64(_MIX)
    mixed ^= mixed >> np.uint64(32)
    return ((mixed * np.uint64(_MIX)) >> np.uint64(64 - bits)).astype(np.int64)


def features(text: str, bits: int = BUCKET_BITS) -> Iterator[np.ndarray]:
    """Buckets of the words and the character n-grams inside words, block by block of the text's bytes.

    A block ends after the last white space that fits in it; a longer run without white space is cut.
    """
    raw = b" ".join(text.encode().split())
    start = 0
    while True:
        stop = min(start + _BLOCK_BYTES, len(raw))
        if stop < len(raw):
            cut = raw.rfind(b" ", start, stop)
            stop = cut if cut > start else stop
        yield _block(b" " + raw[start:stop] + b" ", bits)
        start = stop + (raw[stop : stop + 1] == b" ")
        if start >= len(raw):
            return


def _block(marked: bytes, bits: int) -> np.ndarray:
    codes = np.frombuffer(marked, np.uint8).astype(np.uint64)
    gaps = np.flatnonzero(codes == 32)
    first, last = gaps[:-1], gaps[1:]  # a word with the gap before it, up to the gap after it
    sums = np.add.reduceat(codes[:-1] * _POWERS[: len(codes) - 1], first) * _INVERSES[first]
    lengths = (last - first).astype(np.uint64)
    out = [_bucket(sums + lengths * np.uint64(_POLYNOMIAL), 1, bits)]
    gap = (codes == 32).astype(np.int8)
    for n in NGRAMS:
        if len(codes) < n:
            continue
        size = len(codes) - n + 1
        value = codes[:size].copy()
        inner = np.zeros(size, dtype=np.int8)
        for k in range(1, n):
            value = (value << np.uint64(8)) | codes[k : k + size]
            if k < n - 1:
                inner |= gap[k : k + size]
        out.append(_bucket(value[inner == 0], n, bits))  # a gap may stand at either end, not inside
    return np.concatenate(out)


@dataclass
class Model:
    vectors: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def margins(self) -> np.ndarray:
        """Each bucket's share of (softmax input of label 1) - (softmax input of label 0)."""
        return self.vectors @ (self.weights[:, 1] - self.weights[:, 0])

    def score(self, text: str, margins: np.ndarray, bits: int) -> float:
        total, n = 0.0, 0
        for block in features(text, bits):
            total += float(margins[block].sum())
            n += len(block)
        margin = total / max(n, 1) + float(self.bias[1] - self.bias[0])
        return float(1 / (1 + np.exp(-np.clip(margin, -500, 500))))


def train(
    rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, bits: int = BUCKET_BITS, seed: int = 7
) -> Model:
    """Stochastic gradient descent, one text at a time; ``rows`` hold (buckets, shares) of each text."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (1 << bits, DIMENSIONS))
    weights = np.zeros((DIMENSIONS, 2))
    bias = np.zeros(2)
    share = labels.mean() if len(labels) else 0.5
    if share in (0.0, 1.0) or not len(labels):
        only = np.clip(share, 1e-6, 1 - 1e-6)
        return Model(vectors * 0, weights, np.array([0.0, np.log(only / (1 - only))]))
    steps, done = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            rate = RATE * (1 - done / steps)
            done += 1
            buckets, shares = rows[i][0], rows[i][1].astype(float, copy=False)
            picked = vectors[buckets]
            hidden = shares @ picked
            z = hidden @ weights + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = weights @ p
            weights -= rate * 0.1 * np.outer(hidden, p)
            bias -= rate * 0.1 * p
            vectors[buckets] = picked - (rate * len(buckets) ** 0.5) * shares[:, None] * back
    return Model(vectors, weights, bias)


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The bounded sample: doc_id, quality and text of labelled rows outside the held-out fold."""
    usable = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (fold("doc_id", FOLDS) != 0))
    one = usable.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    sample = F.broadcast(sample_by_hash(one, "doc_id", rows))  # at most ``rows`` ids
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(sample, "doc_id")
    return texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("quality").alias("quality"))


def training_views(part: pa.Table) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """(buckets, shares) of each text in the order of the ids, and the labels.

    The arrays are views of the table: what a worker takes once it keeps for the jobs that follow.
    """
    order = np.argsort(part["doc_id"].to_numpy())
    cells = [
        (np.frombuffer(b.as_buffer(), "<i4"), np.frombuffer(s.as_buffer(), "<f4"))
        for b, s in zip(part["buckets"], part["shares"])
    ]
    return [cells[k] for k in order], part["quality"].to_numpy()[order].astype(int)


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, bits: int = BUCKET_BITS) -> Model:
    """Features are made in parallel; one task trains on the bounded sample."""

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            buckets, shares = [], []
            for text in texts:
                counts = np.zeros(1 << bits)
                for block in features(text, bits):
                    counts += np.bincount(block, minlength=1 << bits)
                own = np.flatnonzero(counts)
                buckets.append(own.astype("<i4").tobytes())
                shares.append((counts[own] / max(counts.sum(), 1)).astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(buckets, pa.binary()), pa.array(shares, pa.binary())],
                names=["doc_id", "quality", "buckets", "shares"],
            )

    def learn(part: pa.Table) -> pa.Table:
        model = train(*training_views(part), bits)
        packed = np.concatenate([model.margins(), model.bias]).astype("<f8").tobytes()
        return pa.table({"model": pa.array([packed], pa.binary())})

    sample = training_rows(docs, labels, rows).mapInArrow(
        sparse, "doc_id bigint, quality int, buckets binary, shares binary"
    )
    learned = sample.groupBy(F.lit(0).alias("_all")).applyInArrow(learn, "model binary").collect()
    if not learned:
        return Model(np.zeros((1 << bits, 1)), np.zeros((1, 2)), np.zeros(2))
    packed = np.frombuffer(learned[0]["model"], "<f8")
    # the margins are all that scoring needs: one-dimensional vectors with the weights (0, 1)
    return Model(packed[:-2].reshape(-1, 1).copy(), np.array([[0.0, 1.0]]), packed[-2:].copy())


def scores(docs: DataFrame, model: Model, bits: int = BUCKET_BITS) -> DataFrame:
    """``row`` (all columns of ``docs``, whatever their names) and ``score`` of every row."""
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    shared = docs.sparkSession.sparkContext.broadcast((model, model.margins()))  # 2 ** bits numbers

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, margins = shared.value
        for batch, texts in slices(batches, inside="row"):
            found = pa.array([own.score(t, margins, bits) for t in texts], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), found], names=["row", "score"])

    return rows.mapInArrow(work, T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())]))


def accepted(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose score reaches the threshold, in the columns of ``docs``."""
    good = scores(docs, model).filter(F.col("score") >= threshold)
    return good.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet")
    rows = scores(docs.select("doc_id", "text"), fit(docs, labels)).select("row.doc_id", "score")
    return rows.select(
        "doc_id",
        (fold("doc_id", FOLDS) == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
