"""Language identification by nearest centroids of TF-IDF character n-grams.

A text is lower-cased, everything but letters becomes a gap, and its byte n-grams (whole words with their
gaps included) are counted in hashed buckets, weighted by inverse document frequency and normalised.
Each language has several centroids, found by spherical k-means on a bounded sample of its rows
(``SAMPLE_ROWS`` each, the rows with the smallest id hashes), every language in its own task.  A text
gets the language of the centroid with the greatest cosine.  The distance at which the training rows of
a centroid end (a high quantile, with a margin) rejects texts that are near no centroid: ``rejected``.

Defined cases: a text that is null or holds no letter is ``und`` with score 0 and is rejected.  Rows with
a null language or id do not train.  Without any training rows every text is ``und``.  Equal cosines go to the
language that comes first in alphabetical order.  Repeated rows get equal results; ids that repeat train
on the smallest text.  An empty table gives no rows.  Columns of other names are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.llm.common import documents, fold, sampled_texts, slices

SAMPLE_ROWS = 600
BUCKET_BITS = 13
NGRAMS = (2, 3)
CENTROIDS = 3
TURNS = 8
QUANTILE = 0.995
MARGIN = 1.25
FOLDS = 3
UNKNOWN = "und"
_BLOCK = 1 << 17
# ASCII bytes that are no letters become gaps; bytes of other characters stay.
_GAPS = bytes(32 if b < 128 and not chr(b).isalpha() else b for b in range(256))
_MULTIPLIER = np.uint32(0x9E3779B1)  # odd multiplier for hashing


def counts(text: str, bits: int = BUCKET_BITS) -> np.ndarray | None:
    """How often each n-gram bucket occurs; None without a letter."""
    if not any(map(str.isalpha, text)):
        return None
    raw = b" ".join(text.lower().encode().translate(_GAPS).split())
    out = np.zeros(1 << bits)
    for start in range(0, len(raw), _BLOCK):
        # each block sees the bytes that its last n-grams reach into
        codes = np.frombuffer(b" " * (start == 0) + raw[start : start + _BLOCK + max(NGRAMS) - 1] + b" ", np.uint8)
        codes = codes.astype(np.uint32)
        for n in NGRAMS:
            size = min(len(codes) - n + 1, _BLOCK + (start == 0))
            if size <= 0:
                continue
            value = codes[:size].copy()
            for k in range(1, n):
                value = (value << np.uint32(8)) | codes[k : k + size]
            value = (value + np.uint32(n)) * _MULTIPLIER
            out += np.bincount((value >> np.uint32(32 - bits)).astype(np.int64), minlength=1 << bits)
    return out


@dataclass
class Centroids:
    langs: list[str]  # one for each centroid, in alphabetical order
    unit: np.ndarray  # centroids, one row each
    least: np.ndarray  # smallest cosine that is not rejected
    idf: np.ndarray

    def predict(self, text: str, bits: int) -> tuple[str, float, bool]:
        found = counts(text, bits) if self.langs else None
        if found is None:
            return UNKNOWN, 0.0, True
        vector = found * self.idf
        norm = np.sqrt(vector @ vector)
        if norm == 0:
            return UNKNOWN, 0.0, True
        near = self.unit @ vector / norm
        top = int(near.argmax())
        return self.langs[top], float(np.clip(near[top], 0, 1)), bool(near[top] < self.least[top])


def cluster(vectors: np.ndarray, k: int = CENTROIDS, turns: int = TURNS, seed: int = 11) -> np.ndarray:
    """Spherical k-means; the rows of ``vectors`` have length one."""
    rng = np.random.default_rng(seed)
    centres = vectors[rng.choice(len(vectors), min(k, len(vectors)), replace=False)]
    for _ in range(turns):
        own = (vectors @ centres.T).argmax(axis=1)
        sums = np.stack([vectors[own == c].sum(axis=0) if (own == c).any() else centres[c] for c in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres


def fit(docs: DataFrame, rows: int = SAMPLE_ROWS, bits: int = BUCKET_BITS) -> Centroids:
    """Centroids from the rows of ``docs`` outside the held-out fold."""
    usable = docs.filter(F.col("lang").isNotNull() & (fold("doc_id", FOLDS) != 1))
    sample = sampled_texts(usable, rows, "lang", by="lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, own in slices(batches):
            packed = []
            for text in own:
                found = counts(text, bits)
                packed.append(None if found is None else found.astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["doc_id", "lang", "counts"]
            )

    counted = sample.mapInArrow(count, "doc_id bigint, lang string, counts binary").filter("counts IS NOT NULL")

    def document_frequency(part: pd.DataFrame) -> pd.DataFrame:
        seen = sum((np.frombuffer(c, "<f4") > 0).astype(float) for c in part["counts"])
        return pd.DataFrame({"n": [len(part)], "seen": [seen.tobytes()]})

    shares = counted.groupBy("lang").applyInPandas(document_frequency, "n bigint, seen binary").collect()
    if not shares:
        return Centroids([], np.zeros((0, 1 << bits)), np.zeros(0), np.ones(1 << bits))
    seen = sum(np.frombuffer(r["seen"]) for r in shares)
    idf = np.log((1 + sum(r["n"] for r in shares)) / (1 + seen)) + 1

    def centroids(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("doc_id")
        vectors = np.stack([np.frombuffer(c, "<f4") for c in part["counts"]]) * idf
        vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
        centres = cluster(vectors)
        near = vectors @ centres.T
        own = near.argmax(axis=1)
        far = [1 - np.quantile(near[own == c, c], 1 - QUANTILE) if (own == c).any() else 1.0 for c in range(len(centres))]
        return pd.DataFrame(
            {
                "lang": part["lang"].iloc[0],
                "centre": [c.astype("<f8").tobytes() for c in centres],
                "least": [1 - MARGIN * f for f in far],
            }
        )

    found = counted.groupBy("lang").applyInPandas(centroids, "lang string, centre binary, least double").collect()
    found = sorted(found, key=lambda r: r["lang"])  # a few rows for each language
    return Centroids(
        [r["lang"] for r in found],
        np.stack([np.frombuffer(r["centre"], "<f8") for r in found]),
        np.array([r["least"] for r in found]),
        idf,
    )


def predictions(docs: DataFrame, model: Centroids, bits: int = BUCKET_BITS) -> DataFrame:
    """doc_id, lang_pred, score and rejected of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few centroids for each language

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch, texts in slices(batches):
            rows = [own.predict(t, bits) for t in texts]
            langs, near, away = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(near, pa.float64()), pa.array(away, pa.bool_())],
                names=["doc_id", "lang_pred", "score", "rejected"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        work, "doc_id bigint, lang_pred string, score double, rejected boolean"
    )


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    rows = predictions(docs, fit(docs))
    held_out = (fold("doc_id", FOLDS) == 1).alias("held_out")
    return rows.select("doc_id", held_out, "lang_pred", "score", "rejected")
