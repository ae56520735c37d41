"""Near duplicates by SimHash, found with a segment-popcount embedding.

A fingerprint is mapped to the number of set bits in each of its 16 four-bit segments.  One differing bit
changes one count by one, so the Manhattan distance of two such vectors is at most the number of
differing bits.  Vectors are points of a grid.  Two points at distance two or less have a grid point
within one step of both: each distinct fingerprint is put at its own point and at every point one step
away, an equi-join on the grid point yields the candidates, and the exact bit distance is verified in
the join itself.  A rule on the steps lets each pair through at exactly one grid point.

Equal fingerprints are one class before the join, so a group of copies of any size is one row there.
Classes and links stay tables; components are found by label propagation.

Defined cases: a null text is empty; a text without words has fingerprint zero and is linked like any
other.  ``component_id`` is the smallest non-null id of the component (null if it has none).  Of each
component ``survivors`` keeps the row with the smallest id, null ids last, ties settled by a hash of the
text and then by the other columns; rows repeated in full are kept once.  An empty table gives an empty one.  Other columns are carried
along by ``survivors`` and ignored by ``groups``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.llm.common import attach_unique, documents, keep, slices
from martlet.llm.components import components
from martlet.llm.exact import _orderable
from martlet.sources.store import Store

WORDS = 3
SEED = 42
MAX_BITS = 2
SEGMENTS = 16
SEGMENT_BITS = 4
_BLOCK = 1 << 15


def shingle_hashes(text: str, words: int, seed: int = SEED) -> np.ndarray:
    """One unsigned 64-bit hash for each word shingle of one text, none for a text without words."""
    parts = text.encode().lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts])
    starts = np.concatenate([[0], ends[:-1]])
    span = min(words, len(parts))
    starts, ends = starts[: len(parts) - span + 1].tolist(), (ends[span - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts, ends)), np.uint64, len(starts))


def simhash(text: str, words: int = WORDS, seed: int = SEED) -> int:
    """64-bit fingerprint of the word shingles of one text, as an unsigned number."""
    return majority(shingle_hashes(text, words, seed))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes, zero if there are none."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _BLOCK):
        bits = np.unpackbits(hashes[at : at + _BLOCK].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, a mark that tells rows of one id apart, and the fingerprint as a signed long."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("_mark"), "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            prints = np.array([simhash(t, words) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(prints)], names=["doc_id", "_mark", "_print"]
            )

    return rows.mapInArrow(work, "doc_id bigint, _mark bigint, _print bigint")


# ------------------------------------------------------------------ the grid


def segment_counts(bits: Column) -> Column:
    """Set bits of each four-bit segment, packed as one hexadecimal digit for each segment."""
    lowest = [F.shiftrightunsigned(bits, k).bitwiseAND(0x1111111111111111) for k in range(SEGMENT_BITS)]
    return lowest[0] + lowest[1] + lowest[2] + lowest[3]


def _steps(point: Column) -> Column:
    """The point itself (step 0) and its neighbours: step d + 1 raises segment d by one, -(d + 1) lowers it."""
    moves = [F.struct(point.alias("_cell"), F.lit(0).cast("byte").alias("_step"))]
    for d in range(SEGMENTS):
        shift = SEGMENT_BITS * d
        unit = F.shiftleft(F.lit(1).cast("bigint"), shift)
        count = F.shiftrightunsigned(point, shift).bitwiseAND(15)
        up = F.struct((point + unit).alias("_cell"), F.lit(d + 1).cast("byte").alias("_step"))
        down = F.struct((point - unit).alias("_cell"), F.lit(-d - 1).cast("byte").alias("_step"))
        moves += [F.when(count < SEGMENT_BITS, up), F.when(count > 0, down)]
    return F.filter(F.array(*moves), lambda move: move.isNotNull())


def links(classes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs ``a < b`` of distinct fingerprints (column ``_print``) that differ in at most ``max_bits`` bits."""
    if not 0 <= max_bits <= 2:
        raise ValueError("one step on each side covers up to two differing bits")
    placed = classes.select("_print", F.explode(_steps(segment_counts(F.col("_print")))).alias("_at")).select(
        "_print", "_at._cell", "_at._step"
    )
    left = placed.select("_cell", F.col("_print").alias("a"), F.col("_step").alias("_s"))
    right = placed.select("_cell", F.col("_print").alias("b"), F.col("_step").alias("_t"))
    s, t = F.col("_s"), F.col("_t")
    once = (
        ((s == 0) & (t >= 0))
        | ((t == 0) & (s > 0))
        | ((s != 0) & (s == -t))
        | ((s != 0) & (t != 0) & (F.abs(s) < F.abs(t)))
    )
    exact = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    return left.hint("merge").join(
        right, (left["_cell"] == right["_cell"]) & (F.col("a") < F.col("b")) & once & exact
    ).select("a", "b")


# ------------------------------------------------------------------ groups


class NearGroups:
    """Components of near-equal fingerprints of one table."""

    def __init__(self, docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS):
        self.docs, self.words, self.max_bits = docs, words, max_bits
        self._find()

    def _marked(self) -> DataFrame:
        """doc_id, ``_mark``, ``_print`` and whatever the links need."""
        return fingerprints(self.docs, self.words)

    def _links(self, classes: DataFrame) -> DataFrame:
        """Stored links ``a``, ``b`` between classes."""
        return keep(links(classes, self.max_bits), "links")

    def _find(self) -> None:
        spark = self.docs.sparkSession
        self.rows = keep(self._marked(), "fingerprints")
        self.total = self.rows.count()
        first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_mark"))
        classes = keep(
            self.rows.groupBy("_print").agg(first.alias("_first"), F.count("*").alias("_rows")), "fingerprint-classes"
        )
        near = components(self._links(classes), Store(spark, "llm-components"))
        linked = near.withColumnRenamed("node", "_print").join(classes.select("_print", "_first"), "_print")
        heads = linked.groupBy("label").agg(F.min("_first").alias("_head"))
        heads = linked.select("_print", "label").join(heads, "label").select("_print", "_head")
        self.classes = keep(
            classes.join(heads, "_print", "left").select("_print", "_rows", F.coalesce("_head", "_first").alias("_head")),
            "near-classes",
        )

    def groups(self, *more: str) -> DataFrame:
        """Every row: doc_id, ``_mark``, ``_print``, component_id, the mark of the row that stays and ``more`` of its own."""
        rows = self.rows.select("doc_id", "_mark", "_print", *more)
        joined = attach_unique(rows, self.classes, "_print", F.col("_rows"), self.total)
        return joined.select(
            "doc_id", "_mark", "_print", F.col("_head.doc_id").alias("component_id"), F.col("_head._mark").alias("_stays"), *more
        )

    def survivors(self) -> DataFrame:
        rows = self.groups()
        stays = rows.filter(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("_mark") == F.col("_stays")))
        key = F.struct(F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0)))
        stays = stays.select(key.alias("_key"), "_mark").distinct()
        inside = self.docs.select(F.struct(*self.docs.columns).alias("_row"), F.xxhash64("text").alias("_mark"))
        inside = inside.withColumn(
            "_key", F.struct(F.col("_row.doc_id").isNull(), F.coalesce("_row.doc_id", F.lit(0)))
        )
        rank = [F.col("_row").getField(c) for c in self.docs.columns if c != "text" and _orderable(self.docs.schema[c].dataType)]
        kept = inside.join(stays, ["_key", "_mark"], "left_semi").groupBy("_key", "_mark").agg(F.min_by("_row", F.struct(*rank)).alias("_row"))
        return kept.select(*[F.col("_row").getField(c).alias(c) for c in self.docs.columns])


def op5_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = NearGroups(documents(spark, folder)).groups()
    hexadecimal = F.lower(F.lpad(F.hex("_print"), 16, "0"))
    return rows.select("doc_id", hexadecimal.alias("fingerprint"), "component_id")
