"""Near duplicates by the true similarity of word shingles.

Two texts are linked if their sets of five-word shingles share at least four fifths of their union.  First the
method of ``near``: SimHash fingerprints, the segment-popcount grid join and the exact bit distance.  Its pairs
are verified on the whole sets and are links from then on.  The grid cannot reach all: at similarity 0.8 two
fingerprints differ in about ten of 64 bits.  An exact search follows for what the grid has not connected:
``setjoin`` finds every other pair by rarity-ordered prefixes and verifies it on the whole sets, so no link is
wrong and none is missed.  Equal sets are one class.

Defined cases: those of ``near``; a text of fewer than five words is one shingle, and texts without words
are equal to each other and similar to no other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import keep
from martlet.llm.near import MAX_BITS, NearGroups, links
from martlet.llm.setjoin import Least, prefix_keys, prefix_links, rarity, set_rows, sets_of, stored_links
from martlet.sources.store import Store

WORDS = 5
SIMILAR: Least = (4, 5)


class SimilarGroups(NearGroups):
    """Components of texts of similar shingle sets of one table."""

    def __init__(self, docs: DataFrame, words: int = WORDS, least: Least = SIMILAR):
        self.least = least
        super().__init__(docs, words)

    def _marked(self) -> DataFrame:
        return set_rows(self.docs, self.words, prefix_keys(rarity(self.docs, self.words), self.least), simhashes=True)

    def _links(self, classes: DataFrame) -> DataFrame:
        rows = self.rows.filter(F.size("_keys") > 0)

        def fetch(nodes: DataFrame) -> DataFrame:
            return sets_of(self.docs, classes, nodes, self.words)

        self.grid, _ = stored_links(Store(rows.sparkSession, "llm-grid"), "grid", grid_pairs(rows, self.max_bits), fetch, self.least)
        self.found = prefix_links(rows, fetch, self.least, self.grid)
        return self.found.found()


def grid_pairs(rows: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Stored pairs ``a < b`` of sets whose fingerprints the grid brings together.

    Of the sets of one fingerprint the first stands for all: the others meet it alone, and it meets those of near fingerprints.
    """
    marks = keep(rows.select(F.col("_print").alias("node"), "_simhash").distinct(), "grid-marks")
    heads = marks.groupBy("_simhash").agg(F.min("node").alias("_head"))
    equal = marks.join(heads, "_simhash").select(F.col("node").alias("x"), F.col("_head").alias("y"))
    near = links(heads.select(F.col("_simhash").alias("_print")), max_bits)
    left = heads.select(F.col("_simhash").alias("a"), F.col("_head").alias("x"))
    right = heads.select(F.col("_simhash").alias("b"), F.col("_head").alias("y"))
    both = equal.union(near.join(left, "a").join(right, "b").select("x", "y")).filter(F.col("x") != F.col("y"))
    return keep(both.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "grid-pairs")
