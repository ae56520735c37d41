"""Near duplicates by circulant MinHash: two permutations make all coordinates of a signature.

The first permutation scatters the shingles of a set over a ring of 2^32 places.  The second one ranks the
places; coordinate k of the signature is the least rank that the set has when the second permutation is
shifted k places around the ring.  ``BANDS`` bands of ``BAND_ROWS`` coordinates each give one bucket; sets
that share a bucket are candidates, and every candidate pair is verified on the whole sets.  At the least
similarity of 0.85 a pair shares no bucket with a chance of 7e-10.

The members of a bucket of a few rows meet pair by pair, those of a larger one are first compared with one of them
(``setjoin.BucketLinks``), so a group of near copies costs as many pairs as it has members.  Members of a larger bucket
that are then in different components meet pair by pair.  One with more than ``LARGE_PAIRS`` such pairs is left to the exact prefix join of
``setjoin``, which meets the sets of all such buckets together and finds each similar pair of them that is not
connected yet; nothing is cut off.

Equal sets are one class, so a group of copies of any size is one row in every join.

Defined cases: a null text is empty; a text without words has the empty set and is linked with nothing, not
even with its like.  With fewer words than a shingle has, the whole sequence is the only shingle.
``component_id`` is the smallest non-null id of the component (null if it has none), for an empty set the
row's own id.  ``kept`` is false for a null id; rows that share the id and the text are kept or not together.
An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.llm.common import documents, keep
from martlet.llm.near import NearGroups
from martlet.llm.setjoin import BucketLinks, Least, close_sizes, links_within, set_rows, sets_of, sketches_of

WORDS = 3
SIMILAR: Least = (85, 100)
BANDS = 36
BAND_ROWS = 5
LARGE_PAIRS = 64
_BLOCK = 256

# The permutations are compositions of steps that can be undone: odd factors and shifted exclusive ors.
_SCATTER = np.uint64(0x9E3779B97F4A7C15)
_RANK_FACTORS = (np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))
_BAND_FACTOR = np.uint64(0xD6E8FEB86659FD93)


def scatter(hashes: np.ndarray) -> np.ndarray:
    """Places of hashes on the ring: the upper half of a permutation of the 64-bit numbers."""
    mixed = hashes ^ (hashes >> np.uint64(31))
    return ((mixed * _SCATTER) >> np.uint64(32)).astype(np.uint32)


def rank(places: np.ndarray) -> np.ndarray:
    """The second permutation, of the places of the ring."""
    x = places * _RANK_FACTORS[0]
    x ^= x >> np.uint32(15)
    x *= _RANK_FACTORS[1]
    return x


def signature(hashes: np.ndarray, coordinates: int = BANDS * BAND_ROWS) -> np.ndarray:
    """Coordinate k is the least rank of the places of the set, moved k places around the ring."""
    out = np.full(coordinates, 0xFFFFFFFF, np.uint32)
    places, shifts = scatter(hashes), np.arange(coordinates, dtype=np.uint32)
    for at in range(0, len(places), _BLOCK):
        np.minimum(out, rank(places[at : at + _BLOCK, None] + shifts).min(axis=0), out=out)
    return out


def buckets(signatures: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One number for each band of each row of signatures; the same coordinates in another band give another number."""
    parts = signatures.reshape(len(signatures), bands, -1).astype(np.uint64)
    out = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _SCATTER, parts.shape[:2]).copy()
    for k in range(parts.shape[2]):
        out = (out ^ parts[:, :, k]) * _BAND_FACTOR
        out ^= out >> np.uint64(29)
    return out


def bucket_keys(sets: list[np.ndarray]) -> list[np.ndarray]:
    return list(buckets(np.stack([signature(s) for s in sets])))


class CirculantGroups(NearGroups):
    """Components of texts of similar shingle sets of one table; empty sets have one component each."""

    def __init__(self, docs: DataFrame, words: int = WORDS, least: Least = SIMILAR, large_pairs: int = LARGE_PAIRS):
        self.least, self.large_pairs = least, large_pairs
        super().__init__(docs, words)

    def _marked(self) -> DataFrame:
        return set_rows(self.docs, self.words, bucket_keys)

    def _links(self, classes: DataFrame) -> DataFrame:
        at = F.struct(F.col("_size").alias("size"), F.col("_print").alias("node"))
        members = self.rows.select(F.explode("_keys").alias("_bucket"), at.alias("at"))

        def fetch(nodes: DataFrame) -> DataFrame:
            return sets_of(self.docs, classes, nodes, self.words)

        met = BucketLinks(
            members,
            sketches_of(self.rows.filter(F.size("_keys") > 0)),
            fetch,
            lambda x, y: close_sizes(x, y, self.least),
            self.least,
            self.large_pairs,
        )
        self.large = met.large_nodes
        if self.large is None:
            return met.found()
        sets = keep(fetch(self.large), "large-sets")
        return links_within(sets, self.least, met.found())

    def result(self) -> DataFrame:
        rows = self.groups("_size")
        component = F.when(F.col("_size") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
        rows = rows.select("doc_id", F.col("_size").alias("n_shingles"), component.alias("component_id"))
        return rows.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def op12_circulant_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return CirculantGroups(documents(spark, folder)).result()


OP12_SQL = r"""
WITH RECURSIVE words AS (
    SELECT row_number() OVER () AS rid, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
sets AS MATERIALIZED (
    SELECT rid, doc_id,
           CASE WHEN len(w) = 0 THEN []
                WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
           END AS shingles
    FROM words
),
sizes AS MATERIALIZED (SELECT rid, doc_id, len(shingles) AS n FROM sets),
held AS MATERIALIZED (SELECT rid, hash(s) AS s FROM (SELECT rid, unnest(shingles) AS s FROM sets)),
links AS MATERIALIZED (
    SELECT p.a, p.b
    FROM (SELECT x.rid AS a, y.rid AS b, count(*) AS both_hold FROM held x JOIN held y ON x.s = y.s AND x.rid <> y.rid GROUP BY 1, 2) p
    JOIN sizes u ON u.rid = p.a JOIN sizes v ON v.rid = p.b
    WHERE 100 * both_hold >= 85 * (u.n + v.n - both_hold)
),
reach AS (
    SELECT rid, rid AS other FROM sizes
    UNION
    SELECT reach.rid, links.b FROM reach JOIN links ON links.a = reach.other
),
least AS (SELECT reach.rid, min(sizes.doc_id) AS component_id FROM reach JOIN sizes ON sizes.rid = reach.other GROUP BY reach.rid)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept
FROM sizes JOIN least USING (rid)
"""
