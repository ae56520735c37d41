"""Exact duplicates by skew-safe combining, with native Columns only.

1. Every row gets a digest of its text; ids and digests are stored once.
2. A digest that holds more than a fixed share of all rows is hot (at most 4096 of them, so the list may
   be broadcast).  Copies are combined locally before any shuffle.  Cold groups are then complete after
   one shuffle; hot groups are first merged by (digest, salt), the salt being taken from the task, and
   the salt winners are then combined globally.
3. Every combining step groups by digest *and* text, so rows are equal only if their whole contents are.

Defined cases: a null text equals an empty one.  Of equal texts the row with the greatest ``doc_id``
stays; a null id loses against any other; equal ids are settled by the other columns.  Fully repeated
rows are copies like any others, so ``survivors`` keeps one of them.  An empty table gives an empty one.
Columns of any other name are carried along by ``survivors`` and ignored by ``assignments``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.llm.common import HOT_SHARE, attach_unique, clean_text, documents, keep

SALTS = 64


def sha256_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


class ExactGroups:
    """Groups of equal texts of one table."""

    def __init__(
        self,
        docs: DataFrame,
        digest: Callable[[Column], Column] = sha256_digest,
        hot_share: float = HOT_SHARE,
        salts: int = SALTS,
    ):
        self.docs, self.digest, self.salts, self.hot_share = docs, digest, salts, hot_share
        self.ids = keep(docs.select(F.col("doc_id"), digest(clean_text()).alias("_digest")), "digests")
        self.total = self.ids.count()
        counts = self.ids.groupBy("_digest").agg(F.count("*").alias("_n"))
        self.hot = keep(counts.filter(F.col("_n") > int(self.total * hot_share)).select("_digest"), "hot-digests")
        self.any_hot = not self.hot.isEmpty()

    def _combined(self, carried: list[str]) -> DataFrame:
        """One row for each distinct text: digest, text, winner (a struct), size."""
        rank = [c for c in carried if _orderable(self.docs.schema[c].dataType)]
        rows = self.docs.select(
            clean_text().alias("_text"),
            F.struct("doc_id", *carried).alias("_row"),
            (F.struct("doc_id", *rank) if carried else F.col("doc_id")).alias("_rank"),
        ).withColumn("_digest", self.digest(F.col("_text")))
        keys = ["_digest", "_text"]
        first = [F.max_by(F.col("_row"), F.col("_rank")).alias("_winner"), F.max("_rank").alias("_top"), F.count("*").alias("_size")]
        again = [F.max_by(F.col("_winner"), F.col("_top")).alias("_winner"), F.max("_top").alias("_top"), F.sum("_size").alias("_size")]
        if not carried:  # the id alone needs no struct, and its maximum stays inside fast aggregation
            first = [F.max("_rank").alias("_top"), F.count("*").alias("_size")]
            again = [F.max("_top").alias("_top"), F.sum("_size").alias("_size")]
        if not self.any_hot:
            return rows.groupBy(*keys).agg(*first)
        hot = F.broadcast(self.hot)  # at most 1 / hot_share digests
        cold = rows.join(hot, "_digest", "left_anti").groupBy(*keys).agg(*first)
        salted = rows.join(hot, "_digest", "left_semi").withColumn(
            "_salt", F.pmod(F.spark_partition_id(), F.lit(self.salts))
        )
        merged = salted.groupBy("_salt", *keys).agg(*first).groupBy(*keys).agg(*again)
        return cold.unionByName(merged)

    def survivors(self) -> DataFrame:
        """The rows that stay, in the columns of the table."""
        others = [c for c in self.docs.columns if c not in ("doc_id", "text")]
        # a group of the empty text may mix null and empty; its row says which it was
        rows = self._combined([*others, "text"] if _nullable_text(self.docs) else others)
        winner = {c: F.col("_winner").getField(c) for c in ("doc_id", *others)}
        text = F.when(F.col("_text") == "", F.col("_winner").getField("text")).otherwise(F.col("_text"))
        winner["text"] = text if _nullable_text(self.docs) else F.col("_text")
        return rows.select(*[winner[c].alias(c) for c in self.docs.columns])

    def assignments(self) -> DataFrame:
        """Every row: doc_id, keep_id, group_size, kept, and the digest as ``_digest``."""
        groups = keep(
            self._combined([]).select("_digest", "_top", "_size"), "exact-groups"
        )
        texts = groups.groupBy("_digest").agg(
            F.count("*").alias("_texts"), F.max("_top").alias("keep_id"), F.sum("_size").alias("group_size")
        )
        single = texts.filter(F.col("_texts") == 1)
        out = attach_unique(self.ids, single, "_digest", F.col("group_size"), self.total, self.hot_share).select(
            "doc_id", "_digest", "keep_id", "group_size"
        )
        collided = texts.filter(F.col("_texts") > 1).select("_digest")
        if not collided.isEmpty():
            # several texts share a digest: these rows compare their whole texts again
            rows = self.docs.select("doc_id", clean_text().alias("_text")).withColumn("_digest", self.digest(F.col("_text")))
            rows = rows.join(collided, "_digest", "left_semi")
            winners = self._combined([]).join(collided, "_digest", "left_semi")
            pairs = rows.join(winners, ["_digest", "_text"]).select(
                "doc_id", "_digest", F.col("_top").alias("keep_id"), F.col("_size").alias("group_size")
            )
            out = out.unionByName(pairs)
        return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def _nullable_text(docs: DataFrame) -> bool:
    return docs.schema["text"].nullable


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    groups = ExactGroups(documents(spark, folder))
    return groups.assignments().select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("_digest")).alias("text_sha256")
    )


OP8_SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
