"""A training corpus from raw documents, stage by stage.

Each stage takes the session, the rows that its predecessor kept and the folder of the given tables, and
returns a DataFrame.  All but the last return the columns of ``documents``; the last returns one row for
each packed piece.  ``run`` writes every stage to the folder that all executors share and reads it back,
so a lost executor costs a re-read of the stage before.

1. ``quality``: the subword classifier is trained on the labelled documents; rejected rows go.
2. ``exact_dedup``: of equal texts the row with the greatest id stays.
3. ``near_dedup``: texts whose five-word shingles have a similarity of at least 0.8 are near duplicates, found by
   the fingerprint grid and, where that does not reach, by an exact search; of each group of them the row with the
   smallest id stays.
4. ``mixing``: a token budget is dealt over domain, language and source by target weights.
5. ``packing``: the pieces of all rows are packed into sequences.

Every stage passes null, empty and very long texts, repeated rows, empty tables and further columns on as
its operator defines it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martlet.llm import exact, mixing, packing, quality, similar
from martlet.llm.common import documents, keep

# Nine tenths of the tokens, no row twice: what a leaf lacks its siblings give, and the hot source shrinks.
CORPUS_MIX = mixing.Mix(mixing.LEVELS, mixing.WEIGHTS, budget_share=(9, 10), max_epochs=1, seed="corpus")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.accepted(docs, quality.fit(docs, labels))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.ExactGroups(docs).survivors()


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return similar.SimilarGroups(docs).survivors()


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.selected(mixing.with_domain(docs), CORPUS_MIX).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# Training, fingerprints and tokens cannot be said in SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
