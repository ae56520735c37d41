"""Declared constraints of the star schema, checked as Spark jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.operators.lookups import union_all
from martlet.schemas import FOREIGN_KEYS, REQUIRED, STAR_KEYS


def duplicate_keys(df: DataFrame, *key: str) -> DataFrame:
    """Keys that occur more than once, with their number of copies."""
    return df.groupBy(*key).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def uniqueness(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """Per table: how many business keys repeat and how many rows are surplus."""
    return union_all(
        [
            duplicate_keys(tables[table], *key)
            .agg(
                F.count("*").alias("repeated_keys"),
                F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("surplus_rows"),
            )
            .select(
                F.lit(table).alias("table"), F.lit("+".join(key)).alias("business_key"),
                "repeated_keys", "surplus_rows",
            )
            for table, key in keys.items()
        ]
    )


def star_uniqueness(star: Mapping[str, DataFrame]) -> DataFrame:
    return uniqueness(star, {table: (key,) for table, key in STAR_KEYS.items()})


def broken_references(star: Mapping[str, DataFrame]) -> DataFrame:
    """Fact rows per foreign key whose key the dimension does not hold.

    Fact and dimension keys meet in one aggregation that counts each key's rows on
    the map side, so a hot key costs one row per task and no join is needed.
    """

    def broken(fact: str, column: str, dim: str, dim_key: str) -> DataFrame:
        used = star[fact].filter(F.col(column).isNotNull()).select(
            F.col(column).cast("bigint").alias("key"), F.lit(1).alias("rows"), F.lit(False).alias("held")
        )
        held = star[dim].select(
            F.col(dim_key).cast("bigint").alias("key"), F.lit(0).alias("rows"), F.lit(True).alias("held")
        )
        keys = used.unionByName(held).groupBy("key").agg(
            F.sum("rows").alias("rows"), F.bool_or("held").alias("held")
        )
        lost = F.sum(F.when(~F.col("held"), F.col("rows")).otherwise(0))
        return keys.agg(F.coalesce(lost, F.lit(0)).alias("broken_rows")).select(
            F.lit(fact).alias("fact"), F.lit(column).alias("column"),
            F.lit(dim).alias("dimension"), "broken_rows",
        )

    return union_all([broken(*relation) for relation in FOREIGN_KEYS])


def missing_values(star: Mapping[str, DataFrame]) -> DataFrame:
    """NULL count of every required fact column, one scan per fact."""
    return union_all(
        [
            star[fact]
            .agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
            .unpivot([], list(columns), "column", "null_rows")
            .select(F.lit(fact).alias("fact"), "column", "null_rows")
            for fact, columns in REQUIRED.items()
        ]
    )


def split_rejected(
    df: DataFrame, table: str, key: str, rules: Mapping[str, tuple[str, Column]]
) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the rejected rows in the audit layout.

    ``rules`` maps a reason code to its text and the condition of a bad row; a row
    is rejected under the first reason that applies.
    """
    reason = F.coalesce(
        *[F.when(bad, F.struct(F.lit(code).alias("code"), F.lit(text).alias("text")))
          for code, (text, bad) in rules.items()]
    )
    judged = df.withColumn("_reason", reason)
    good = judged.filter(F.col("_reason").isNull()).drop("_reason")
    rejected = judged.filter(F.col("_reason").isNotNull()).select(
        F.lit(table).alias("SourceTable"),
        F.col(key).cast("string").alias("BusinessKey"),
        F.col("_reason.code").alias("ReasonCode"),
        F.col("_reason.text").alias("ReasonText"),
        F.current_timestamp().alias("RejectedAt"),
    )
    return good, rejected
