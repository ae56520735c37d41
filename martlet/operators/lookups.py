"""Lookup joins with a fallback member.

No join is forced to broadcast: lookups are stored tables or inline values, so
the planner knows their size and falls back to a shuffle join when they are big.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.settings import STATES_BY_REGION, UNKNOWN_LABEL


def inline_table(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A small constant table that the planner can fold and size."""
    names = [part.split()[0] for part in schema.split(",")]
    kinds = [part.split()[1] for part in schema.split(",")]

    def text(value) -> str:
        if value is None:
            return "NULL"
        return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"

    body = ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)
    raw = spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(names)})")
    return raw.select(*[F.col(n).cast(k).alias(n) for n, k in zip(names, kinds)])


def standard_regions(spark: SparkSession) -> DataFrame:
    """The fixed state-to-region list as a (state, region) lookup."""
    rows = [(s, region) for region, states in STATES_BY_REGION.items() for s in states]
    return inline_table(spark, rows, "state string, region string")


def with_region(df: DataFrame, state: str, regions: DataFrame, region: str) -> DataFrame:
    """Add the region of a state code, ``Unknown`` for a code that is not listed."""
    known = regions.select(F.col("state").alias("_state"), F.col("region").alias("_region"))
    return (
        df.join(known, F.col(state) == F.col("_state"), "left")
        .withColumn(region, F.coalesce("_region", F.lit(UNKNOWN_LABEL)))
        .drop("_state", "_region")
    )


def one_per_key(df: DataFrame, *key: str) -> DataFrame:
    """One row per key, the greatest by the other columns; combines before the shuffle."""
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return df.distinct()
    best = df.groupBy(*key).agg(F.max(F.struct(*rest)).alias("_best"))
    return best.select(*[F.col(c) if c in key else F.col(f"_best.{c}").alias(c) for c in df.columns])


def lookup(
    df: DataFrame,
    on: str | Column,
    dim: DataFrame,
    dim_key: str,
    take: Mapping[str, str],
    fallback: Mapping[str, object] | None = None,
) -> DataFrame:
    """Left join ``dim`` and take columns from it.

    ``take`` maps new column names to columns of ``dim``; a row without a match
    gets the ``fallback`` value of that column, or NULL.
    """
    fallback = fallback or {}
    probe = F.col(on) if isinstance(on, str) else on
    side = dim.select(
        F.col(dim_key).alias("_lookup_key"), *[F.col(c).alias(f"_take_{n}") for n, c in take.items()]
    )

    def taken(name: str) -> Column:
        found = F.col(f"_take_{name}")
        if name in fallback:
            value = fallback[name]
            found = F.coalesce(found, value if isinstance(value, Column) else F.lit(value))
        return found.alias(name)

    kept = [c for c in df.columns if c not in take]
    joined = df.join(side, probe == F.col("_lookup_key"), "left")
    return joined.select(*kept, *[taken(name) for name in take])


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def side_by_side(*single_rows: DataFrame) -> DataFrame:
    """One-row results with different columns as one row; no join is involved."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), single_rows)
    return stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in stacked.columns])
