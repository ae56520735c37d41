"""Column profiles and cross-table integrity checks of the staging tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.operators.lookups import inline_table, union_all


def _landed_type(kind: T.DataType) -> str:
    """Type name of a column as read from a CSV file without a schema."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "int64"
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "float64"
    if isinstance(kind, T.BooleanType):
        return "bool"
    return "str"


def _digest(name: str, kind: T.DataType) -> tuple[Column, Column]:
    """Two longs that tell the values of a column apart: a whole number or a date itself, else 128 bits of digest."""
    column = F.col(name)
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return column.cast("bigint"), F.when(column.isNotNull(), F.lit(0).cast("bigint"))
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("bigint"), F.when(column.isNotNull(), F.lit(0).cast("bigint"))
    if isinstance(kind, (T.FloatType, T.DoubleType)):  # NaN is missing, -0.0 equals 0.0
        column = F.when(~F.isnan(column), column + F.lit(0.0))
    return tuple(F.when(column.isNotNull(), F.xxhash64(column, F.lit(salt))) for salt in (0, 1))


def profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Records, missing values and distinct values of every column of every table, in one pass.

    Columns are turned into (column number, digest) rows of fixed width, so a long text costs no
    more than a number, and counted per digest before the shuffle, so a value that fills a column
    costs one row per task; a second count is over columns.  All tables share the two
    aggregations.  A table without rows gives every column with zero records.
    """
    columns, cells = [], []
    for table, df in tables.items():
        own = []
        for f in df.schema.fields:
            first, second = _digest(f.name, f.dataType)
            own.append(F.struct(F.lit(len(columns)).alias("place"), first.alias("a"), second.alias("b")))
            columns.append((len(columns), table, f.name, _landed_type(f.dataType)))
        cells.append(df.select(F.explode(F.array(*own)).alias("cell")).select("cell.place", "cell.a", "cell.b"))
    counted = union_all(cells).groupBy("place", "a", "b").agg(F.count("*").alias("n"))
    found = counted.groupBy("place").agg(
        F.sum("n").alias("records"),
        F.sum(F.when(F.col("b").isNull(), F.col("n"))).alias("null_count"),
        F.count("b").alias("distinct_values"),
    )
    spark = next(iter(tables.values())).sparkSession
    named = inline_table(spark, columns, "place int, table string, attribute string, kind string")
    rows = named.join(found, "place", "left").fillna(0, ["records", "null_count", "distinct_values"])
    # A whole-number column with gaps is read as floating point.
    gaps = (F.col("kind") == "int64") & (F.col("null_count") > 0)
    share = F.try_divide(F.col("null_count") * F.lit(100.0), F.col("records"))
    return rows.select(
        "table",
        "attribute",
        F.when(gaps, "float64").otherwise(F.col("kind")).alias("dtype"),
        "records",
        "null_count",
        # the nearest hundredth, an exact half to the even one
        F.coalesce(F.rint(share * 100) / 100, F.lit(0.0)).alias("null_pct"),
        "distinct_values",
    )


def profile_table(df: DataFrame, table: str) -> DataFrame:
    return profile({table: df})


def key_presence(holder: tuple[DataFrame, str], users: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Every distinct key with a flag per table that holds it.

    ``holder`` is the table a key should be in (flag ``held``), ``users`` the tables
    that refer to it.  All tables meet in one aggregation: a single shuffle that
    combines on the map side, so neither a hot key nor the size of a table matters.
    A missing key of a user counts as a key that nobody holds.
    """
    names = ["held", *users]
    held = holder[0].filter(F.col(holder[1]).isNotNull())
    sides = {"held": (held, holder[1]), **users}
    marked = union_all(
        [
            df.select(F.col(column).alias("key"), *[F.lit(n == name).alias(n) for n in names])
            for name, (df, column) in sides.items()
        ]
    )
    return marked.groupBy("key").agg(*[F.bool_or(n).alias(n) for n in names])


# holder table and key, then per check: name, user table and key
CHECKS = (
    ("orders", "order_id", (
        ("order_items without order", "order_items", "order_id"),
        ("payments without order", "payments", "order_id"),
        ("reviews without order", "reviews", "order_id"),
    )),
    ("customers", "customer_id", (("orders without customer", "orders", "customer_id"),)),
    ("products", "product_id", (("items without product", "order_items", "product_id"),)),
    ("sellers", "seller_id", (("items without seller", "order_items", "seller_id"),)),
)


def integrity_checks(staging: Mapping[str, DataFrame]) -> DataFrame:
    """Number of orphan keys per check."""
    results = []
    for table, key, checks in CHECKS:
        users = {name: (staging[user], column) for name, user, column in checks}
        present = key_presence((staging[table], key), users)
        counts = present.agg(*[F.count_if(F.col(n) & ~F.col("held")).alias(n) for n in users])
        results.append(counts.unpivot([], list(users), "check", "missing"))
    return union_all(results)


def untranslated_categories(staging: Mapping[str, DataFrame]) -> DataFrame:
    """Product categories that the translation table does not hold."""
    name = "product_category_name"
    products = staging["products"].filter(F.col(name).isNotNull())
    present = key_presence((staging["category_translation"], name), {"used": (products, name)})
    return present.filter("used and not held").select(F.col("key").alias(name))


def geolocation_coverage(geo: DataFrame) -> DataFrame:
    return geo.agg(
        F.count("*").alias("geo_rows"),
        F.count_distinct("geolocation_zip_code_prefix").alias("unique_zips"),
    )
