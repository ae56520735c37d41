"""Staging tables derived from the given order and line tables.

Every derivation is row by row: it adds no shuffle, and each staging column is
pruned like a source column.  Lines keep their own line number as item number, so
numbers may repeat within an order.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.operators.lookups import inline_table
from martlet.schemas import GIVEN, STAGING
from martlet.settings import Settings

# Parameters that belong to these tables.
MANUAL_CATEGORIES = {"standard": "standard_goods"}
TRANSLATION = (
    ("economy", "economy_goods"),
    ("small", "small_goods"),
    ("medium", "medium_goods"),
    ("promo", "promotion"),
)
HOLIDAYS = (  # month, day, name; December 25 has two names
    (1, 1, "New Year"), (3, 20, "Spring Day"), (4, 21, "Founders Day"), (5, 1, "Labour Day"),
    (6, 12, "Summer Day"), (9, 7, "Independence Day"), (10, 12, "Harvest Day"),
    (11, 2, "Remembrance"), (12, 25, "Christmas"), (12, 25, "Winter Day"),
)


def _given(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table with a declared layout, so no job reads file footers first."""
    return spark.read.schema(GIVEN[name]).parquet(f"{folder}/{name}.parquet")


LOST_ZIP = 90_000  # beyond every zip of the given tables


def _purchase_years(orders: DataFrame) -> DataFrame:
    """First and last year with an order, one row."""
    year = F.year("o_orderdate")
    return orders.agg(F.min(year).alias("first"), F.max(year).alias("last"))


def retail_settings(spark: SparkSession, folder: str, dialect: str = "py") -> Settings:
    """Settings whose calendar holds every full year with an order."""
    first, last = _purchase_years(_given(spark, folder, "orders")).first()
    return Settings(
        dialect=dialect,
        calendar_start=f"{first}-01-01",
        calendar_end=f"{last}-12-31",
        manual_categories=dict(MANUAL_CATEGORIES),
    )


def _later(stamp: Column, days=0, hours=0) -> Column:
    def whole(n):
        return n.cast("int") if isinstance(n, Column) else F.lit(n)

    return stamp + F.make_dt_interval(whole(days), whole(hours))


def _landed(df: DataFrame, table: str) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in STAGING[table]])


def _orders(orders: DataFrame) -> DataFrame:
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    status = (
        F.when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "O", "shipped")
        .when(F.col("o_orderstatus") == "P", "canceled")
    )
    bought = _later(day, 0, key * 5 % 24)
    arrived = (F.col("o_orderstatus") == "F") & (key % 50 != 0)
    return orders.select(
        key.alias("order_id"),
        _astray("o_custkey", 101).alias("customer_id"),
        status.alias("order_status"),
        bought.alias("order_purchase_timestamp"),
        F.when(key % 625 != 0, _later(bought, 0, 1)).alias("order_approved_at"),
        F.when(F.col("o_orderstatus") != "P", _later(day, 1)).alias("order_delivered_carrier_date"),
        F.when(arrived, _later(day, key * 7 % 30 + 1, key % 24)).alias(
            "order_delivered_customer_date"
        ),
        _later(day, 20).alias("order_estimated_delivery_date"),
    )


def _astray(key: str, every: int) -> Column:
    """The key as text; every so-manyth reference is led to a member that does not exist.

    All rows of every table are kept: the dimensions hold all members, and the facts still
    meet the unknown one.
    """
    own = F.col(key).cast("string")
    return F.when(F.col(key) % every == 0, F.concat(F.lit("gone-"), own)).otherwise(own)


def _money(name: str) -> Column:
    return F.col(name).cast("decimal(12,2)")


def _items(lines: DataFrame) -> DataFrame:
    price = _money("l_extendedprice")
    return lines.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        _astray("l_partkey", 101).alias("product_id"),
        _astray("l_suppkey", 51).alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        price.alias("price"),
        (price * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(12,2)").alias("freight_value"),
    )


def _payments(lines: DataFrame) -> DataFrame:
    flag = F.concat("l_returnflag", "l_linestatus")
    kind = (
        F.when(flag == "RF", "credit_card")
        .when(flag == "RO", "debit_card")
        .when(flag == "AF", "boleto")
        .when(flag == "AO", "voucher")
        .when(flag == "NF", "not_defined")
    )
    kept = F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)")
    return lines.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        kind.alias("payment_type"),
        (F.col("l_quantity").cast("int") % 24 + 1).alias("payment_installments"),
        (_money("l_extendedprice") * kept).cast("decimal(12,2)").alias("payment_value"),
    )


def _reviews(lines: DataFrame) -> DataFrame:
    """One review for each line; lines that were not returned have no score."""
    score = F.when(F.col("l_returnflag") != "N", F.col("l_quantity").cast("int") % 5 + 1)
    return lines.select(
        F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber")).alias("review_id"),
        F.col("l_orderkey").alias("order_id"),
        score.alias("review_score"),
        F.when(score == 5, "great").alias("review_comment_title"),
        F.when(score != 3, F.concat(F.lit("score "), score.cast("string"))).alias(
            "review_comment_message"
        ),
        F.col("l_shipdate").alias("review_creation_date"),
        _later(F.col("l_shipdate"), 1).alias("review_answer_timestamp"),
    )


def _products(part: DataFrame) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    return part.select(
        key.alias("product_id"),
        F.when(key % 50 != 0, F.lower("p_type")).alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        (F.length("p_name") + F.length("p_brand")).alias("product_description_lenght"),
        (size % 7 + 1).alias("product_photos_qty"),
        F.when(key % 97 != 0, size * 100).alias("product_weight_g"),
        (size + 10).alias("product_length_cm"),
        (size + 5).alias("product_height_cm"),
        (size + 2).alias("product_width_cm"),
    )


def _people(source: DataFrame, nation: DataFrame, key: str, nation_key: str) -> DataFrame:
    """Id, zip, city, state and balance of customers or suppliers; those of no known nation have no city or state."""
    return source.join(nation, F.col(nation_key) == F.col("n_nationkey"), "left").select(
        F.col(key).alias("key"),
        (F.col(nation_key) * 10 + F.col(key) % 10).cast("int").alias("zip"),
        "n_name",
        F.col("c_acctbal" if key.startswith("c_") else "s_acctbal").alias("balance"),
    )


def _geolocation(people: DataFrame) -> DataFrame:
    return people.select(
        F.col("zip").alias("geolocation_zip_code_prefix"),
        (F.col("balance") / 200).alias("geolocation_lat"),
        (F.col("balance") / -100).alias("geolocation_lng"),
        F.lower("n_name").alias("geolocation_city"),
        F.col("n_name").alias("geolocation_state"),
    )


def _holidays(orders: DataFrame) -> DataFrame:
    """The fixed days of every year with an order."""
    named = F.array(*[F.struct(*map(F.lit, day)) for day in HOLIDAYS])
    years = _purchase_years(orders).select(F.explode(F.sequence("first", "last")).alias("year"))
    return years.select("year", F.explode(named).alias("h")).select(
        F.make_date(F.col("year"), F.col("h.col1"), F.col("h.col2")).alias("holiday_date"),
        F.upper("h.col3").alias("local_name"),
        F.col("h.col3").alias("english_name"),
        F.lit("ZZ").alias("country_code"),
    )


class StagingTables(Mapping[str, DataFrame]):
    """Staging tables by name; each is declared when it is first asked for."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = _landed(self._builders[name](), name)
        return self._built[name]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self):
        return len(self._builders)


def read_staging(spark: SparkSession, folder: str) -> StagingTables:
    """The ten staging tables of a data folder."""

    def table(name: str) -> DataFrame:
        return _given(spark, folder, name)

    def buyers() -> DataFrame:
        return _people(table("customer"), table("nation"), "c_custkey", "c_nationkey")

    def vendors() -> DataFrame:
        return _people(table("supplier"), table("nation"), "s_suppkey", "s_nationkey")

    def named(prefix: str) -> list[Column]:
        city, state = F.concat(F.lit("  "), F.col("n_name")), F.lower("n_name")
        # some addresses name a zip that no geolocation row has
        lost = F.when(F.col("zip") % 37 == 0, F.col("zip") + LOST_ZIP).otherwise(F.col("zip"))
        return [lost.alias(f"{prefix}_zip_code_prefix"), city.alias(f"{prefix}_city"), state.alias(f"{prefix}_state")]

    return StagingTables(
        {
            "customers": lambda: buyers().select(
                F.col("key").alias("customer_id"),
                F.floor(F.col("key") / 2).alias("customer_unique_id"),
                *named("customer"),
            ),
            "orders": lambda: _orders(table("orders")),
            "order_items": lambda: _items(table("lineitem")),
            "payments": lambda: _payments(table("lineitem")),
            "reviews": lambda: _reviews(table("lineitem")),
            "products": lambda: _products(table("part")),
            "sellers": lambda: vendors().select(
                F.col("key").alias("seller_id"), *named("seller")
            ),
            "geolocation": lambda: _geolocation(buyers().unionByName(vendors())),
            "category_translation": lambda: inline_table(
                spark, TRANSLATION,
                "product_category_name string, product_category_name_english string",
            ),
            "holidays": lambda: _holidays(table("orders")),
        }
    )


def read_regions(spark: SparkSession, folder: str) -> DataFrame:
    """State-to-region lookup of a data folder."""
    nation, region = _given(spark, folder, "nation"), _given(spark, folder, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.upper("n_name").alias("state"), F.col("r_name").alias("region")
    )
