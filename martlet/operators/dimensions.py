"""The seven dimensions of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.functions import calendar as cal
from martlet.functions import labels
from martlet.operators.keys import number_rows
from martlet.operators.lookups import inline_table, one_per_key, with_region
from martlet.schemas import STAR
from martlet.settings import (
    UNKNOWN_DATE,
    UNKNOWN_ID,
    UNKNOWN_LABEL,
    UNKNOWN_PAYMENT,
    UNKNOWN_STATE,
    Settings,
)
from martlet.sources.store import Store


def as_layout(df: DataFrame, table: str) -> DataFrame:
    """Columns of ``df`` in the order and types of a star table."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in STAR[table]])


def sentinel(spark: SparkSession, table: str, **values) -> DataFrame:
    """One row of a star table; columns that are not named stay NULL."""
    row = [values.get(f.name) for f in STAR[table]]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in STAR[table])
    return inline_table(spark, [row], schema)


def days_between(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per calendar day, both ends included."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    step = F.make_dt_interval(F.lit(1))
    return spark.range(1).select(F.explode(F.sequence(first, last, step)).alias("day"))


def holiday_lookup(holidays: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One name per holiday date, the last by name if a date has several."""
    if settings.national_holidays_only and "global" in holidays.columns:
        holidays = holidays.filter(F.col("global"))
    return holidays.groupBy("holiday_date").agg(F.max("english_name").alias("HolidayName"))


def dim_date(spark: SparkSession, holidays: DataFrame, settings: Settings = Settings()) -> DataFrame:
    days = days_between(spark, settings.calendar_start, settings.calendar_end)
    named = days.join(
        holiday_lookup(holidays, settings), F.col("day") == F.col("holiday_date"), "left"
    )
    fields = [c.alias(n) for n, c in cal.calendar_columns(F.col("day")).items()]
    flag = F.when(F.col("holiday_date").isNotNull(), 1).otherwise(0).alias("IsHoliday")
    missing = sentinel(spark, "DimDate", **UNKNOWN_DATE)
    return as_layout(named.select(*fields, flag, "HolidayName"), "DimDate").unionByName(missing)


def dim_geolocation(geo: DataFrame, regions: DataFrame, store: Store) -> DataFrame:
    """One row per zip prefix; city and state maxima are taken independently."""
    zips = geo.groupBy(F.col("geolocation_zip_code_prefix").alias("ZipPrefix")).agg(
        F.max("geolocation_city").alias("City"),
        F.max("geolocation_state").alias("State"),
        F.avg(labels.nan_to_null(F.col("geolocation_lat"))).alias("Latitude"),
        F.avg(labels.nan_to_null(F.col("geolocation_lng"))).alias("Longitude"),
    )
    zips = zips.filter(F.col("ZipPrefix").isNotNull())
    placed = with_region(zips, "State", regions, "Region")
    return as_layout(
        number_rows(placed, "GeoKey", ["ZipPrefix"], store, "DimGeolocation"), "DimGeolocation"
    )


def _people(
    source: DataFrame, prefix: str, target: str, regions: DataFrame, settings: Settings
) -> DataFrame:
    """Shared cleaning of customers and sellers: city, state, region, zip."""
    cleaned = source.withColumns(
        {
            f"{target}City": labels.tidy_lower(F.col(f"{prefix}_city"), settings.dialect),
            f"{target}State": labels.tidy_upper(F.col(f"{prefix}_state"), settings.dialect),
        }
    ).withColumnsRenamed(
        {f"{prefix}_id": f"{target}ID", f"{prefix}_zip_code_prefix": f"{target}ZipPrefix"}
    )
    return with_region(cleaned, f"{target}State", regions, f"{target}Region")


def dim_customer(
    customers: DataFrame, regions: DataFrame, store: Store, settings: Settings = Settings()
) -> DataFrame:
    members = (
        _people(one_per_key(customers, "customer_id"), "customer", "Customer", regions, settings)
        .withColumnRenamed("customer_unique_id", "CustomerUniqueID")
        .withColumn("IsUnknown", F.lit(0))
        .select(*[n for n in STAR["DimCustomer"].names if n != "CustomerKey"])
    )
    keyed = number_rows(
        members, "CustomerKey", ["CustomerID"], store, "DimCustomer", settings.first_key
    )
    unknown = sentinel(
        store.spark, "DimCustomer",
        CustomerKey=settings.unknown_key, CustomerID=UNKNOWN_ID, CustomerUniqueID=UNKNOWN_ID,
        CustomerCity=settings.unknown_city, CustomerState=UNKNOWN_STATE,
        CustomerRegion=UNKNOWN_LABEL, CustomerZipPrefix=0, IsUnknown=1,
    )
    return as_layout(keyed, "DimCustomer").unionByName(unknown)


def dim_seller(
    sellers: DataFrame, regions: DataFrame, store: Store, settings: Settings = Settings()
) -> DataFrame:
    members = (
        _people(one_per_key(sellers, "seller_id"), "seller", "Seller", regions, settings)
        .withColumn("IsUnknown", F.lit(0))
        .select(*[n for n in STAR["DimSeller"].names if n != "SellerKey"])
    )
    keyed = number_rows(members, "SellerKey", ["SellerID"], store, "DimSeller", settings.first_key)
    unknown = sentinel(
        store.spark, "DimSeller",
        SellerKey=settings.unknown_key, SellerID=UNKNOWN_ID, SellerCity=settings.unknown_city,
        SellerState=UNKNOWN_STATE, SellerRegion=UNKNOWN_LABEL, SellerZipPrefix=0, IsUnknown=1,
    )
    return as_layout(keyed, "DimSeller").unionByName(unknown)


def dim_product(
    products: DataFrame, translation: DataFrame, store: Store, settings: Settings = Settings()
) -> DataFrame:
    names = (
        translation.groupBy(F.col("product_category_name").alias("_source_name"))
        .agg(F.max("product_category_name_english").alias("_english"))
    )
    category = F.col("product_category_name")
    members = (
        one_per_key(products, "product_id")
        .join(names, category == F.col("_source_name"), "left")
        .select(
            F.col("product_id").alias("ProductID"),
            F.coalesce(category, F.lit("unknown")).alias("CategoryNamePortuguese"),
            labels.english_category(category, F.col("_english"), settings.manual_categories)
            .alias("CategoryNameEnglish"),
            F.col("product_weight_g").alias("WeightG"),
            F.col("product_length_cm").alias("LengthCm"),
            F.col("product_height_cm").alias("HeightCm"),
            F.col("product_width_cm").alias("WidthCm"),
            F.col("product_photos_qty").alias("PhotosQty"),
            labels.weight_class(
                F.col("product_weight_g"), settings.light_below, settings.heavy_from
            ).alias("WeightClass"),
            F.lit(0).alias("IsUnknown"),
        )
    )
    keyed = number_rows(
        members, "ProductKey", ["ProductID"], store, "DimProduct", settings.first_key
    )
    unknown = sentinel(
        store.spark, "DimProduct",
        ProductKey=settings.unknown_key, ProductID=UNKNOWN_ID, CategoryNamePortuguese="unknown",
        CategoryNameEnglish=UNKNOWN_LABEL, WeightClass=UNKNOWN_LABEL, IsUnknown=1,
    )
    return as_layout(keyed, "DimProduct").unionByName(unknown)


def dim_payment_type(
    payments: DataFrame, store: Store, settings: Settings = Settings()
) -> DataFrame:
    """Payment types found, plus ``unknown`` unless the data already holds it.

    The added member comes first (py) or last (tsql); the others are in name order.
    """
    kinds = payments.select(
        labels.payment_type(F.col("payment_type"), settings.dialect).alias("PaymentType")
    ).distinct()
    extra = inline_table(store.spark, [(UNKNOWN_PAYMENT,)], "PaymentType string").join(
        kinds, "PaymentType", "left_anti"
    )
    members = kinds.withColumn("_rank", F.lit(1)).unionByName(
        extra.withColumn("_rank", F.lit(0 if settings.is_py else 2))
    )
    members = members.withColumn("PaymentTypeGroup", labels.payment_group(F.col("PaymentType")))
    return as_layout(
        number_rows(members, "PaymentTypeKey", ["_rank", "PaymentType"], store, "DimPaymentType"),
        "DimPaymentType",
    )


def dim_order_status(orders: DataFrame, store: Store) -> DataFrame:
    status = F.col("OrderStatus")
    members = (
        orders.select(F.col("order_status").alias("OrderStatus"))
        .filter(status.isNotNull())
        .distinct()
        .withColumns(
            {
                "IsDeliveredFlag": labels.delivered_flag(status),
                "IsCancelledFlag": labels.cancelled_flag(status),
            }
        )
    )
    return as_layout(
        number_rows(members, "OrderStatusKey", ["OrderStatus"], store, "DimOrderStatus"),
        "DimOrderStatus",
    )
