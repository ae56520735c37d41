"""Order-grain preparation and the two facts.

Everything that depends only on the order (payment type, review score, customer,
date keys, delivery days) is computed once per order and stored; the line and
payment tables then meet it in one join on the order id.  Fact keys are given
afterwards, from the stored lines, and only when a fact is asked for.

Every large join reads both sides straight from their own shuffle and is followed
by a shuffle on another key, so adaptive execution may split a hot order, product,
seller or customer over several tasks without adding an exchange.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.functions import calendar as cal
from martlet.functions import labels
from martlet.operators.keys import FIRST_NUMBER, first_numbers, number_rows
from martlet.operators.lookups import lookup
from martlet.schemas import STAR
from martlet.settings import (
    UNKNOWN_DATE_KEY,
    UNKNOWN_ID,
    UNKNOWN_LABEL,
    UNKNOWN_PAYMENT,
    UNKNOWN_STATE,
    Settings,
)
from martlet.sources.store import Store

DATE_ATTRIBUTES = (
    "YearNumber", "QuarterNumber", "QuarterName", "MonthNumber", "MonthName", "YearMonth",
    "IsHoliday",
)
CUSTOMER_ATTRIBUTES = ("CustomerState", "CustomerRegion", "CustomerCity")
PRODUCT_ATTRIBUTES = ("CategoryNameEnglish", "WeightClass")
SELLER_ATTRIBUTES = ("SellerState", "SellerRegion")
STATUS_ATTRIBUTES = ("OrderStatus", "IsDeliveredFlag", "IsCancelledFlag")
PAYMENT_ATTRIBUTES = ("PaymentType", "PaymentTypeGroup")

# Attributes of the report view: fact key, dimension, its key, columns taken.
VIEW_LOOKUPS = (
    ("PurchaseDateKey", "DimDate", "DateKey", DATE_ATTRIBUTES),
    ("OrderStatusKey", "DimOrderStatus", "OrderStatusKey", STATUS_ATTRIBUTES),
    ("PaymentTypeKey", "DimPaymentType", "PaymentTypeKey", PAYMENT_ATTRIBUTES),
    ("CustomerKey", "DimCustomer", "CustomerKey", CUSTOMER_ATTRIBUTES),
    ("ProductKey", "DimProduct", "ProductKey", PRODUCT_ATTRIBUTES),
    ("SellerKey", "DimSeller", "SellerKey", SELLER_ATTRIBUTES),
)

# Dimensions that grow with the data: a lookup there may shuffle the rows.
GROWING = ("DimCustomer", "DimProduct", "DimSeller")

SALES_ORDER = (
    "OrderID", "OrderItemID", "ProductKey", "SellerKey", "Price", "FreightValue",
)
PAYMENT_ORDER = (
    "OrderID", "PaymentSequential", "PaymentTypeKey", "PaymentInstallments", "PaymentValue",
)


def primary_payment(payments: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The first payment of each order by sequence; equal sequences are settled by type.

    A minimum over a struct combines on the map side, so an order with very many
    payments never meets in one task.
    """
    rank: list[Column] = [F.col("payment_sequential").alias("seq")]
    if settings.is_py:  # a missing sequence sorts last
        rank.insert(0, F.col("payment_sequential").isNull().alias("no_seq"))
    rank.append(F.col("payment_type").alias("payment_type"))
    first = payments.groupBy("order_id").agg(F.min(F.struct(*rank)).alias("first"))
    return first.select("order_id", F.col("first.payment_type").alias("payment_type"))


def review_per_order(reviews: DataFrame, settings: Settings = Settings()) -> DataFrame:
    if settings.is_py:
        score = F.avg("review_score")
    else:
        score = F.avg(F.col("review_score").cast("decimal(4,2)")).cast("decimal(4,2)")
    return reviews.groupBy("order_id").agg(score.cast("double").alias("review_score"))


def _unknown_customer(settings: Settings) -> dict[str, object]:
    return {
        "CustomerKey": settings.unknown_key,
        "CustomerState": UNKNOWN_STATE,
        "CustomerRegion": UNKNOWN_LABEL,
        "CustomerCity": settings.unknown_city,
    }


def _payment_type_lookup(
    df: DataFrame, raw: str, dim_payment_type: DataFrame, settings: Settings
) -> DataFrame:
    """Key of a raw payment type; no match means the unknown member."""
    unknown = dim_payment_type.filter(F.col("PaymentType") == UNKNOWN_PAYMENT)
    probe = F.col(raw) if settings.is_py else F.rtrim(F.col(raw))
    return lookup(
        df, probe, dim_payment_type, "PaymentType",
        {"PaymentTypeKey": "PaymentTypeKey"},
        {"PaymentTypeKey": unknown.select("PaymentTypeKey").scalar()},
    )


def add_attributes(df: DataFrame, dims: Mapping[str, DataFrame], first: Sequence[str] = ()) -> DataFrame:
    """Attributes that ``df`` does not carry yet, looked up by its dimension keys.

    Those of the growing dimensions come first, so attributes of the small ones travel through no shuffle.
    The dimensions in ``first`` come before them: rows that a filter on their attributes drops are not shuffled.
    """
    kept = df.columns
    missing = [row for row in VIEW_LOOKUPS if row[0] in kept and row[3][0] not in kept]
    for key, table, dim_key, attributes in sorted(missing, key=lambda row: (row[1] not in first, row[1] not in GROWING)):
        df = lookup(df, key, dims[table], dim_key, {a: a for a in attributes})
    return df.select(*kept, *[a for *_, attributes in missing for a in attributes])


def _date_keys(settings: Settings) -> dict[str, Column]:
    stamps = {
        "PurchaseDateKey": F.col("order_purchase_timestamp"),
        "DeliveredDateKey": F.col("order_delivered_customer_date"),
        "EstimatedDeliveryDateKey": F.col("order_estimated_delivery_date"),
    }
    if settings.is_py:
        return {name: cal.date_key(stamp) for name, stamp in stamps.items()}
    held = {
        name: cal.calendar_key(stamp, settings.calendar_start, settings.calendar_end)
        for name, stamp in stamps.items()
    }
    held["PurchaseDateKey"] = F.coalesce(held["PurchaseDateKey"], F.lit(UNKNOWN_DATE_KEY))
    return held


def order_header(
    staging: Mapping[str, DataFrame], dims: Mapping[str, DataFrame], settings: Settings = Settings()
) -> DataFrame:
    """One row per order with everything the facts take from it."""
    dialect = settings.dialect
    delivered = F.col("order_delivered_customer_date")
    estimated = F.col("order_estimated_delivery_date")
    purchased = F.col("order_purchase_timestamp")

    orders = staging["orders"].select(
        "order_id", "customer_id", "order_status", purchased, delivered, estimated
    )
    # One row per order on each side; both grow with the orders, so neither is broadcast.
    for part in (
        primary_payment(staging["payments"], settings),
        review_per_order(staging["reviews"], settings),
    ):
        orders = orders.join(part.hint("merge"), "order_id", "left")

    delay = cal.day_gap(delivered, estimated, dialect)
    orders = orders.withColumns(
        {
            **_date_keys(settings),
            "DeliveryDays": cal.day_gap(delivered, purchased, dialect),
            "DelayDays": delay,
            "OnTimeFlag": labels.on_time_flag(delivered, estimated, delay, dialect),
            "ReviewScore": F.col("review_score"),
        }
    )
    orders = lookup(
        orders, "order_status", dims["DimOrderStatus"], "OrderStatus",
        {"OrderStatusKey": "OrderStatusKey"},
    )
    orders = _payment_type_lookup(orders, "payment_type", dims["DimPaymentType"], settings)
    customers = lookup(
        dims["DimCustomer"], "CustomerZipPrefix", dims["DimGeolocation"], "ZipPrefix",
        {"CustomerGeoKey": "GeoKey"},
    )
    orders = lookup(
        orders, "customer_id", customers, "CustomerID",
        {c: c for c in ("CustomerKey", "CustomerGeoKey", *CUSTOMER_ATTRIBUTES)},
        _unknown_customer(settings),
    )
    return orders.select(
        F.col("order_id").alias("OrderID"), "PurchaseDateKey", "DeliveredDateKey",
        "EstimatedDeliveryDateKey", "CustomerKey", "CustomerGeoKey", "PaymentTypeKey",
        "OrderStatusKey", "DeliveryDays", "DelayDays", "OnTimeFlag", "ReviewScore",
        *CUSTOMER_ATTRIBUTES,
    )


def item_lines(
    items: DataFrame, dims: Mapping[str, DataFrame], settings: Settings = Settings()
) -> DataFrame:
    """Order lines with their own dimension keys, prices and report attributes."""
    lines = lookup(
        items, "product_id", dims["DimProduct"], "ProductID",
        {c: c for c in ("ProductKey", *PRODUCT_ATTRIBUTES)},
        {
            "ProductKey": settings.unknown_key,
            "CategoryNameEnglish": UNKNOWN_LABEL,
            "WeightClass": UNKNOWN_LABEL,
        },
    )
    lines = lookup(
        lines, "seller_id", dims["DimSeller"], "SellerID",
        {c: c for c in ("SellerKey", *SELLER_ATTRIBUTES)},
        {
            "SellerKey": settings.unknown_key,
            "SellerState": UNKNOWN_STATE,
            "SellerRegion": UNKNOWN_LABEL,
        },
    )
    return lines.select(
        F.col("order_id").alias("OrderID"),
        F.col("order_item_id").alias("OrderItemID"),
        "ProductKey", "SellerKey",
        F.col("price").cast("decimal(12,2)").alias("Price"),
        F.col("freight_value").cast("decimal(12,2)").alias("FreightValue"),
        *PRODUCT_ATTRIBUTES, *SELLER_ATTRIBUTES,
    )


def _measures() -> dict[str, Column]:
    """Measures that follow from the prices of a line; they are added after its shuffles."""
    total = F.col("Price") + F.col("FreightValue")
    return {"LineTotal": total.cast("decimal(12,2)"), "Quantity": F.lit(1)}


def sales_lines(
    items: DataFrame, header: DataFrame, dims: Mapping[str, DataFrame], settings: Settings = Settings()
) -> DataFrame:
    """Order lines with dimension keys, measures and report attributes, unnumbered."""
    lines = item_lines(items, dims, settings)
    # The header grows with the orders: it is never a broadcast side.
    return lines.join(header.hint("merge"), "OrderID", "inner").withColumns(_measures())


def paid_lines(
    payments: DataFrame, dims: Mapping[str, DataFrame], settings: Settings = Settings()
) -> DataFrame:
    """Payment attempts with their own dimension key and measures."""
    paid = _payment_type_lookup(payments, "payment_type", dims["DimPaymentType"], settings)
    return paid.select(
        F.col("order_id").alias("OrderID"), "PaymentTypeKey",
        F.col("payment_sequential").alias("PaymentSequential"),
        F.col("payment_installments").alias("PaymentInstallments"),
        F.col("payment_value").cast("decimal(12,2)").alias("PaymentValue"),
    )


def payment_lines(
    payments: DataFrame, header: DataFrame, dims: Mapping[str, DataFrame],
    settings: Settings = Settings(),
) -> DataFrame:
    """Payment attempts with dimension keys and report attributes, unnumbered."""
    buyer = header.select("OrderID", "PurchaseDateKey", "CustomerKey", *CUSTOMER_ATTRIBUTES)
    return paid_lines(payments, dims, settings).join(buyer.hint("merge"), "OrderID", "inner")


def store_sales(lines: DataFrame, dims: Mapping[str, DataFrame], store: Store) -> DataFrame:
    """Keep the lines with all report attributes, split by purchase year.

    Attributes of the small dimensions are added on the way to the files, so they
    never travel through a shuffle.
    """
    return store.put(add_attributes(lines, dims), "Sales", ["YearNumber"])


def store_payments(lines: DataFrame, dims: Mapping[str, DataFrame], store: Store) -> DataFrame:
    return store.put(add_attributes(lines, dims), "Payments", ["YearNumber"])


def fact_sales(sales: DataFrame, store: Store) -> DataFrame:
    """The declared twenty columns of the sales fact, numbered and stored."""
    return _numbered(sales, "FactSales", SALES_ORDER, store)


def fact_payment(payments: DataFrame, store: Store) -> DataFrame:
    return _numbered(payments, "FactPayment", PAYMENT_ORDER, store)


def _numbered(wide: DataFrame, table: str, order_by: Sequence[str], store: Store) -> DataFrame:
    """A fact from its stored wide table: only the declared columns are sorted for the key."""
    key, *names = STAR[table].names
    return number_rows(wide.select(*names), key, order_by, store, table, stored=True)


def export_sales(
    items: DataFrame, header: DataFrame, dims: Mapping[str, DataFrame], store: Store, settings: Settings = Settings()
) -> DataFrame:
    """The sales fact for a single reader, straight from its joins and not stored."""
    met = _times_met(dims["DimProduct"], "ProductID", "product_id") * _times_met(dims["DimSeller"], "SellerID", "seller_id")
    counts = items.groupBy(F.col("order_id").alias("OrderID")).agg(F.sum(met).alias("_lines"))
    lines = item_lines(items, dims, settings).drop(*PRODUCT_ATTRIBUTES, *SELLER_ATTRIBUTES)
    return _numbered_by_order(lines, counts, header, "FactSales", SALES_ORDER, store, _measures())


def export_payment(
    payments: DataFrame, header: DataFrame, dims: Mapping[str, DataFrame], store: Store, settings: Settings = Settings()
) -> DataFrame:
    """The payment fact for a single reader, straight from its joins and not stored."""
    counts = payments.groupBy(F.col("order_id").alias("OrderID")).agg(F.count("*").alias("_lines"))
    buyer = header.select("OrderID", "PurchaseDateKey", "CustomerKey")
    return _numbered_by_order(paid_lines(payments, dims, settings), counts, buyer, "FactPayment", PAYMENT_ORDER, store, {})


def _times_met(dim: DataFrame, key: str, probe: str) -> Column:
    """Rows of ``dim`` that a line meets: one, unless a given id is spelled like the one of the unknown member."""
    unknown = dim.filter(F.col(key) == UNKNOWN_ID).count()
    return F.when(F.col(probe) == UNKNOWN_ID, unknown).otherwise(1)


def _numbered_by_order(
    lines: DataFrame, counts: DataFrame, header: DataFrame, table: str, order_by: Sequence[str], store: Store,
    added: Mapping[str, Column],
) -> DataFrame:
    """The declared columns of a fact with the keys that ``_numbered`` gives, without sorting all its lines.

    The order id leads ``order_by``, so the key of a line follows from its place in its order and from the
    lines of all orders before: only the orders are sorted.  Lines are numbered where they meet their order,
    after one shuffle; those of one order meet in one task.  An order that is there several times has its
    lines as often.
    """
    own = Window.partitionBy("OrderID")
    copies = header.groupBy("OrderID").agg(F.count("*").alias("_copies"))
    counts = counts.join(copies.hint("merge"), "OrderID", "inner")
    rows = counts.select("OrderID", "_copies", (F.col("_lines") * F.col("_copies")).alias("_rows"))
    first = first_numbers(rows, "OrderID", "_rows", store, f"{table}_first").drop("_rows")
    placed = lines.filter(F.col("OrderID").isNotNull()).withColumn("_nth", F.row_number().over(own.orderBy(*order_by)))
    orders = header.withColumn("_copy", F.row_number().over(own.orderBy("OrderID")))
    joined = placed.join(orders.hint("merge"), "OrderID", "inner").join(first.hint("merge"), "OrderID", "inner")
    key, *names = STAR[table].names
    number = F.col(FIRST_NUMBER) + (F.col("_nth") - 1) * F.col("_copies") + F.col("_copy") - 1
    return joined.withColumns({**added, key: number}).select(key, *names)
