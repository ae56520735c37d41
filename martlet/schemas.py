"""Column layouts of the staging tables, the star schema and the audit tables."""

from __future__ import annotations

from pyspark.sql import types as T


_KINDS = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(),
    "double": T.DoubleType(), "boolean": T.BooleanType(), "date": T.DateType(),
    "timestamp": T.TimestampType(), "timestamp_ntz": T.TimestampNTZType(),
    "decimal(12,2)": T.DecimalType(12, 2), "array<string>": T.ArrayType(T.StringType()),
}


def _struct(columns: str) -> T.StructType:
    """Layout from "name type" pairs; unlike a DDL string it needs no session."""
    pairs = (pair.split() for pair in columns.split(", "))
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in pairs])


STAGING: dict[str, T.StructType] = {
    "customers": _struct(
        "customer_id string, customer_unique_id string, customer_zip_code_prefix int,"
        " customer_city string, customer_state string"
    ),
    "orders": _struct(
        "order_id string, customer_id string, order_status string,"
        " order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz,"
        " order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz,"
        " order_estimated_delivery_date timestamp_ntz"
    ),
    "order_items": _struct(
        "order_id string, order_item_id int, product_id string, seller_id string,"
        " shipping_limit_date timestamp_ntz, price decimal(12,2), freight_value decimal(12,2)"
    ),
    "payments": _struct(
        "order_id string, payment_sequential int, payment_type string,"
        " payment_installments int, payment_value decimal(12,2)"
    ),
    "reviews": _struct(
        "review_id string, order_id string, review_score int, review_comment_title string,"
        " review_comment_message string, review_creation_date timestamp_ntz,"
        " review_answer_timestamp timestamp_ntz"
    ),
    "products": _struct(
        "product_id string, product_category_name string, product_name_lenght int,"
        " product_description_lenght int, product_photos_qty int, product_weight_g double,"
        " product_length_cm double, product_height_cm double, product_width_cm double"
    ),
    "sellers": _struct(
        "seller_id string, seller_zip_code_prefix int, seller_city string, seller_state string"
    ),
    "geolocation": _struct(
        "geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double,"
        " geolocation_city string, geolocation_state string"
    ),
    "category_translation": _struct(
        "product_category_name string, product_category_name_english string"
    ),
    "holidays": _struct(
        "holiday_date date, local_name string, english_name string, country_code string"
    ),
}

# The given order and line tables, as far as the staging tables use them.
GIVEN: dict[str, T.StructType] = {
    "region": _struct("r_regionkey int, r_name string"),
    "nation": _struct("n_nationkey int, n_name string, n_regionkey int"),
    "customer": _struct("c_custkey bigint, c_nationkey int, c_acctbal double"),
    "supplier": _struct("s_suppkey bigint, s_nationkey int, s_acctbal double"),
    "part": _struct(
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int"
    ),
    "orders": _struct(
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz"
    ),
    "lineitem": _struct(
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
        " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
        " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
}

# Business key of each staging table (geolocation has none).
STAGING_KEYS: dict[str, tuple[str, ...]] = {
    "customers": ("customer_id",),
    "orders": ("order_id",),
    "order_items": ("order_id", "order_item_id"),
    "payments": ("order_id", "payment_sequential"),
    "reviews": ("review_id",),
    "products": ("product_id",),
    "sellers": ("seller_id",),
    "category_translation": ("product_category_name",),
    "holidays": ("holiday_date",),
}

# Holiday feed as it lands: JSON array of objects.
HOLIDAY_FEED = _struct(
    "date string, localName string, name string, countryCode string, fixed boolean,"
    " global boolean, counties array<string>, launchYear int, types array<string>"
)
CATEGORY_XML = _struct("portuguese string, english string")

STAR: dict[str, T.StructType] = {
    "DimDate": _struct(
        "DateKey int, FullDate date, DayNumber int, DayName string, WeekdayFlag string,"
        " WeekendFlag string, WeekOfYear int, MonthNumber int, MonthName string,"
        " QuarterNumber int, QuarterName string, YearNumber int, YearMonth string,"
        " IsHoliday int, HolidayName string"
    ),
    "DimCustomer": _struct(
        "CustomerKey bigint, CustomerID string, CustomerUniqueID string, CustomerCity string,"
        " CustomerState string, CustomerRegion string, CustomerZipPrefix int, IsUnknown int"
    ),
    "DimProduct": _struct(
        "ProductKey bigint, ProductID string, CategoryNamePortuguese string,"
        " CategoryNameEnglish string, WeightG double, LengthCm double, HeightCm double,"
        " WidthCm double, PhotosQty int, WeightClass string, IsUnknown int"
    ),
    "DimSeller": _struct(
        "SellerKey bigint, SellerID string, SellerCity string, SellerState string,"
        " SellerRegion string, SellerZipPrefix int, IsUnknown int"
    ),
    "DimGeolocation": _struct(
        "GeoKey bigint, ZipPrefix int, City string, State string, Region string,"
        " Latitude double, Longitude double"
    ),
    "DimPaymentType": _struct("PaymentTypeKey bigint, PaymentType string, PaymentTypeGroup string"),
    "DimOrderStatus": _struct(
        "OrderStatusKey bigint, OrderStatus string, IsDeliveredFlag string, IsCancelledFlag string"
    ),
    "FactSales": _struct(
        "SalesKey bigint, PurchaseDateKey int, DeliveredDateKey int, EstimatedDeliveryDateKey int,"
        " CustomerKey bigint, ProductKey bigint, SellerKey bigint, CustomerGeoKey bigint,"
        " PaymentTypeKey bigint, OrderStatusKey bigint, OrderID string, OrderItemID int,"
        " Price decimal(12,2), FreightValue decimal(12,2), LineTotal decimal(12,2), Quantity int,"
        " DeliveryDays int, DelayDays int, OnTimeFlag string, ReviewScore double"
    ),
    "FactPayment": _struct(
        "PaymentKey bigint, PurchaseDateKey int, CustomerKey bigint, PaymentTypeKey bigint,"
        " OrderID string, PaymentSequential int, PaymentInstallments int,"
        " PaymentValue decimal(12,2)"
    ),
}

# Unique business key of each dimension.
STAR_KEYS: dict[str, str] = {
    "DimCustomer": "CustomerID",
    "DimProduct": "ProductID",
    "DimSeller": "SellerID",
    "DimGeolocation": "ZipPrefix",
    "DimPaymentType": "PaymentType",
    "DimOrderStatus": "OrderStatus",
}

# Declared foreign keys: (fact, fact column, dimension, dimension key).
FOREIGN_KEYS: tuple[tuple[str, str, str, str], ...] = (
    ("FactSales", "PurchaseDateKey", "DimDate", "DateKey"),
    ("FactSales", "CustomerKey", "DimCustomer", "CustomerKey"),
    ("FactSales", "ProductKey", "DimProduct", "ProductKey"),
    ("FactSales", "SellerKey", "DimSeller", "SellerKey"),
    ("FactSales", "OrderStatusKey", "DimOrderStatus", "OrderStatusKey"),
    ("FactPayment", "PurchaseDateKey", "DimDate", "DateKey"),
    ("FactPayment", "CustomerKey", "DimCustomer", "CustomerKey"),
    ("FactPayment", "PaymentTypeKey", "DimPaymentType", "PaymentTypeKey"),
)

# Columns declared NOT NULL in the facts.
REQUIRED: dict[str, tuple[str, ...]] = {
    "FactSales": (
        "SalesKey", "PurchaseDateKey", "CustomerKey", "ProductKey", "SellerKey",
        "OrderStatusKey", "OrderID", "OrderItemID", "Price", "FreightValue", "LineTotal",
        "Quantity",
    ),
    "FactPayment": (
        "PaymentKey", "PurchaseDateKey", "CustomerKey", "PaymentTypeKey", "OrderID",
        "PaymentSequential", "PaymentInstallments", "PaymentValue",
    ),
}

LOAD_LOG = _struct(
    "PackageName string, TaskName string, Status string, RowsAffected bigint,"
    " MessageText string, StartedAt timestamp, FinishedAt timestamp"
)
REJECTED_ROWS = _struct(
    "SourceTable string, BusinessKey string, ReasonCode string, ReasonText string,"
    " RejectedAt timestamp"
)
