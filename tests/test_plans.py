"""The physical plans: no Python, no cross joins, pruned scans, skew split."""

import pytest
from fixture_shop import staging
from pyspark.sql import functions as F

from conftest import SMALL
from martlet.operators import facts
from martlet.operators.lookups import inline_table, lookup
from martlet.plans import olap
from martlet.registry import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(spark, small, small_tsql, name):
    text = plan(QUERIES[name](spark, SMALL))
    words = ["Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin"]
    if name not in ("s01_csv_round_trip", "t6_prepared_sources"):  # free text is read in splits, by windows over a file's splits and a split's lines
        words.append("Window [")
    for word in words:
        assert word not in text, word


def test_report_is_one_pruned_scan(spark, small):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    text = plan(olap.dice_states(small.sales, 1998, "credit_card"))
    assert text.count("FileScan") == 1 and "Join" not in text
    assert "PartitionFilters: [isnotnull(YearNumber" in text
    assert "EqualTo(PaymentType,credit_card)" in text
    scan = text[text.index("ReadSchema"):]
    assert "OrderID" not in scan and "Price" not in scan


def test_unused_key_is_pruned(small):
    text = plan(small.fact_sales.groupBy("OrderStatusKey").agg(F.sum("LineTotal")))
    assert "_row_place" not in text


def test_header_is_never_broadcast(spark, small):
    dims, tables = small.dims, staging(spark)
    header = spark.createDataFrame([], small.sales.select(
        "OrderID", "PurchaseDateKey", "CustomerKey", *facts.CUSTOMER_ATTRIBUTES).schema)
    text = plan(facts.payment_lines(tables["payments"], header, dims))
    assert "SortMergeJoin [OrderID" in text


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "4KB",  # the tiny dimensions only
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
}


@pytest.fixture
def skew_settings(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(name, m, keys=5000):
    """Every third row holds the first key; the others are spread."""
    return F.when(F.col("id") % 3 == m, f"{name}0").otherwise(F.concat(F.lit(name), F.col("id") % keys))


def member(spark, prefix, key, *attributes):
    ids = spark.range(5000).select(
        F.col("id").alias(key), F.concat(F.lit(prefix), "id").alias(key.replace("Key", "ID")))
    return ids.withColumns({a: F.lit("x") for a in attributes})


def run(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_hot_product_seller_and_order_are_split(spark, skew_settings):
    n = 120_000
    cash = F.lit(1).cast("decimal(12,2)")
    lines = spark.range(0, n, 1, 8).select(
        hot("o", 0).alias("order_id"), F.col("id").cast("int").alias("order_item_id"),
        hot("p", 1).alias("product_id"), hot("s", 2).alias("seller_id"),
        cash.alias("price"), cash.alias("freight_value"))
    dims = {"DimProduct": member(spark, "p", "ProductKey", *facts.PRODUCT_ATTRIBUTES),
            "DimSeller": member(spark, "s", "SellerKey", *facts.SELLER_ATTRIBUTES)}
    header = spark.range(5000).select(F.concat(F.lit("o"), "id").alias("OrderID"), F.col("id").alias("CustomerKey"))
    rows, text = run(facts.sales_lines(lines, header, dims).repartitionByRange("OrderID", "OrderItemID"))
    assert text.count("SortMergeJoin(skew=true)") >= 3
    assert len(rows) == n


def test_hot_order_of_payments_is_split(spark, skew_settings):
    n = 120_000
    paid = spark.range(0, n, 1, 8).select(
        hot("o", 0).alias("order_id"), F.col("id").cast("int").alias("payment_sequential"),
        F.lit("boleto").alias("payment_type"), F.lit(1).alias("payment_installments"),
        F.lit(1).cast("decimal(12,2)").alias("payment_value"))
    dims = {"DimPaymentType": spark.createDataFrame(
        [(1, "unknown", "Other"), (2, "boleto", "Bank slip")], "PaymentTypeKey long, PaymentType string, PaymentTypeGroup string")}
    header = spark.range(5000).select(
        F.concat(F.lit("o"), "id").alias("OrderID"), F.lit(20170101).alias("PurchaseDateKey"), F.col("id").alias("CustomerKey"),
        *[F.lit("x").alias(c) for c in facts.CUSTOMER_ATTRIBUTES])
    lines = facts.payment_lines(paid, header, dims)
    rows, text = run(lines.repartitionByRange("OrderID", "PaymentSequential"))
    assert "SortMergeJoin(skew=true) [OrderID" in text and len(rows) == n
    first = facts.primary_payment(paid)
    assert first.count() == 5000 and "Window" not in plan(first)


def test_hot_customer_of_orders_is_split(spark, skew_settings):
    n = 120_000
    stamp = F.lit("2017-01-01 00:00:00").cast("timestamp_ntz")
    empty = staging(spark)
    tables = {
        "orders": spark.range(0, n, 1, 8).select(
            F.md5(F.col("id").cast("string")).alias("order_id"), hot("c", 0).alias("customer_id"), F.lit("delivered").alias("order_status"),
            *[stamp.alias(c) for c in ("order_purchase_timestamp", "order_delivered_customer_date", "order_estimated_delivery_date")]),
        "payments": empty["payments"], "reviews": empty["reviews"],
    }
    dims = {
        "DimOrderStatus": inline_table(spark, [(1, "delivered", "Y", "N")], "OrderStatusKey bigint, OrderStatus string, IsDeliveredFlag string, IsCancelledFlag string"),
        "DimPaymentType": inline_table(spark, [(1, "unknown", "Other")], "PaymentTypeKey bigint, PaymentType string, PaymentTypeGroup string"),
        "DimGeolocation": inline_table(spark, [(1, 5), (2, 6)], "GeoKey bigint, ZipPrefix int"),
        "DimCustomer": member(spark, "c", "CustomerKey", *facts.CUSTOMER_ATTRIBUTES).withColumn("CustomerZipPrefix", (F.col("CustomerKey") % 2 + 5).cast("int")),
    }
    rows, text = run(facts.order_header(tables, dims))
    assert "SortMergeJoin(skew=true) [customer_id" in text
    assert len(rows) == n and {r["CustomerGeoKey"] for r in rows} == {1, 2}


def test_lookup_keeps_every_row(spark):
    left = spark.createDataFrame([("a",), (None,), ("z",)], "k string")
    dim = spark.createDataFrame([("a", 5)], "id string, key int")
    got = {r["k"]: r["key"] for r in lookup(left, "k", dim, "id", {"key": "key"}, {"key": -1}).collect()}
    assert got == {"a": 5, None: -1, "z": -1}
