"""Dimensions and facts over the edge-case shop, both dialects."""

import pytest
from fixture_shop import staging
from pyspark.sql import functions as F

from martlet.operators.dimensions import dim_order_status, dim_payment_type
from martlet.operators.warehouse import build_warehouse, wide_payments, wide_view
from martlet.plans import olap
from martlet.settings import Settings
from martlet.sources.store import Store


@pytest.fixture(scope="module")
def shops(spark):
    tables = staging(spark)
    return {d: build_warehouse(spark, tables, Settings(dialect=d)) for d in ("py", "tsql")}


def by(df, key):
    return {r[key]: r for r in df.collect()}


@pytest.mark.parametrize("dialect, unknown, city", [("py", 1, "unknown"), ("tsql", -1, "Unknown")])
def test_customers(shops, dialect, unknown, city):
    rows = by(shops[dialect].dims["DimCustomer"], "CustomerID")
    sentinel = rows["UNKNOWN"]
    assert (sentinel["CustomerKey"], sentinel["CustomerCity"], sentinel["CustomerState"]) == (unknown, city, "XX")
    assert sentinel["IsUnknown"] == 1 and sentinel["CustomerZipPrefix"] == 0
    first = 2 if dialect == "py" else 1
    assert [rows[c]["CustomerKey"] for c in ("c1", "c2", "c3")] == [first, first + 1, first + 2]
    assert rows["c1"]["CustomerRegion"] == "Southeast" and rows["c2"]["CustomerRegion"] == "North"
    assert rows["c3"]["CustomerRegion"] == "Unknown"
    assert rows["c1"]["CustomerCity"] == ("sao paulo" if dialect == "py" else "\tsao paulo")


def test_products(shops):
    rows = by(shops["py"].dims["DimProduct"], "ProductID")
    assert {p: rows[p]["CategoryNameEnglish"] for p in rows} == {
        "UNKNOWN": "Unknown", "p1": "furniture", "p2": "pc_gamer", "p3": "Other", "p4": "double_b", "p5": "Other",
    }
    assert {p: rows[p]["WeightClass"] for p in rows} == {
        "UNKNOWN": "Unknown", "p1": "Light", "p2": "Medium", "p3": "Medium", "p4": "Heavy", "p5": "Unknown",
    }
    assert rows["p5"]["CategoryNamePortuguese"] == "unknown"
    assert len(shops["py"].dims["DimProduct"].collect()) == 6  # a doubled translation adds no row


def test_geolocation_takes_maxima_apart(shops):
    rows = by(shops["py"].dims["DimGeolocation"], "ZipPrefix")
    assert (rows[1001]["City"], rows[1001]["State"], rows[1001]["Region"]) == ("zeta", "SP", "Southeast")
    assert (rows[1001]["Latitude"], rows[1001]["Longitude"]) == (-15.0, 30.0)
    assert [rows[z]["GeoKey"] for z in (1001, 2002)] == [1, 2]


def test_dates(shops):
    dates = shops["py"].dims["DimDate"]
    assert dates.count() == 1097
    rows = by(dates.filter("DateKey in (20161225, 20160101, 19000101)"), "DateKey")
    assert rows[20161225]["HolidayName"] == "Christmas" and rows[20161225]["IsHoliday"] == 1
    assert rows[20160101]["WeekOfYear"] == 53
    assert rows[19000101]["YearNumber"] == 1900 and rows[19000101]["HolidayName"] is None


def test_payment_types(shops):
    py = {r["PaymentType"]: r["PaymentTypeKey"] for r in shops["py"].dims["DimPaymentType"].collect()}
    assert py == {"unknown": 1, "": 2, " boleto": 3, "boleto": 4, "boleto ": 5, "credit_card": 6,
                  "debit_card": 7, "not_defined": 8, "voucher": 9}
    tsql = {r["PaymentType"]: r["PaymentTypeKey"] for r in shops["tsql"].dims["DimPaymentType"].collect()}
    assert tsql == {"boleto": 1, "credit_card": 2, "debit_card": 3, "not_defined": 4, "voucher": 5, "unknown": 6}


def test_payment_type_and_status_golden(spark):
    # The published dimension rows for these inputs.
    kinds = spark.createDataFrame([(k,) for k in ("boleto", "credit_card", "debit_card", "not_defined", "voucher")], "payment_type string")
    got = [tuple(r) for r in dim_payment_type(kinds, Store(spark)).orderBy("PaymentTypeKey").collect()]
    assert got == [(1, "unknown", "Other"), (2, "boleto", "Bank slip"), (3, "credit_card", "Card"),
                   (4, "debit_card", "Card"), (5, "not_defined", "Other"), (6, "voucher", "Voucher")]
    names = ("approved", "canceled", "created", "delivered", "invoiced", "processing", "shipped", "unavailable")
    orders = spark.createDataFrame([(n,) for n in names], "order_status string")
    got = [tuple(r) for r in dim_order_status(orders, Store(spark)).orderBy("OrderStatusKey").collect()]
    assert got == [(i + 1, n, "Y" if n == "delivered" else "N", "Y" if n == "canceled" else "N") for i, n in enumerate(names)]


def test_unknown_payment_type_in_the_data_adds_no_member(spark):
    kinds = spark.createDataFrame([("unknown",), ("boleto",)], "payment_type string")
    got = {r["PaymentType"]: r["PaymentTypeKey"] for r in dim_payment_type(kinds, Store(spark)).collect()}
    assert got == {"boleto": 1, "unknown": 2}


def sales(shop):
    return {(r["OrderID"], r["OrderItemID"]): r for r in shop.fact_sales.collect()}


def test_sales_rows_and_keys(shops):
    for shop in shops.values():
        rows = sales(shop)
        assert len(rows) == 9  # the line without an order is left out
        assert [rows[k]["SalesKey"] for k in sorted(rows)] == list(range(1, 10))
        assert float(rows["o01", 2]["LineTotal"]) == 22.5


def test_sales_dates(shops):
    py, tsql = sales(shops["py"]), sales(shops["tsql"])
    assert py["o05", 1]["DeliveredDateKey"] == 19000101 and tsql["o05", 1]["DeliveredDateKey"] is None
    assert py["o07", 1]["PurchaseDateKey"] == 20190701  # not in the calendar
    assert tsql["o07", 1]["PurchaseDateKey"] == 19000101
    assert py["o06", 1]["EstimatedDeliveryDateKey"] == 19000101
    gaps = {o: (py[o, 1]["DeliveryDays"], py[o, 1]["DelayDays"], py[o, 1]["OnTimeFlag"]) for o in ("o01", "o02", "o03", "o04", "o05")}
    assert gaps == {"o01": (8, 0, "Y"), "o02": (8, -1, "Y"), "o03": (8, 0, "Y"), "o04": (9, 1, "N"), "o05": (None, None, None)}
    gaps = {o: (tsql[o, 1]["DeliveryDays"], tsql[o, 1]["DelayDays"], tsql[o, 1]["OnTimeFlag"]) for o in ("o01", "o02", "o03", "o04", "o05")}
    assert gaps == {"o01": (9, 0, "N"), "o02": (8, -1, "Y"), "o03": (9, 0, "Y"), "o04": (10, 1, "N"), "o05": (None, None, None)}


@pytest.mark.parametrize("dialect, unknown", [("py", 1), ("tsql", -1)])
def test_sales_lookups(shops, dialect, unknown):
    rows = sales(shops[dialect])
    assert rows["o02", 1]["ProductKey"] == unknown and rows["o03", 1]["SellerKey"] == unknown
    assert rows["o06", 1]["CustomerKey"] == unknown and rows["o06", 1]["CustomerGeoKey"] is None
    assert rows["o07", 1]["CustomerGeoKey"] is None  # zip without a place
    assert rows["o01", 1]["CustomerGeoKey"] == 1


def test_sales_payment_types(shops):
    def kinds(shop):
        return {r["OrderID"]: r["PaymentType"] for r in wide_view(shop.tables()).collect()}

    assert kinds(shops["py"]) == {"o01": "credit_card", "o02": "unknown", "o03": " boleto", "o04": "", "o05": "debit_card",
                                  "o06": "unknown", "o07": "boleto ", "o08": "unknown"}
    assert kinds(shops["tsql"]) == {"o01": "credit_card", "o02": "unknown", "o03": "unknown", "o04": "unknown", "o05": "debit_card",
                                    "o06": "unknown", "o07": "boleto", "o08": "unknown"}


def test_review_scores(shops):
    assert sales(shops["py"])["o01", 1]["ReviewScore"] == 10 / 3
    assert sales(shops["tsql"])["o01", 1]["ReviewScore"] == 3.33
    assert sales(shops["py"])["o08", 1]["ReviewScore"] is None


def test_payment_fact(shops):
    rows = shops["py"].fact_payment.orderBy("PaymentKey").collect()
    assert [(r["OrderID"], r["PaymentSequential"]) for r in rows] == [
        ("o01", 1), ("o01", 2), ("o02", 1), ("o03", 1), ("o03", 2), ("o04", 1), ("o05", 1), ("o07", 1)]
    assert [r["PaymentKey"] for r in rows] == list(range(1, 9))


@pytest.mark.parametrize("dialect", ["py", "tsql"])
def test_stored_wide_tables_equal_the_star_joins(shops, dialect):
    shop = shops[dialect]
    view = wide_view(shop.tables()).drop("SalesKey")
    assert sorted(map(str, view.collect())) == sorted(map(str, shop.sales.select(*view.columns).collect()))
    paid = wide_payments(shop.tables()).drop("PaymentKey")
    assert sorted(map(str, paid.collect())) == sorted(map(str, shop.payments.select(*paid.columns).collect()))


def test_missing_group_keys_drop_out_in_py_and_stay_in_1900_in_tsql(shops):
    years = [r["YearNumber"] for r in olap.grouped(shops["py"].sales, ["YearNumber"], olap.revenue()).collect()]
    assert sorted(years) == [2016, 2017]
    years = [r["YearNumber"] for r in olap.grouped(shops["tsql"].sales, ["YearNumber"], olap.revenue()).collect()]
    assert sorted(years) == [1900, 2016, 2017]


def test_orphans_and_ties(shops):
    rows = {r["Issue"]: r["RowsFound"] for r in olap.orphan_facts(shops["tsql"].sales, -1).collect()}
    assert rows == {"Missing customer": 1, "Missing product": 1, "Missing seller": 1, "Missing purchase date": 1}
    tied = shops["py"].sales.withColumn("LineTotal", F.lit(5).cast("decimal(12,2)")).withColumn("CustomerRegion", F.lit("R"))
    top = olap.slice_region_categories(tied.dropDuplicates(["CategoryNameEnglish"]), "R", top=2).collect()
    names = sorted(r["CategoryNameEnglish"] for r in olap.delivered(tied).select("CategoryNameEnglish").distinct().collect())
    assert len(top) == 2 and [r["CategoryNameEnglish"] for r in top] == sorted(r["CategoryNameEnglish"] for r in top)
    assert set(r["CategoryNameEnglish"] for r in top) <= set(names)
