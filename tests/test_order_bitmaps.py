"""Distinct orders from stored bitmaps against counting them."""

import pytest
from pyspark.sql import functions as F

from martlet.plans import olap, order_bitmaps
from martlet.sources.store import Store

from test_plans import plan

SCHEMA = ("OrderID string, PurchaseDateKey int, YearNumber int, QuarterName string, MonthNumber int, MonthName string, "
          "YearMonth string, CustomerRegion string, OrderStatus string, IsDeliveredFlag string")


@pytest.fixture(scope="module")
def stored(spark, small):
    return order_bitmaps.build(small.sales, Store(spark, "bitmaps"))


@pytest.mark.parametrize("by", [[], ["YearNumber"], ["YearNumber", "QuarterName"], ["CustomerRegion"], ["MonthName", "OrderStatus"]])
def test_roll_up_to_any_group(small, stored, by):
    got = {tuple(r) for r in order_bitmaps.order_counts(stored, by).collect()}
    want = small.sales.dropna(subset=by) if by else small.sales
    assert got == {tuple(r) for r in want.groupBy(*by).agg(olap.orders()).collect()}


def test_questions_do_not_shuffle_orders(stored):
    text = plan(order_bitmaps.order_counts(stored, ["YearNumber"], F.col("IsDeliveredFlag") == "Y"))
    assert "OrderID" not in text and text.count("FileScan") == 1


def test_an_order_in_several_groups_counts_once(spark):
    rows = [("a", 19970101, 1997, "Q1", 1, "January", "1997-01", region, "delivered", "Y") for region in ("X", "Y", "Y")]
    rows += [("b", 19970401, 1997, "Q2", 4, "April", "1997-04", None, "shipped", "N"), (None, 19970401, 1997, "Q2", 4, "April", "1997-04", "X", "shipped", "N")]
    rows += [(f"c{k}", 19980101, 1998, "Q1", 1, "January", "1998-01", "X", "delivered", "Y") for k in range(70_000)]  # three buckets
    rows += [("hot", 19980101, 1998, "Q1", 1, "January", "1998-01", "X", "delivered", "Y")] * 20_000
    sales = spark.createDataFrame(rows, SCHEMA).repartition(4)
    bits = order_bitmaps.build(sales, Store(spark, "bitmaps"))
    count = lambda *by, **more: {tuple(r) for r in order_bitmaps.order_counts(bits, list(by), **more).collect()}
    assert count() == {(70_003,)}
    assert count("CustomerRegion") == {("X", 70_002), ("Y", 1)}
    assert count("YearNumber") == {(1997, 2), (1998, 70_001)}
    assert count(where=F.col("CustomerRegion") == "Z") == {(0,)}


def test_empty(spark):
    none = order_bitmaps.build(spark.createDataFrame([], SCHEMA), Store(spark, "bitmaps"))
    assert order_bitmaps.order_counts(none).collect()[0][0] == 0
    assert order_bitmaps.order_counts(none, ["YearNumber"]).count() == 0
