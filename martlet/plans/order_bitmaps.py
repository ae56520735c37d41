"""Distinct orders from stored bitmaps.

Every order that has a line gets a dense number, in the order of purchase, and each finest group (year, quarter,
month, region, status) stores the numbers of its orders as bitmaps of 32,768 bits.  The orders of any coarser
group are the union of its bitmaps, which counts an order once however many groups it is in, so such a
question reads a few bytes an order and never shuffles orders.  As numbers follow the purchase date, the
orders of a month lie in neighbouring bitmaps and a month holds few of them.

An order without lines has no number and is not counted; a missing order id is none.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.operators.keys import number_rows
from martlet.sources.store import Store

LEVELS = ("YearNumber", "QuarterName", "MonthNumber", "MonthName", "YearMonth", "CustomerRegion", "OrderStatus", "IsDeliveredFlag")


def build(sales: DataFrame, store: Store, levels: Sequence[str] = LEVELS) -> DataFrame:
    """The stored bitmaps: ``levels``, bucket and bits.

    Lines are combined to one row for each order and group before any shuffle, so a hot order is one row a task.
    """
    lines = sales.filter(F.col("OrderID").isNotNull())
    cells = store.put(lines.groupBy("OrderID", *levels).agg(F.min("PurchaseDateKey").alias("_day")), "order-cells")
    first = cells.groupBy("OrderID").agg(F.min("_day").alias("_day"))
    numbered = number_rows(first, "_number", ["_day", "OrderID"], store, "order-numbers").select("OrderID", "_number")
    placed = cells.hint("merge").join(numbered, "OrderID").withColumn("bucket", F.bitmap_bucket_number("_number"))
    bits = placed.groupBy(*levels, "bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position("_number")).alias("bits"))
    out = store.put(bits, "order-bitmaps", ["YearNumber"] if "YearNumber" in levels else [])
    store.drop("order-cells")
    return out


def order_counts(bitmaps: DataFrame, by: Sequence[str] = (), where: Column | None = None, name: str = "Orders") -> DataFrame:
    """Distinct orders of each group of ``by``; groups with a missing key take no part, as in ``olap.grouped``."""
    rows = bitmaps if where is None else bitmaps.filter(where)
    united = rows.dropna(subset=list(by)) if by else rows
    united = united.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return united.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias(name))


def with_sums(bitmaps: DataFrame, sales: DataFrame, by: Sequence[str], sums: Mapping[str, Column], where: Column | None = None) -> DataFrame:
    """Sums over lines beside distinct orders: two small grouped results meet on their group."""
    rows = sales if where is None else sales.filter(where)
    added = rows.dropna(subset=list(by)).groupBy(*by).agg(*[c.alias(n) for n, c in sums.items()])
    return added.join(order_counts(bitmaps, by, where), list(by))
