"""The fixed analytic questions over the wide sales and payment tables.

Each function takes the wide table (``Warehouse.sales`` / ``Warehouse.payments``
or the result of ``wide_view``) and returns a lazy DataFrame.  ``dialect`` picks
between the two published forms of a question where they differ.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.functions.numbers import share_pct
from martlet.operators.lookups import union_all
from martlet.operators.warehouse import Warehouse, delivered
from martlet.settings import UNKNOWN_DATE_KEY


def revenue() -> Column:
    return F.sum("LineTotal").cast("double").alias("Revenue")


def items(name: str = "Items") -> Column:
    return F.sum("Quantity").alias(name)


def orders() -> Column:
    return F.count_distinct("OrderID").alias("Orders")


def avg_review() -> Column:
    return F.avg("ReviewScore").alias("AvgReview")


def grouped(df: DataFrame, keys: Sequence[str], *measures: Column) -> DataFrame:
    """Group by columns that are all present; rows with a missing key take no part."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(*measures)


def rollup_year_quarter(sales: DataFrame, dialect: str = "py") -> DataFrame:
    named = items("Items" if dialect == "py" else "ItemsSold")
    keys = ["YearNumber", "QuarterName"]
    return grouped(delivered(sales), keys, revenue(), named, orders()).orderBy(*keys)


def drilldown_months(sales: DataFrame, year: int = 2017, dialect: str = "py") -> DataFrame:
    if dialect == "py":
        picked = delivered(sales).filter(F.col("YearNumber") == year)
        result = grouped(picked, ["MonthNumber", "MonthName"], revenue(), orders())
        return result.orderBy("MonthNumber")
    picked = sales.filter(F.col("YearNumber") == year)
    result = grouped(picked, ["YearMonth", "MonthName", "MonthNumber"], revenue())
    return result.orderBy("MonthNumber").select("YearMonth", "MonthName", "Revenue")


def slice_region_categories(
    sales: DataFrame, region: str = "Southeast", top: int | None = 15, dialect: str = "py"
) -> DataFrame:
    """Category revenue of one region; py keeps the ``top`` delivered categories."""
    picked = sales.filter(F.col("CustomerRegion") == region)
    if dialect == "py":
        picked = delivered(picked)
    result = grouped(picked, ["CategoryNameEnglish"], revenue()).orderBy(
        F.desc("Revenue"), "CategoryNameEnglish"
    )
    return result.limit(top) if dialect == "py" and top else result


def dice_states(
    sales: DataFrame, year: int = 2018, payment_type: str = "credit_card"
) -> DataFrame:
    picked = delivered(sales).filter(
        (F.col("YearNumber") == year) & (F.col("PaymentType") == payment_type)
    )
    return grouped(picked, ["CustomerState"], revenue(), avg_review()).orderBy(
        F.desc("Revenue"), "CustomerState"
    )


def pivot_region_year(
    sales: DataFrame, years: Sequence[int] | None = None, dialect: str = "py"
) -> DataFrame:
    """Revenue by region with one column per year; empty cells are 0 (py) or NULL (tsql).

    Without ``years`` they are found in the rows that are pivoted, by a small job of their
    own (a handful of values reaches the driver).
    """
    rows = delivered(sales).dropna(subset=["CustomerRegion", "YearNumber"])
    if years is None:
        years = _years(rows)
    result = (
        rows.groupBy("CustomerRegion")
        .pivot("YearNumber", list(years))
        .agg(F.sum("LineTotal").cast("double"))
        .orderBy("CustomerRegion")
    )
    return result.fillna(0.0) if dialect == "py" else result


def _years(rows: DataFrame) -> list[int]:
    return [r[0] for r in rows.select("YearNumber").distinct().orderBy(1).collect()]


def calendar_years(dim_date: DataFrame) -> list[int]:
    """Every year of the calendar, its unknown member left out."""
    return _years(dim_date.filter(F.col("DateKey") != UNKNOWN_DATE_KEY))


def _on_time_rows(sales: DataFrame) -> DataFrame:
    return delivered(sales).filter(F.col("OnTimeFlag").isNotNull())


def kpi_by_category(
    sales: DataFrame, min_items: int = 200, dialect: str = "py"
) -> DataFrame:
    """On-time share, delivery days and review of the categories with enough items."""
    count = items() if dialect == "py" else F.count("*").alias("DeliveredItems")
    measures = [
        count,
        share_pct(F.col("OnTimeFlag") == "Y").alias("OnTimePct"),
        F.avg("DeliveryDays").alias("AvgDeliveryDays"),
        avg_review(),
    ]
    if dialect == "py":
        measures.append(revenue())
    result = grouped(_on_time_rows(sales), ["CategoryNameEnglish"], *measures)
    enough = F.col("Items" if dialect == "py" else "DeliveredItems") >= min_items
    return result.filter(enough).orderBy("OnTimePct", "CategoryNameEnglish")


def holiday_split(sales: DataFrame, dialect: str = "py") -> DataFrame:
    """Holiday against other days, whatever the order status."""
    if dialect == "py":
        return grouped(sales, ["IsHoliday"], orders(), revenue(), avg_review()).orderBy("IsHoliday")
    kind = F.when(F.col("IsHoliday") == 1, "Holiday").otherwise("Non-holiday")
    return (
        sales.filter(F.col("YearNumber").isNotNull())
        .groupBy(kind.alias("DayType"))
        .agg(orders(), revenue(), avg_review())
        .orderBy("DayType")
    )


def orphan_facts(sales: DataFrame, unknown_key: int = 1) -> DataFrame:
    """Rows that fell back to an unknown member, by kind; one scan."""
    checks = {
        "Missing customer": F.col("CustomerKey") == unknown_key,
        "Missing product": F.col("ProductKey") == unknown_key,
        "Missing seller": F.col("SellerKey") == unknown_key,
        "Missing purchase date": F.col("PurchaseDateKey") == UNKNOWN_DATE_KEY,
    }
    counts = sales.agg(*[F.count_if(rule).alias(name) for name, rule in checks.items()])
    return counts.unpivot([], list(checks), "Issue", "RowsFound")


def top_categories(sales: DataFrame, top: int = 10) -> DataFrame:
    result = grouped(
        delivered(sales), ["CategoryNameEnglish"], revenue(), orders(), avg_review()
    )
    return result.orderBy(F.desc("Revenue"), "CategoryNameEnglish").limit(top)


def payment_mix(payments: DataFrame) -> DataFrame:
    return grouped(
        payments, ["PaymentType"],
        F.sum("PaymentValue").cast("double").alias("PaymentValue"),
        F.count_distinct("OrderID").alias("Txn"),
    ).orderBy(F.desc("PaymentValue"), "PaymentType")


def monthly(sales: DataFrame) -> DataFrame:
    return grouped(delivered(sales), ["YearMonth"], revenue(), orders()).orderBy("YearMonth")


def region_totals(sales: DataFrame) -> DataFrame:
    return grouped(
        delivered(sales), ["CustomerRegion"], revenue(), orders(), avg_review()
    ).orderBy(F.desc("Revenue"), "CustomerRegion")


def slowest_categories(sales: DataFrame, top: int = 8, min_items: int = 200) -> DataFrame:
    return kpi_by_category(sales, min_items).limit(top)


def row_counts(warehouse: Warehouse) -> DataFrame:
    """Rows of the two facts and four dimensions."""
    sources = {
        "fact_sales_rows": warehouse.sales,
        "fact_payment_rows": warehouse.payments,
        "dim_customer_rows": warehouse.dims["DimCustomer"],
        "dim_product_rows": warehouse.dims["DimProduct"],
        "dim_seller_rows": warehouse.dims["DimSeller"],
        "dim_date_rows": warehouse.dims["DimDate"],
    }
    return union_all(
        [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("metric"), "rows")
         for name, df in sources.items()]
    )


def _kpi_columns() -> dict[str, Column]:
    """The five headline figures as aggregates over delivered rows."""
    return {
        "total_revenue_delivered": F.sum("LineTotal").cast("double"),
        "total_orders_delivered": F.count_distinct("OrderID"),
        "avg_review": F.avg("ReviewScore"),
        "ontime_rate": F.avg(
            F.when(F.col("OnTimeFlag") == "Y", 100.0).when(F.col("OnTimeFlag").isNotNull(), 0.0)
        ),
        "avg_delivery_days": F.avg("DeliveryDays"),
    }


def kpi(sales: DataFrame, name: str) -> DataFrame:
    return delivered(sales).agg(_kpi_columns()[name].alias(name))


def headline(sales: DataFrame) -> DataFrame:
    """All five headline figures in one scan."""
    return delivered(sales).agg(*[c.alias(n) for n, c in _kpi_columns().items()])
