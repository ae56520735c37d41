"""Report visuals as measure sets over the semantic model.

Every visual takes the page slicers (year, region, order status) as ``filters``.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.plans.semantic import Model, evaluate

SLICERS = ("YearNumber", "CustomerRegion", "OrderStatus")


@dataclass(frozen=True)
class Visual:
    title: str
    measures: tuple[str, ...]
    by: tuple[str, ...] = ()
    order: tuple[str, str] | None = None  # column, "asc" or "desc"

    def frame(self, model: Model, filters: Mapping | None = None) -> DataFrame:
        result = evaluate(model, self.measures, self.by, filters)
        if not self.order:
            return result
        column, way = self.order
        first = F.desc_nulls_last(column) if way == "desc" else F.asc_nulls_last(column)
        return result.orderBy(first, *[c for c in self.by if c != column])


# Which measures each report visual shows, by what, in which order.
VISUALS: dict[str, Visual] = {
    "executive_cards": Visual(
        "Executive KPIs",
        ("Delivered Revenue", "Delivered Orders", "On Time Rate", "Avg Review",
         "Avg Delivery Days"),
    ),
    "monthly_revenue": Visual(
        "Delivered revenue by month", ("Delivered Revenue",), ("YearNumber", "YearMonth"),
        ("YearMonth", "asc"),
    ),
    "region_revenue": Visual(
        "Delivered revenue by region", ("Delivered Revenue",), ("CustomerRegion",),
        ("Delivered Revenue", "desc"),
    ),
    "category_revenue": Visual(
        "Revenue by category", ("Revenue",), ("CategoryNameEnglish",), ("Revenue", "desc")
    ),
    "category_review": Visual(
        "Average review by category", ("Avg Review",), ("CategoryNameEnglish",),
        ("CategoryNameEnglish", "asc"),
    ),
    "category_on_time": Visual(
        "On-time rate by category", ("On Time Rate",), ("CategoryNameEnglish",),
        ("On Time Rate", "asc"),
    ),
    "holiday_revenue": Visual(
        "Revenue on holidays and other days", ("Revenue",), ("IsHoliday",), ("IsHoliday", "asc")
    ),
    "state_delivery_days": Visual(
        "Delivery days by state", ("Avg Delivery Days",), ("CustomerState",),
        ("Avg Delivery Days", "desc"),
    ),
    "logistics_cards": Visual(
        "Logistics KPIs",
        ("Avg Delivery Days", "On Time Rate", "Bad Review Rate", "Freight Ratio"),
    ),
    "payment_type_value": Visual(
        "Payment value by type", ("Payment Value",), ("PaymentType",), ("PaymentType", "asc")
    ),
    "installment_count": Visual(
        "Payments by installments", ("Payment Count",), ("PaymentInstallments",),
        ("PaymentInstallments", "asc"),
    ),
    "payment_cards": Visual(
        "Payment KPIs", ("Payment Value", "Payment Count", "Avg Installments")
    ),
    "state_revenue": Visual(
        "Revenue by state", ("Revenue",), ("CustomerState",), ("Revenue", "desc")
    ),
    "payment_group_value": Visual(
        "Payment value by group", ("Payment Value",), ("PaymentTypeGroup",),
        ("PaymentTypeGroup", "asc"),
    ),
}
VISUALS["logistics_on_time"] = VISUALS["category_on_time"]


def delivery_histogram(sales: DataFrame, width: int = 5) -> DataFrame:
    """Delivered lines per band of delivery days; a band starts at a multiple of ``width``."""
    band = (F.floor(F.col("DeliveryDays") / width) * width).cast("int")
    return (
        sales.filter(F.col("DeliveryDays").isNotNull())
        .groupBy(band.alias("DaysFrom"))
        .agg(F.count("*").alias("Items"))
        .orderBy("DaysFrom")
    )


def delay_by_state(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("CustomerState")
        .agg(F.avg("DelayDays").alias("AvgDelayDays"))
        .orderBy(F.desc_nulls_last("AvgDelayDays"), "CustomerState")
    )


DRILL_COLUMNS = (
    "OrderID", "OrderItemID", "YearMonth", "CustomerState", "SellerState", "Price",
    "FreightValue", "LineTotal", "DeliveryDays", "DelayDays", "OnTimeFlag", "ReviewScore",
)


def category_lines(sales: DataFrame, category: str) -> DataFrame:
    """Drill-through: every line of one category."""
    return sales.filter(F.col("CategoryNameEnglish") == category).select(*DRILL_COLUMNS)
