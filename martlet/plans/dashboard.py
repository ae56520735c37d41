"""The dashboard document: one row holding every published figure as nested columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.functions import numbers
from martlet.operators.lookups import side_by_side
from martlet.operators.warehouse import Warehouse
from martlet.plans import olap


def _listed(df: DataFrame, name: str, order: list[tuple[str, str]]) -> DataFrame:
    """A grouped result as one row with an array of structs in the given order.

    Only results of a bounded size come here: calendar periods, regions, payment
    types and top-k lists.
    """
    fields = [F.col(c) for c in df.columns]
    position = df.select(
        F.struct(
            *[(-F.col(c) if way == "desc" else F.col(c)).alias(f"_{i}")
              for i, (c, way) in enumerate(order)],
            F.struct(*fields).alias("row"),
        ).alias("placed")
    )
    return position.agg(F.sort_array(F.collect_list("placed")).alias("placed")).select(
        F.transform("placed", lambda p: p["row"]).alias(name)
    )


def headline_figures(warehouse: Warehouse) -> DataFrame:
    """Row counts, unknown-member counts and the five headline figures, one row."""
    unknown = warehouse.settings.unknown_key
    facts = warehouse.sales.agg(
        F.count("*").alias("fact_sales_rows"),
        F.count_if(F.col("CustomerKey") == unknown).alias("unknown_customer_facts"),
        F.count_if(F.col("ProductKey") == unknown).alias("unknown_product_facts"),
        F.count_if(F.col("SellerKey") == unknown).alias("unknown_seller_facts"),
    )
    others = {
        "fact_payment_rows": warehouse.payments,
        "dim_customer_rows": warehouse.dims["DimCustomer"],
        "dim_product_rows": warehouse.dims["DimProduct"],
        "dim_seller_rows": warehouse.dims["DimSeller"],
        "dim_date_rows": warehouse.dims["DimDate"],
    }
    counts = [df.agg(F.count("*").alias(name)) for name, df in others.items()]
    return side_by_side(facts, *counts, olap.headline(warehouse.sales))


def metrics_document(warehouse: Warehouse, min_items: int = 200) -> DataFrame:
    """The eight sections of the dashboard as one nested row."""
    sales, payments = warehouse.sales, warehouse.payments
    kpis = headline_figures(warehouse)
    document = kpis.select(F.struct(*kpis.columns).alias("kpis"))
    sections = (
        ("monthly", olap.monthly(sales), [("YearMonth", "asc")]),
        ("top_categories", olap.top_categories(sales),
         [("Revenue", "desc"), ("CategoryNameEnglish", "asc")]),
        ("payment_mix", olap.payment_mix(payments),
         [("PaymentValue", "desc"), ("PaymentType", "asc")]),
        ("region", olap.region_totals(sales), [("Revenue", "desc"), ("CustomerRegion", "asc")]),
        ("rollup", olap.rollup_year_quarter(sales), [("YearNumber", "asc"), ("QuarterName", "asc")]),
        ("holiday", olap.holiday_split(sales), [("IsHoliday", "asc")]),
        ("kpi_slowest_categories", olap.slowest_categories(sales, min_items=min_items),
         [("OnTimePct", "asc"), ("CategoryNameEnglish", "asc")]),
    )
    return side_by_side(document, *[_listed(result, name, order) for name, result, order in sections])


def as_json(document: DataFrame) -> DataFrame:
    return document.select(F.to_json(F.struct(*document.columns)).alias("metrics"))


def write_document(document: DataFrame, path: str) -> None:
    """The document as one JSON object in a text file."""
    as_json(document).write.mode("overwrite").text(path)


def card_texts(figures: DataFrame) -> DataFrame:
    """The headline figures as display text."""
    texts: dict[str, Column] = {
        "revenue": numbers.money_text(F.col("total_revenue_delivered")),
        "orders": numbers.count_text(F.col("total_orders_delivered")),
        "on_time": numbers.percent_text(F.col("ontime_rate")),
        "review": numbers.rating_text(F.col("avg_review")),
        "days": numbers.days_text(F.col("avg_delivery_days")),
    }
    return figures.select(*[c.alias(n) for n, c in texts.items()])
