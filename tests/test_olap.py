"""Relations between results that must hold on any data."""

import json

import pytest
from pyspark.sql import functions as F

from martlet.plans import dashboard, olap, reports


def total(df, column):
    return df.agg(F.sum(column)).first()[0]


def test_totals_agree_across_questions(small):
    sales = small.sales
    headline = olap.headline(sales).first()
    rollup, months = olap.rollup_year_quarter(sales), olap.monthly(sales)
    regions = olap.region_totals(sales)
    pivot = olap.pivot_region_year(sales, range(1995, 2002))
    for df in (rollup, months, regions):
        assert total(df, "Revenue") == pytest.approx(headline["total_revenue_delivered"], rel=1e-12)
        assert total(df, "Orders") == headline["total_orders_delivered"]
    cells = pivot.select(F.expr(" + ".join(f"`{y}`" for y in range(1995, 2002))).alias("x"))
    assert total(cells, "x") == pytest.approx(headline["total_revenue_delivered"], rel=1e-12)
    assert total(rollup, "Items") == olap.delivered(sales).count()


def test_drilldown_is_one_pivot_column(small):
    drill = olap.drilldown_months(small.sales, 1997)
    pivot = olap.pivot_region_year(small.sales, [1997])
    assert total(drill, "Revenue") == pytest.approx(total(pivot, "1997"), rel=1e-12)
    assert [r["MonthNumber"] for r in drill.collect()] == sorted(r["MonthNumber"] for r in drill.collect())


def test_holiday_split_covers_all_statuses(small):
    split = olap.holiday_split(small.sales)
    assert total(split, "Revenue") > olap.headline(small.sales).first()["total_revenue_delivered"]
    assert total(split, "Orders") == small.sales.agg(F.count_distinct("OrderID")).first()[0]


def test_found_years_pivot_equals_given_years(small):
    found = olap.pivot_region_year(small.sales)
    assert olap.calendar_years(small.dims["DimDate"]) == list(range(1995, 2002))
    assert sorted(map(str, found.collect())) == sorted(map(str, olap.pivot_region_year(small.sales, range(1995, 2002)).collect()))


def test_pivot_finds_years_in_the_rows(small):
    moved = small.sales.withColumn("YearNumber", F.when(F.col("YearNumber") == 1997, 2031).otherwise(F.col("YearNumber")))
    columns = olap.pivot_region_year(moved).columns
    assert "2031" in columns and "1997" not in columns and "1900" not in columns


def test_pivot_fills_empty_cells_in_py_only(small):
    assert olap.pivot_region_year(small.sales, [1890]).first()["1890"] == 0.0
    assert olap.pivot_region_year(small.sales, [1890], "tsql").first()["1890"] is None


def test_kpi_threshold_and_order(small):
    rows = olap.kpi_by_category(small.sales, 100).collect()
    assert all(r["Items"] >= 100 for r in rows)
    assert [r["OnTimePct"] for r in rows] == sorted(r["OnTimePct"] for r in rows)
    assert olap.slowest_categories(small.sales, 2, 100).collect() == rows[:2]


def test_empty_selection(small):
    none = small.sales.filter("OrderID = 'no such order'")
    assert olap.headline(none).first()["total_revenue_delivered"] is None
    assert olap.rollup_year_quarter(none).count() == 0


def test_metrics_document(spark, small, tmp_path):
    dashboard.write_document(dashboard.metrics_document(small, min_items=100), str(tmp_path / "m"))
    document = json.loads(spark.read.text(str(tmp_path / "m")).first()["value"])
    assert set(document) == {"kpis", "monthly", "top_categories", "payment_mix", "region", "rollup", "holiday", "kpi_slowest_categories"}
    assert document["kpis"]["fact_sales_rows"] == small.sales.count()
    months = [m["YearMonth"] for m in document["monthly"]]
    assert months == sorted(months)
    top = [c["Revenue"] for c in document["top_categories"]]
    assert top == sorted(top, reverse=True)


def test_report_extras(small):
    bands = reports.delivery_histogram(small.sales, 7).collect()
    assert all(r["DaysFrom"] % 7 == 0 for r in bands)
    assert sum(r["Items"] for r in bands) == small.sales.filter("DeliveryDays is not null").count()
    lines = reports.category_lines(small.sales, "promotion")
    assert lines.count() == small.sales.filter("CategoryNameEnglish = 'promotion'").count()
