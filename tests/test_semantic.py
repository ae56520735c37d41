from datetime import date, datetime
from decimal import Decimal

import pytest

from martlet.operators.dimensions import dim_date
from martlet.plans import semantic
from martlet.plans.reports import VISUALS
from martlet.plans.semantic import Model, evaluate
from martlet.settings import Settings


@pytest.fixture(scope="module")
def model(small):
    return semantic.warehouse_model(small)


def rows(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_all_measures_in_one_call(model):
    names = list(semantic.MEASURES)
    together = evaluate(model, names, ["CustomerRegion"])
    assert together.columns == ["CustomerRegion", *names]
    for name in ("Order Count", "Delivered Orders", "AOV", "Payment Value", "Bad Review Rate"):
        alone = rows(evaluate(model, [name], ["CustomerRegion"]))
        mixed = rows(together.select("CustomerRegion", name))
        for region in alone:
            assert alone[region][0] == pytest.approx(mixed[region][0])


def test_several_order_counts_need_no_expand(model):
    plan = evaluate(model, ["Order Count", "Delivered Orders"], ["YearNumber"])
    assert "Expand" not in plan._jdf.queryExecution().executedPlan().toString()


def test_filter_on_the_fixed_column_is_replaced(model):
    plain = evaluate(model, ["Delivered Revenue"]).first()[0]
    filtered = evaluate(model, ["Delivered Revenue", "Revenue"], filters={"IsDeliveredFlag": "N"}).first()
    assert filtered[0] == plain and filtered[1] != plain
    other = evaluate(model, ["Delivered Revenue"], filters={"OrderStatus": "shipped"}).first()[0]
    assert other is None  # a filter on another column still counts


def test_grouping_by_the_fixed_column(model):
    got = rows(evaluate(model, ["Holiday Revenue", "Revenue"], ["IsHoliday"]))
    assert got[0][0] == got[1][0] == got[1][1]
    delivered = rows(evaluate(model, ["Delivered Orders"], ["IsDeliveredFlag"]))
    assert delivered["Y"] == delivered["N"]


def test_status_slicer_does_not_reach_payments(model):
    plain = evaluate(model, ["Payment Value"]).first()[0]
    assert evaluate(model, ["Payment Value"], filters={"OrderStatus": "delivered"}).first()[0] == plain
    assert evaluate(model, ["Payment Value"], filters={"YearNumber": 1997}).first()[0] < plain


def test_inactive_payment_relation(model):
    plain = evaluate(model, ["Revenue"]).first()[0]
    assert evaluate(model, ["Revenue"], filters={"PaymentType": "boleto"}).first()[0] == plain
    with pytest.raises(ValueError):
        evaluate(model, ["Revenue"], ["PaymentType"])


def test_column_that_is_not_folded_into_the_fact(model, small):
    by_name = rows(evaluate(model, ["Items Sold"], ["DayName"]))
    days = small.dims["DimDate"]
    direct = small.sales.join(days, small.sales.PurchaseDateKey == days.DateKey).groupBy("DayName").count()
    assert {k: v[0] for k, v in by_name.items()} == {r["DayName"]: r["count"] for r in direct.collect()}


def test_unreviewed_lines_count_as_bad(model, small):
    expected = small.sales.filter("ReviewScore is null or ReviewScore < 3").count()
    assert evaluate(model, ["Bad Review Items"]).first()[0] == expected


def test_blank_group_stays(model, small):
    got = rows(evaluate(model, ["Items Sold"], ["Region"]))
    assert got[None][0] == small.sales.filter("CustomerGeoKey is null").count()
    assert sum(v[0] for v in got.values()) == small.sales.count()


def test_groups_without_any_value_are_left_out(model):
    got = evaluate(model, ["Revenue"], ["CustomerRegion"], {"YearNumber": 1890})
    assert got.count() == 0


@pytest.fixture(scope="module")
def leap(spark):
    """Sales around two leap days; the calendar runs from 2016 to 2018."""
    holidays = spark.createDataFrame([(date(2016, 1, 1), "x")], "holiday_date date, english_name string")
    days = dim_date(spark, holidays, Settings())
    money = [(20160228, 10), (20160229, 5), (20170228, 30), (20170301, 8), (20160301, 4), (20180301, 16), (20150101, 99)]
    fact = spark.createDataFrame(
        [(f"o{i}", k, Decimal(v), 1) for i, (k, v) in enumerate(money)],
        "OrderID string, PurchaseDateKey int, LineTotal decimal(12,2), Quantity int",
    )
    return Model({semantic.SALES: fact, semantic.PAYMENTS: fact}, {"DimDate": days})


def test_yoy_by_day(leap):
    got = rows(evaluate(leap, ["YoY Revenue"], ["FullDate"]))
    assert got == {date(2017, 2, 28): (2.0,), date(2017, 3, 1): (1.0,), date(2018, 3, 1): (1.0,),
                   date(2018, 2, 28): (-1.0,)}


def test_yoy_by_year_and_month(leap):
    got = rows(evaluate(leap, ["YoY Revenue"], ["YearNumber"]))
    assert got == {2017: (1.0,), 2018: (pytest.approx((16 - 38) / 38),)}
    got = rows(evaluate(leap, ["YoY Revenue"], ["YearMonth"]))
    assert got == {"2017-02": (1.0,), "2017-03": (1.0,), "2018-03": (1.0,), "2018-02": (-1.0,)}


def test_yoy_total_counts_only_dates_with_an_image(leap):
    # Everything in the fact against 2016 and 2017 moved one year on.
    value = evaluate(leap, ["YoY Revenue"]).first()[0]
    assert value == pytest.approx((172 - 57) / 57)
    year = evaluate(leap, ["YoY Revenue"], filters={"YearNumber": 2017}).first()[0]
    assert year == pytest.approx(1.0)


def test_drill_down_adds_up(model):
    year = evaluate(model, ["Revenue"], filters={"YearNumber": 1997}).first()[0]
    quarters = rows(semantic.drill_down(model, ["Revenue"], [1997]))
    assert sum(v[0] for v in quarters.values()) == pytest.approx(year)
    months = rows(semantic.drill_down(model, ["Revenue"], [1997, "Q2"]))
    assert sum(v[0] for v in months.values()) == pytest.approx(quarters["Q2"][0])
    days = rows(semantic.drill_down(model, ["Revenue"], [1997, "Q2", "May"]))
    assert sum(v[0] for v in days.values()) == pytest.approx(months["May"][0])
    assert all(d.month == 5 for d in days)


def test_sort_partners(model, small):
    months = semantic.sorted_by_partner(evaluate(model, ["Revenue"], ["MonthName"]), "MonthName", small.dims["DimDate"])
    names = [r["MonthName"] for r in months.collect()]
    assert names == [datetime(2000, m, 1).strftime("%B") for m in range(1, 13)]
    week = semantic.sorted_by_partner(
        evaluate(model, ["Revenue"], ["DayName"]), "DayName", small.dims["DimDate"].filter("YearNumber > 1900"))
    assert [r["DayName"] for r in week.collect()] == [
        "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def test_metadata(small):
    noted = semantic.with_model_metadata(small.dims["DimGeolocation"])
    assert noted.schema["Latitude"].metadata == {"data_category": "Latitude"}
    assert noted.schema["GeoKey"].metadata == {"hidden": True}
    assert "GeoKey" not in semantic.visible_columns(noted)


def test_every_visual_obeys_the_slicers(model):
    filters = {"YearNumber": [1997, 1998], "CustomerRegion": "ASIA", "OrderStatus": "delivered"}
    for visual in VISUALS.values():
        frame = visual.frame(model, filters)
        assert frame.columns == [*visual.by, *visual.measures]
        assert frame.count() >= 1
    ordered = VISUALS["category_revenue"].frame(model).collect()
    values = [r["Revenue"] for r in ordered]
    assert values == sorted(values, reverse=True)


def test_unknown_columns_are_refused(small):
    model = semantic.warehouse_model(small)
    for wrong in ({"filters": {"CustomerRegoin": "ASIA"}}, {"by": ["Nowhere"]}):
        for measure in ("Revenue", "YoY Revenue", "Payment Value"):
            with pytest.raises(ValueError):
                evaluate(model, [measure], **wrong)


def test_blank_filters(small):
    model = semantic.warehouse_model(small)
    blank = small.sales.filter("OnTimeFlag IS NULL").count()
    some = small.sales.filter("OnTimeFlag IS NULL OR OnTimeFlag = 'Y'").count()
    assert blank > 0
    assert evaluate(model, ["Items Sold"], filters={"OnTimeFlag": None}).first()[0] == blank
    assert evaluate(model, ["Items Sold"], filters={"OnTimeFlag": ["Y", None]}).first()[0] == some


def test_yoy_of_a_group_that_fell_to_nothing(small):
    sales = small.sales.filter("NOT (CustomerRegion = 'ASIA' AND YearNumber = 1998)")
    model = Model({semantic.SALES: sales, semantic.PAYMENTS: small.payments}, dict(small.dims))
    found = {tuple(r)[:2]: r[2] for r in evaluate(model, ["YoY Revenue"], ["YearNumber", "CustomerRegion"]).collect()}
    assert found[(1998, "ASIA")] == -1
    assert (1999, "ASIA") not in found and max(y for y, _ in found) <= 2001
