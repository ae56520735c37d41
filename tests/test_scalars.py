from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from martlet.functions import calendar as cal
from martlet.functions import labels, numbers
from martlet.operators.dimensions import days_between


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def ntz(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.mark.parametrize(
    "later, earlier, elapsed, boundary",
    [
        ("2017-03-10 10:00:00", "2017-03-10 00:00:00", 0, 0),
        ("2017-03-09 23:00:00", "2017-03-10 00:00:00", -1, -1),  # one hour early rounds down
        ("2017-03-10 00:00:00", "2017-03-10 00:00:00", 0, 0),
        ("2017-03-11 00:00:00", "2017-03-10 00:00:00", 1, 1),
        ("2017-03-02 01:00:00", "2017-03-01 23:00:00", 0, 1),
        ("2017-03-08 23:59:59", "2017-03-10 00:00:00", -2, -2),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_day_gaps_do_not_depend_on_the_zone(spark, later, earlier, elapsed, boundary, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert one(spark, cal.elapsed_days(ntz(later), ntz(earlier))) == elapsed
        assert one(spark, cal.boundary_days(ntz(later), ntz(earlier))) == boundary
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_date_keys(spark):
    day = F.lit("2016-02-29").cast("date")
    assert one(spark, cal.date_key(day)) == 20160229
    assert one(spark, cal.date_key(F.lit(None).cast("date"))) == 19000101
    assert one(spark, cal.calendar_key(day, "2016-01-01", "2018-12-31")) == 20160229
    assert one(spark, cal.calendar_key(day, "2017-01-01", "2018-12-31")) is None


def test_calendar_fields(spark):
    row = spark.range(1).select(
        *[c.alias(n) for n, c in cal.calendar_columns(F.lit("2016-01-01").cast("date")).items()]
    ).first()
    assert row["WeekOfYear"] == 53 and row["DayName"] == "Friday" and row["MonthName"] == "January"
    assert (row["WeekendFlag"], row["WeekdayFlag"], row["QuarterName"]) == ("N", "Y", "Q1")
    assert row["YearMonth"] == "2016-01"
    auto = spark.range(1).select(
        *[c.alias(n) for n, c in cal.auto_calendar_columns(F.lit("2016-11-05").cast("date")).items()]
    ).first()
    assert tuple(auto) == (date(2016, 11, 5), 2016, 11, "November", 4, "Qtr 4", 5)


def test_calendar_has_every_day(spark):
    assert days_between(spark, "2016-01-01", "2018-12-31").count() == 1096


def test_parse_timestamp(spark):
    assert one(spark, cal.parse_timestamp(F.lit("2017-01-02 03:04:05"))) == datetime(2017, 1, 2, 3, 4, 5)
    assert one(spark, cal.parse_timestamp(F.lit("not a date"))) is None
    assert one(spark, cal.parse_timestamp(F.lit("02/01/2017"), "dd/MM/yyyy")) == datetime(2017, 1, 2)


def test_text_cleaning(spark):
    text = F.lit("\t Sao Paulo  ")
    assert one(spark, labels.tidy_lower(text)) == "sao paulo"
    assert one(spark, labels.tidy_upper(F.lit(" sp "), "tsql")) == "SP"
    assert one(spark, labels.strip(F.lit("\tx "), "tsql")) == "\tx"
    assert one(spark, labels.blank_to(F.lit("  "), "none")) == "none"


@pytest.mark.parametrize(
    "grams, expected",
    [(None, "Unknown"), (float("nan"), "Unknown"), (499.0, "Light"), (500.0, "Medium"),
     (1999.0, "Medium"), (2000.0, "Heavy")],
)
def test_weight_class(spark, grams, expected):
    assert one(spark, labels.weight_class(F.lit(grams).cast("double"))) == expected


@pytest.mark.parametrize(
    "kind, group",
    [("credit_card", "Card"), ("debit_card", "Card"), ("boleto", "Bank slip"),
     ("voucher", "Voucher"), ("not_defined", "Other"), (" boleto", "Other")],
)
def test_payment_group(spark, kind, group):
    assert one(spark, labels.payment_group(F.lit(kind))) == group


def test_flags(spark):
    assert one(spark, labels.cancelled_flag(F.lit("cancelled"))) == "Y"
    assert one(spark, labels.cancelled_flag(F.lit("canceled"))) == "Y"
    assert one(spark, labels.delivered_flag(F.lit("shipped"))) == "N"
    arrived, due = ntz("2017-03-10 10:00:00"), ntz("2017-03-10 00:00:00")
    late = cal.elapsed_days(arrived, due)
    assert one(spark, labels.on_time_flag(arrived, due, late, "py")) == "Y"
    assert one(spark, labels.on_time_flag(arrived, due, late, "tsql")) == "N"
    missing = F.lit(None).cast("timestamp_ntz")
    assert one(spark, labels.on_time_flag(missing, due, cal.elapsed_days(missing, due))) is None


def test_english_category(spark):
    none = F.lit(None).cast("string")
    assert one(spark, labels.english_category(F.lit("a"), F.lit("b"))) == "b"
    assert one(spark, labels.english_category(F.lit("pc_gamer"), none)) == "pc_gamer"
    assert one(spark, labels.english_category(F.lit("x"), none)) == "Other"
    assert one(spark, labels.english_category(none, none)) == "Other"


def test_numbers(spark):
    assert one(spark, numbers.safe_divide(F.lit(1), F.lit(0))) is None
    assert one(spark, numbers.safe_divide(F.lit(1), F.lit(4))) == 0.25
    assert one(spark, numbers.money_text(F.lit(15419773.75))) == "R$ 15,419,774"
    assert one(spark, numbers.count_text(F.lit(96478))) == "96,478"
    assert one(spark, numbers.percent_text(F.lit(93.4076))) == "93.4%"
    assert one(spark, numbers.rating_text(F.lit(4.0820))) == "4.08 / 5"
    assert one(spark, numbers.days_text(F.lit(12.0073))) == "12.0"
