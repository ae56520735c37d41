"""Date arithmetic as Column expressions.

Sources carry zone-free timestamps, and every function here stays zone-free, so
results do not depend on ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martlet.settings import UNKNOWN_DATE_KEY


def parse_timestamp(text: Column, fmt: str | None = None) -> Column:
    """Zone-free timestamp from text; NULL where the text is not a timestamp."""
    if fmt:
        return F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz")
    return text.try_cast("timestamp_ntz")


def plain_date_key(day: Column) -> Column:
    """yyyymmdd as an integer; NULL stays NULL."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def date_key(day: Column) -> Column:
    """yyyymmdd as an integer, a missing date gets the sentinel key."""
    return F.coalesce(plain_date_key(day), F.lit(UNKNOWN_DATE_KEY))


def calendar_key(day: Column, start: str, end: str) -> Column:
    """Key of a day the calendar holds, NULL for any other day.

    The calendar is gap-free between its two ends, so looking a day up is a
    range test; no join with the date dimension is needed.
    """
    d = F.to_date(day)
    held = d.between(F.lit(start).cast("date"), F.lit(end).cast("date")) | (
        d == F.lit("1900-01-01").cast("date")
    )
    return F.when(held, plain_date_key(d))


def elapsed_days(later: Column, earlier: Column) -> Column:
    """Whole 24-hour periods between two timestamps, rounded down."""
    gap = later - earlier
    whole = F.extract(F.lit("DAY"), gap)
    return (whole - F.when(gap < F.make_dt_interval(whole), 1).otherwise(0)).cast("int")


def boundary_days(later: Column, earlier: Column) -> Column:
    """Midnights crossed between two timestamps."""
    return F.datediff(F.to_date(later), F.to_date(earlier))


def day_gap(later: Column, earlier: Column, dialect: str) -> Column:
    return elapsed_days(later, earlier) if dialect == "py" else boundary_days(later, earlier)


def is_weekend(day: Column) -> Column:
    return F.weekday(day) >= 5


def quarter_name(day: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(day).cast("string"))


def calendar_columns(day: Column) -> dict[str, Column]:
    """The date dimension's derived fields, by name."""
    return {
        "DateKey": plain_date_key(day),
        "FullDate": day,
        "DayNumber": F.dayofmonth(day),
        "DayName": F.date_format(day, "EEEE"),
        "WeekdayFlag": F.when(is_weekend(day), "N").otherwise("Y"),
        "WeekendFlag": F.when(is_weekend(day), "Y").otherwise("N"),
        "WeekOfYear": F.weekofyear(day),
        "MonthNumber": F.month(day),
        "MonthName": F.date_format(day, "MMMM"),
        "QuarterNumber": F.quarter(day),
        "QuarterName": quarter_name(day),
        "YearNumber": F.year(day),
        "YearMonth": F.date_format(day, "yyyy-MM"),
    }


def auto_calendar_columns(day: Column) -> dict[str, Column]:
    """Fields of the model's generated date table."""
    quarter = F.floor((F.month(day) + 2) / 3).cast("int")
    return {
        "Date": day,
        "Year": F.year(day),
        "MonthNo": F.month(day),
        "Month": F.date_format(day, "MMMM"),
        "QuarterNo": quarter,
        "Quarter": F.concat(F.lit("Qtr "), quarter.cast("string")),
        "Day": F.dayofmonth(day),
    }
