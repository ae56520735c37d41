"""Ratios and display formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_divide(top: Column, bottom: Column) -> Column:
    """Quotient as double; NULL when the divisor is zero or missing."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def share_pct(condition: Column) -> Column:
    """Percentage of the grouped rows for which ``condition`` holds."""
    return F.avg(F.when(condition, 100.0).otherwise(0.0))


def money_text(amount: Column, symbol: str = "R$") -> Column:
    return F.concat(F.lit(f"{symbol} "), F.format_number(amount.cast("double"), 0))


def count_text(number: Column) -> Column:
    return F.format_number(number.cast("bigint"), 0)


def percent_text(value: Column) -> Column:
    return F.concat(F.format_number(value.cast("double"), 1), F.lit("%"))


def rating_text(value: Column, best: int = 5) -> Column:
    return F.concat(F.format_number(value.cast("double"), 2), F.lit(f" / {best}"))


def days_text(value: Column) -> Column:
    return F.format_number(value.cast("double"), 1)
