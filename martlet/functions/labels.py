"""Cleaning and classification rules as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martlet.settings import MANUAL_CATEGORIES, UNDEFINED_PAYMENT


def strip(text: Column, dialect: str = "py") -> Column:
    """Trim both ends: every kind of white space (py) or blanks only (tsql)."""
    if dialect == "py":
        return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
    return F.trim(text)


def tidy_lower(text: Column, dialect: str = "py") -> Column:
    return F.lower(strip(text, dialect))


def tidy_upper(text: Column, dialect: str = "py") -> Column:
    return F.upper(strip(text, dialect))


def blank_to(text: Column, default: str) -> Column:
    """Trimmed text; blank or missing text becomes ``default``."""
    return F.coalesce(F.nullif(F.trim(text), F.lit("")), F.lit(default))


def weight_class(grams: Column, light_below: float = 500.0, heavy_from: float = 2000.0) -> Column:
    return (
        F.when(grams.isNull() | F.isnan(grams), "Unknown")
        .when(grams < light_below, "Light")
        .when(grams < heavy_from, "Medium")
        .otherwise("Heavy")
    )


def payment_type(raw: Column, dialect: str = "py") -> Column:
    """Member name of a raw payment type in the payment-type dimension."""
    if dialect == "py":
        return F.coalesce(raw, F.lit(UNDEFINED_PAYMENT))
    return blank_to(raw, UNDEFINED_PAYMENT)


def payment_group(kind: Column) -> Column:
    return (
        F.when(kind.isin("credit_card", "debit_card"), "Card")
        .when(kind == "boleto", "Bank slip")
        .when(kind == "voucher", "Voucher")
        .otherwise("Other")
    )


def delivered_flag(status: Column) -> Column:
    return F.when(status == "delivered", "Y").otherwise("N")


def cancelled_flag(status: Column) -> Column:
    return F.when(status.isin("canceled", "cancelled"), "Y").otherwise("N")


def on_time_flag(
    delivered: Column, estimated: Column, delay_days: Column, dialect: str = "py"
) -> Column:
    """Y / N, NULL until both dates are known.

    py compares whole days of delay, so a parcel up to a day late is on time;
    tsql compares the timestamps.
    """
    on_time = delay_days <= 0 if dialect == "py" else delivered <= estimated
    return F.when(on_time, "Y").when(~on_time, "N")


def english_category(
    source: Column, translated: Column, manual: dict[str, str] | None = None
) -> Column:
    """Translation, else the manual entry, else ``Other``."""
    manual = MANUAL_CATEGORIES if manual is None else manual
    options = [translated]
    if manual:
        pairs = [F.lit(part) for pair in manual.items() for part in pair]
        options.append(F.create_map(*pairs)[source])
    return F.coalesce(*options, F.lit("Other"))


def nan_to_null(number: Column) -> Column:
    return F.when(~F.isnan(number), number)
