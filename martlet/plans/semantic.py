"""Named measures evaluated by any grouping under any filters.

A measure is a combination of additive parts and order counts.  Evaluating a set
of measures is one scan of the fact: every part becomes a conditional aggregate.
Filters reach a fact only along active relations, and a measure that fixes the
value of a column ignores whatever filter or grouping is on that same column.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.functions.numbers import safe_divide
from martlet.operators.keys import ROW_PLACE
from martlet.operators.lookups import side_by_side
from martlet.settings import UNKNOWN_DATE_KEY
from martlet.sources.store import Tables

SALES, PAYMENTS = "FactSales", "FactPayment"


@dataclass(frozen=True)
class Part:
    """One aggregate of a measure: a sum of ``value`` or a count of distinct orders.

    ``fixed`` names the column whose outer filter the part replaces by ``rule``.
    """

    value: Callable[[], Column] | None = None
    fixed: str | None = None
    rule: Callable[[], Column] | None = None

    @property
    def counts_orders(self) -> bool:
        return self.value is None


@dataclass(frozen=True)
class Measure:
    name: str
    fact: str
    parts: Mapping[str, Part]
    combine: Callable[[Mapping[str, Column]], Column]
    format: str = "#,##0"


def _number(column: str) -> Callable[[], Column]:
    return lambda: F.col(column)


def _present(column: str) -> Callable[[], Column]:
    return lambda: F.when(F.col(column).isNotNull(), 1)


def _total(name, fact, column, fmt="#,##0", fixed=None, rule=None, money=False) -> Measure:
    part = Part(_number(column), fixed, rule)

    def value(p):
        return p["x"].cast("double") if money else p["x"]

    return Measure(name, fact, {"x": part}, value, fmt)


def _mean(name, fact, column, fmt) -> Measure:
    parts = {"s": Part(_number(column)), "n": Part(_present(column))}
    return Measure(name, fact, parts, lambda p: safe_divide(p["s"], p["n"]), fmt)


def _ratio(name, top: Part, bottom: Part, fmt) -> Measure:
    parts = {"top": top, "bottom": bottom}
    return Measure(name, SALES, parts, lambda p: safe_divide(p["top"], p["bottom"]), fmt)


def _equals(column: str, value) -> Callable[[], Column]:
    return lambda: F.col(column) == value


# A missing review compares as zero, so lines without a review count as bad.
_BAD = Part(_number("Quantity"), "ReviewScore", lambda: F.coalesce("ReviewScore", F.lit(0.0)) < 3)
_ON_TIME = Part(_number("Quantity"), "OnTimeFlag", _equals("OnTimeFlag", "Y"))
_DELIVERED_ORDERS = Part(None, "IsDeliveredFlag", _equals("IsDeliveredFlag", "Y"))
_ITEMS, _REVENUE, _ORDERS = Part(_number("Quantity")), Part(_number("LineTotal")), Part()

# Measure names, what they measure and their display formats.
MEASURES: dict[str, Measure] = {
    m.name: m
    for m in (
        _total("Revenue", SALES, "LineTotal", "$#,##0", money=True),
        _total("Items Sold", SALES, "Quantity"),
        Measure("Order Count", SALES, {"x": _ORDERS}, lambda p: p["x"]),
        _ratio("AOV", _REVENUE, _ORDERS, "$#,##0"),
        _mean("Avg Review", SALES, "ReviewScore", "0.00"),
        _mean("Avg Delivery Days", SALES, "DeliveryDays", "0.0"),
        Measure("On Time Items", SALES, {"x": _ON_TIME}, lambda p: p["x"]),
        _ratio("On Time Rate", _ON_TIME, _ITEMS, "0.0%"),
        _ratio("Freight Ratio", Part(_number("FreightValue")), _REVENUE, "0.0%"),
        _total("Delivered Revenue", SALES, "LineTotal", "$#,##0", "IsDeliveredFlag",
               _equals("IsDeliveredFlag", "Y"), money=True),
        Measure("Delivered Orders", SALES, {"x": _DELIVERED_ORDERS}, lambda p: p["x"]),
        _total("Holiday Revenue", SALES, "LineTotal", "$#,##0", "IsHoliday",
               _equals("IsHoliday", 1), money=True),
        Measure("Bad Review Items", SALES, {"x": _BAD}, lambda p: p["x"]),
        _ratio("Bad Review Rate", _BAD, _ITEMS, "0.0%"),
        _total("Payment Value", PAYMENTS, "PaymentValue", "$#,##0", money=True),
        Measure("Payment Count", PAYMENTS, {"x": Part(lambda: F.lit(1))}, lambda p: p["x"]),
        _mean("Avg Installments", PAYMENTS, "PaymentInstallments", "0.0"),
    )
}
YOY = "YoY Revenue"
FORMATS = {**{m.name: m.format for m in MEASURES.values()}, YOY: "0.0%"}

# Active relations: which dimension attributes reach which fact.  The sales fact
# also has a payment-type key, but that relation is inactive.
RELATIONS: dict[str, dict[str, str]] = {
    SALES: {
        "DimDate": "PurchaseDateKey", "DimCustomer": "CustomerKey", "DimProduct": "ProductKey",
        "DimSeller": "SellerKey", "DimGeolocation": "CustomerGeoKey",
        "DimOrderStatus": "OrderStatusKey",
    },
    PAYMENTS: {
        "DimDate": "PurchaseDateKey", "DimCustomer": "CustomerKey",
        "DimPaymentType": "PaymentTypeKey",
    },
}
INACTIVE = {(SALES, "DimPaymentType"): "PaymentTypeKey"}

HIERARCHY = ("YearNumber", "QuarterName", "MonthName", "FullDate")
SORT_BY = {"MonthName": "MonthNumber", "QuarterName": "QuarterNumber", "DayName": "DayOfWeek"}
HIDDEN = {
    "DateKey", "CustomerKey", "ProductKey", "SellerKey", "GeoKey", "PaymentTypeKey",
    "OrderStatusKey", "SalesKey", "PaymentKey", "PurchaseDateKey", "DeliveredDateKey",
    "EstimatedDeliveryDateKey", "CustomerGeoKey", "IsUnknown",
}
CATEGORIES = {
    "CustomerCity": "City", "City": "City", "CustomerState": "StateOrProvince",
    "State": "StateOrProvince", "Latitude": "Latitude", "Longitude": "Longitude",
    "FullDate": "Time",
}


@dataclass(frozen=True)
class Model:
    """Wide facts with the dimensions that are not folded into them."""

    facts: Mapping[str, DataFrame]
    dims: Mapping[str, DataFrame] = field(default_factory=dict)

    def home(self, column: str) -> str | None:
        """The dimension a column belongs to; None for a column of a fact."""
        for table, df in self.dims.items():
            if column in df.columns and not column.endswith("Key"):
                return table
        return None

    def known(self, column: str) -> bool:
        """Whether any table of the model holds the column."""
        # dimensions first and one by one: a fact that no question reads is not built for its column names
        return any(column in tables[name].columns for tables in (self.dims, self.facts) for name in tables)

    def reaches(self, fact: str, column: str) -> bool:
        if not self.known(column):
            raise ValueError(f"no table of the model has a column {column}")
        table = self.home(column)
        if table is None:
            return column in self.facts[fact].columns
        return table in RELATIONS[fact]

    def rows(self, fact: str, columns: Sequence[str]) -> DataFrame:
        """The fact, joined along active relations for columns it does not hold."""
        df = self.facts[fact]
        missing = [c for c in columns if c not in df.columns]
        for table in dict.fromkeys(self.home(c) for c in missing):
            dim = self.dims[table]
            wanted = [c for c in missing if c in dim.columns]
            side = dim.select(F.col(dim.columns[0]).alias("_dim_key"), *wanted)
            df = df.join(side, F.col(RELATIONS[fact][table]) == F.col("_dim_key"), "left")
            df = df.drop("_dim_key")
        return df


def _matches(column: str, values) -> Column:
    """Equality with a value or with any of several; None stands for a blank."""
    if not isinstance(values, (list, tuple, set, frozenset)):
        return F.col(column).eqNullSafe(F.lit(values))
    rule = F.col(column).isin(*[v for v in values if v is not None])
    return rule | F.col(column).isNull() if None in values else rule


def _all_of(rules: Sequence[Column]) -> Column | None:
    return reduce(lambda a, b: a & b, rules) if rules else None


def _aggregate(
    model: Model, fact: str, parts: Mapping[str, Part], by: Sequence[str], filters: Mapping
) -> DataFrame:
    """One scan: each part is a conditional aggregate under the filters it keeps."""
    filters = {c: v for c, v in filters.items() if model.reaches(fact, c)}
    replaced = {p.fixed for p in parts.values() if p.fixed}
    rows = model.rows(fact, [*by, *filters, *replaced])
    shared = _all_of([_matches(c, v) for c, v in filters.items() if c not in replaced])
    if shared is not None:
        rows = rows.filter(shared)

    def kept(part: Part) -> Column | None:
        rules = [_matches(c, v) for c, v in filters.items() if c in replaced and c != part.fixed]
        if part.rule:
            rules.append(part.rule())
        return _all_of(rules)

    def flagged(part: Part, value: Column) -> Column:
        rule = kept(part)
        return value if rule is None else F.when(rule, value)

    sums = {n: F.sum(flagged(p, p.value())) for n, p in parts.items() if not p.counts_orders}
    counts = {n: flagged(p, F.lit(1)) for n, p in parts.items() if p.counts_orders}
    if not counts:
        return rows.groupBy(*by).agg(*[c.alias(n) for n, c in sums.items()])
    # Orders first, groups second: several order counts need no row expansion.
    per_order = rows.groupBy(*by, "OrderID").agg(
        *[c.alias(n) for n, c in sums.items()], *[F.max(c).alias(n) for n, c in counts.items()]
    )
    return per_order.groupBy(*by).agg(*[F.sum(n).alias(n) for n in (*sums, *counts)])


def _join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join two grouped results, a blank key matching a blank key.

    Without keys each side is a single row.
    """
    if not keys:
        return side_by_side(left, right)
    other = right.withColumnsRenamed({k: f"_other_{k}" for k in keys})
    same = _all_of([F.col(k).eqNullSafe(F.col(f"_other_{k}")) for k in keys])
    joined = left.join(other, same, how)
    both = [F.coalesce(k, f"_other_{k}").alias(k) for k in keys]
    rest = [c for c in (*left.columns, *right.columns) if c not in keys]
    return joined.select(*both, *rest)


def _fact_result(
    model: Model, fact: str, names: Sequence[str], by: Sequence[str], filters: Mapping
) -> DataFrame:
    parts = {
        f"{i}_{key}": part
        for i, name in enumerate(names)
        for key, part in MEASURES[name].parts.items()
    }
    # A part that fixes a grouping column is the same for every value of that column.
    widened: dict[tuple[str, ...], dict[str, Part]] = {}
    for key, part in parts.items():
        grain = tuple(c for c in by if c != part.fixed)
        widened.setdefault(grain, {})[key] = part
    own = widened.pop(tuple(by), {})
    base = own or {"_rows": Part(lambda: F.lit(1))}
    result = _aggregate(model, fact, base, by, filters)
    for grain, some in widened.items():
        wider = _aggregate(model, fact, some, grain, filters)
        if grain:
            result = _join_groups(result, wider, grain, "left")
        else:  # one row for all groups
            result = result.withColumns({c: wider.select(c).scalar() for c in wider.columns})
    values = [
        MEASURES[name].combine({k: F.col(f"{i}_{k}") for k in MEASURES[name].parts}).alias(name)
        for i, name in enumerate(names)
    ]
    return result.select(*by, *values)


def _shifted_calendar(calendar: DataFrame, by_day: bool) -> DataFrame:
    """Each date with the attributes of the day its revenue is compared with.

    By day, a date looks back to the same date one year earlier (29 February to the
    28th).  In coarser groups every date counts once, in the period a year later.
    """
    days = calendar.filter(F.col("DateKey") != UNKNOWN_DATE_KEY)
    back, forward = F.add_months("FullDate", -12), F.add_months("FullDate", 12)

    def key(day):
        return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)

    if by_day:
        held = days.select(F.col("DateKey").alias("_source_key"))
        return days.withColumn("_source_key", key(back)).join(held, "_source_key", "left_semi")
    sources = days.select(F.col("DateKey").alias("_source_key"), key(forward).alias("_image_key"))
    return sources.join(days, F.col("_image_key") == F.col("DateKey"))


def yoy_revenue(
    model: Model, by: Sequence[str] = (), filters: Mapping | None = None
) -> DataFrame:
    """Change of revenue against the same dates one year earlier.

    The fact is summed per purchase day first; only those daily sums meet the
    calendar, once under their own date and once under the date they are compared with.
    A group that had revenue a year earlier and has none now fell by all of it (-1).
    """
    filters = {c: v for c, v in (filters or {}).items() if model.reaches(SALES, c)}
    calendar = model.dims["DimDate"]
    dates = set(calendar.columns)
    other_by = [c for c in by if c not in dates]
    other_filters = {c: v for c, v in filters.items() if c not in dates}
    date_filters = {c: v for c, v in filters.items() if c in dates}
    needed = [c for c in dict.fromkeys((*by, *date_filters)) if c in dates]

    rows = model.rows(SALES, [*other_by, *other_filters])
    rule = _all_of([_matches(c, v) for c, v in other_filters.items()])
    rows = rows if rule is None else rows.filter(rule)
    daily = rows.groupBy("PurchaseDateKey", *other_by).agg(F.sum("LineTotal").alias("_daily"))

    def dated(days: DataFrame, key: str, how: str, name: str) -> DataFrame:
        side = days.select(F.col(key).alias("_day_key"), *needed)
        moved = daily.join(side, F.col("PurchaseDateKey") == F.col("_day_key"), how)
        kept = _all_of([_matches(c, v) for c, v in date_filters.items()])
        moved = moved if kept is None else moved.filter(kept)
        return moved.groupBy(*by).agg(F.sum("_daily").alias(name))

    by_day = any(c in ("FullDate", "DayNumber", "DayName", "WeekOfYear") for c in by)
    now = dated(calendar, "DateKey", "left", "_now")
    before = dated(_shifted_calendar(calendar, by_day), "_source_key", "inner", "_before")
    result = _join_groups(now, before, by, "full")
    change = safe_divide(F.coalesce("_now", F.lit(0)) - F.col("_before"), F.col("_before"))
    return result.select(*by, change.alias(YOY))


def evaluate(
    model: Model,
    measures: Sequence[str],
    by: Sequence[str] = (),
    filters: Mapping | None = None,
) -> DataFrame:
    """Measures by the given columns; groups in which every measure is blank are left out.

    ``filters`` maps a column to a value or a list of values.  A filter on a column
    that no active relation connects to a fact does not touch that fact's measures;
    grouping by such a column is refused.
    """
    by, filters = list(by), dict(filters or {})
    pieces: list[DataFrame] = []
    for fact in (SALES, PAYMENTS):
        names = [m for m in measures if m in MEASURES and MEASURES[m].fact == fact]
        if not names and not (fact == SALES and YOY in measures):
            continue
        for column in by:
            if not model.reaches(fact, column):
                raise ValueError(f"{column} has no active relation to {fact}")
        if names:
            pieces.append(_fact_result(model, fact, names, by, filters))
        if fact == SALES and YOY in measures:
            pieces.append(yoy_revenue(model, by, filters))
    result = reduce(lambda a, b: _join_groups(a, b, by, "full"), pieces)
    result = result.select(*by, *measures)
    return result.dropna(how="all", subset=list(measures)) if by else result


def drill_down(
    model: Model, measures: Sequence[str], path: Sequence, filters: Mapping | None = None
) -> DataFrame:
    """One level below ``path`` in the calendar: year, quarter, month, date."""
    level = len(path)
    chosen = dict(zip(HIERARCHY, path))
    return evaluate(
        model, measures, [HIERARCHY[level]], {**(filters or {}), **chosen}
    )


def sorted_by_partner(df: DataFrame, column: str, partners: DataFrame) -> DataFrame:
    """Order a result by a column's sort-by partner (month names by number).

    Day names follow the weekday, not the day of the month.
    """
    partner = SORT_BY[column]
    order = F.weekday("FullDate") if partner == "DayOfWeek" else F.col(partner)
    ranks = partners.groupBy(column).agg(F.min(order).alias("_rank"))
    return df.join(ranks, column, "left").orderBy("_rank").drop("_rank")


def with_model_metadata(df: DataFrame) -> DataFrame:
    """Attach display metadata: hidden keys, data category, format, sort column."""
    for column in df.columns:
        notes = {
            "hidden": column in HIDDEN or None,
            "data_category": CATEGORIES.get(column),
            "format": FORMATS.get(column),
            "sort_by": SORT_BY.get(column),
        }
        notes = {k: v for k, v in notes.items() if v is not None}
        if notes:
            df = df.withMetadata(column, notes)
    return df


def model_columns(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row for each column of the tables: its display metadata and in how many rows it has a value."""
    parts = []
    for table, df in tables.items():
        named = with_model_metadata(df.select(*[c for c in df.columns if c != ROW_PLACE]))
        notes = {f.name: f.metadata for f in named.schema.fields}
        filled = named.agg(*[F.count(F.col(c)).alias(c) for c in notes]).unpivot([], list(notes), "column_name", "filled")

        def noted(key: str) -> Column:
            held = {c: n[key] for c, n in notes.items() if key in n}
            out = F.lit(None).cast("string")
            for c, note in held.items():
                out = F.when(F.col("column_name") == c, F.lit(str(note))).otherwise(out)
            return out

        parts.append(
            filled.select(
                F.lit(table).alias("table_name"),
                "column_name",
                noted("hidden").isNotNull().alias("hidden"),
                noted("data_category").alias("data_category"),
                noted("sort_by").alias("sort_by"),
                "filled",
            )
        )
    return reduce(DataFrame.unionByName, parts)


def visible_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in HIDDEN and c != ROW_PLACE]


def warehouse_model(warehouse) -> Model:
    """The semantic model over a built warehouse; wide facts need no joins."""
    facts = Tables({SALES: lambda: warehouse.sales, PAYMENTS: lambda: warehouse.payments})
    return Model(facts, warehouse.dims)
