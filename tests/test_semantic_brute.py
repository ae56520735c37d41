"""evaluate() against a plain loop over the rows, on random groupings and filters."""

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from martlet.plans import semantic

COLUMNS = {
    "YearNumber": [1996, 1997, 1998],
    "CustomerRegion": ["ASIA", "EUROPE", "Unknown"],
    "OrderStatus": ["delivered", "shipped"],
    "IsDeliveredFlag": ["Y", "N"],
    "IsHoliday": [0, 1],
    "CategoryNameEnglish": ["promotion", "Other"],
    "OnTimeFlag": ["Y", "N"],
}
FIXED = {  # measure: column it fixes and the rule on that column
    "Delivered Revenue": ("IsDeliveredFlag", lambda v: v == "Y"),
    "Delivered Orders": ("IsDeliveredFlag", lambda v: v == "Y"),
    "Holiday Revenue": ("IsHoliday", lambda v: v == 1),
    "On Time Items": ("OnTimeFlag", lambda v: v == "Y"),
    "Bad Review Items": ("ReviewScore", lambda v: (v or 0) < 3),
}
NAMES = ["Revenue", "Order Count", "AOV", "Avg Review", "On Time Rate", *FIXED]


def naive(rows, name, context):
    """A measure under a filter context: column -> test."""
    context = dict(context)
    if name in FIXED:
        column, rule = FIXED[name]
        context[column] = rule
    hit = [r for r in rows if all(test(r[c]) for c, test in context.items())]
    if name == "On Time Rate":
        top, bottom = naive(rows, "On Time Items", context), len(hit)
        return None if not bottom or top is None else top / bottom
    if name == "Avg Review":
        scores = [r["ReviewScore"] for r in hit if r["ReviewScore"] is not None]
        return sum(scores) / len(scores) if scores else None
    if not hit:
        return None
    if name in ("Revenue", "Delivered Revenue", "Holiday Revenue"):
        return float(sum(r["LineTotal"] for r in hit))
    orders = len({r["OrderID"] for r in hit})
    if name in ("Order Count", "Delivered Orders"):
        return orders
    if name == "AOV":
        return float(sum(r["LineTotal"] for r in hit)) / orders
    return len(hit)


@pytest.fixture(scope="module")
def lines(small):
    return small.sales.select(*COLUMNS, "ReviewScore", "LineTotal", "OrderID").collect()


def among(values):
    return lambda v: v in values


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.data())
def test_evaluate_equals_a_loop(small, lines, data):
    by = data.draw(st.lists(st.sampled_from(list(COLUMNS)), max_size=2, unique=True))
    filtered = data.draw(st.lists(st.sampled_from(list(COLUMNS)), max_size=3, unique=True))
    filters = {c: data.draw(st.lists(st.sampled_from(COLUMNS[c]), min_size=1, max_size=2, unique=True)) for c in filtered}
    names = data.draw(st.lists(st.sampled_from(NAMES), min_size=1, max_size=4, unique=True))

    got = semantic.evaluate(semantic.warehouse_model(small), names, by, filters).collect()
    got = {tuple(r[: len(by)]): tuple(r[len(by):]) for r in got}
    outer = {c: among(v) for c, v in filters.items()}
    groups = {tuple(r[c] for c in by) for r in lines} if by else {()}
    for group in groups:
        context = dict(outer)
        for column, value in zip(by, group):
            # a group outside the filter on its own column is not part of the result
            if column in filters and value not in filters[column]:
                break
            context[column] = among([value])
        else:
            expected = tuple(naive(lines, n, context) for n in names)
            rows = [r for r in lines if all(t(r[c]) for c, t in context.items())]
            if all(v is None for v in expected):
                assert group not in got or not by
            elif group in got:
                for a, b in zip(got[group], expected):
                    assert (a is None) == (b is None), (by, filters, names, group, got[group], expected)
                    assert a is None or math.isclose(a, b, rel_tol=1e-9)
            else:
                assert by and not rows, (by, filters, names, group, expected)
    assert set(got) <= groups
