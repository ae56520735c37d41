"""The star on its way out: facts straight from their joins, with the keys they have when stored."""

import os
import re
from collections import Counter

import pytest
from fixture_shop import staging
from pyspark.sql import functions as F

from martlet import registry
from martlet.operators import facts, keys
from martlet.operators.lookups import lookup
from martlet.operators.warehouse import DIMENSIONS, build_warehouse, declare_warehouse, wide_view
from martlet.plans import olap
from martlet.schemas import STAGING, STAR
from martlet.settings import UNKNOWN_ID, Settings
from martlet.sources import files
from martlet.sources.store import Store

ORDERS = {"FactSales": facts.SALES_ORDER, "FactPayment": facts.PAYMENT_ORDER}


def listed(folder):
    return set(os.listdir(folder.removeprefix("file:")))


def odd_shop(spark):
    """The small shop with orders, lines and payments that come twice, rows of no order, and ids of the unknown members."""
    tables = staging(spark)
    for name in ("orders", "order_items", "payments"):
        own = tables[name]
        lost = own.limit(2).withColumn("order_id", F.lit(None).cast("string"))
        tables[name] = own.unionByName(own.filter("order_id in ('o01', 'o02', 'o08')")).unionByName(lost)
    product = [(UNKNOWN_ID, "moveis", 1, 1, 1, 1.0, 1.0, 1.0, 1.0)]
    tables["products"] = tables["products"].unionByName(spark.createDataFrame(product, STAGING["products"]))
    tables["sellers"] = tables["sellers"].unionByName(
        spark.createDataFrame([(UNKNOWN_ID, 1001, "x", "sp")], STAGING["sellers"]))
    items = tables["order_items"]
    named = items.filter("order_id = 'o03'").withColumns({"product_id": F.lit(UNKNOWN_ID), "seller_id": F.lit(UNKNOWN_ID)})
    tables["order_items"] = items.unionByName(named)
    return tables


def sort_key(row, names):
    return tuple((row[n] is not None, row[n]) if row[n] is not None else (False,) for n in names)


@pytest.mark.parametrize("dialect", ["py", "tsql"])
@pytest.mark.parametrize("shop", [staging, odd_shop])
def test_exported_facts_are_the_stored_ones(spark, shop, dialect):
    tables, settings = shop(spark), Settings(dialect=dialect)
    held = build_warehouse(spark, tables, settings).tables()
    out = declare_warehouse(spark, tables, settings).export()
    assert list(out) == list(held)
    for table, order in ORDERS.items():
        key, *names = STAR[table].names
        assert out[table].dtypes == held[table].dtypes
        want, got = held[table].collect(), out[table].collect()
        assert Counter(tuple(r[n] for n in names) for r in got) == Counter(tuple(r[n] for n in names) for r in want)
        assert sorted(r[key] for r in got) == list(range(1, len(want) + 1))
        placed = [sort_key(r, order) for r in sorted(got, key=lambda r: r[key])]
        assert placed == sorted(placed)
    for table in DIMENSIONS:
        assert sorted(map(str, out[table].collect())) == sorted(map(str, held[table].collect()))


def test_export_stores_and_sorts_no_fact(spark):
    store = Store(spark, "export")
    shop = declare_warehouse(spark, staging(spark), store=store)
    out = shop.export()
    out.prepare()
    assert listed(store.root) == {*DIMENSIONS, "OrderHeader", "FactSales_first", "FactPayment_first"}
    for table in ORDERS:
        plan = out[table]._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan and "CustomerCity" not in plan
    stored = shop.fact_sales  # one that is there is read
    assert shop.export()["FactSales"] is stored


def test_gold_facts_go_out_compressed(spark, tmp_path):
    star = declare_warehouse(spark, staging(spark)).export()
    files.write_gold(star, str(tmp_path), {"FactSales": "gzip", "FactPayment": "gzip"})
    kinds = {t: {re.search(r"\.csv(\.gz)?$", f).group() for f in os.listdir(tmp_path / t) if f.startswith("part-")} for t in STAR}
    assert kinds == {t: {".csv.gz" if t in ORDERS else ".csv"} for t in STAR}
    back = files.read_gold(spark, str(tmp_path))
    for table in ORDERS:
        assert back[table].schema == STAR[table]
        assert sorted(map(str, back[table].collect())) == sorted(map(str, star[table].collect()))


def test_gold_import_builds_no_wide_table(spark, monkeypatch):
    stores, shop = [], declare_warehouse(spark, staging(spark), store=Store(spark, "gold-import"))

    def noted(session, name):
        stores.append(Store(session, name))
        return stores[-1]

    monkeypatch.setattr(registry, "warehouse", lambda spark, folder: shop)
    monkeypatch.setattr(registry, "Store", noted)
    got = registry.QUERIES["s17_gold_import"](spark, "").collect()
    (gold,) = stores
    assert listed(gold.root) == set(STAR)
    assert any(f.endswith(".csv.gz") for f in listed(gold.path("FactSales")))
    assert not any(shop.facts.has_built(t) for t in ("Sales", "Payments", "FactSales", "FactPayment"))
    want = registry.plain(olap.rollup_year_quarter(wide_view(build_warehouse(spark, staging(spark)).tables()))).collect()
    assert got == want and len(got) > 1


def test_view_meets_a_named_dimension_first(spark, small, monkeypatch):
    star, met = dict(small.tables()), []

    def noted(df, on, dim, dim_key, take, fallback=None):
        met.append(dim_key)
        return lookup(df, on, dim, dim_key, take, fallback)

    monkeypatch.setattr(facts, "lookup", noted)
    view = wide_view(star, first=("DimOrderStatus",))
    assert met[0] == "OrderStatusKey" and set(met[1:4]) == {"CustomerKey", "ProductKey", "SellerKey"}
    plain_view = wide_view(star)
    assert view.columns == plain_view.columns
    hashed = F.sum(F.xxhash64(*view.columns).cast("decimal(38,0)"))
    assert view.agg(F.count("*"), hashed).collect() == plain_view.agg(F.count("*"), hashed).collect()


@pytest.mark.parametrize("step", [3, 4096])
def test_first_numbers(spark, monkeypatch, step):
    monkeypatch.setattr(keys, "_STEP", step)
    df = spark.range(0, 3000, 1, 16).select(
        F.md5(F.col("id").cast("string")).alias("k"), "id", F.when(F.col("id") == 7, 9000).otherwise(F.col("id") % 5 + 1).alias("n"))
    rows = keys.first_numbers(df, "k", "n", Store(spark), "t", 10).collect()
    number = 10
    for r in sorted(rows, key=lambda r: r["k"]):
        assert r[keys.FIRST_NUMBER] == number
        number += r["n"]
    assert len(rows) == 3000
    assert keys.first_numbers(df.limit(0), "k", "n", Store(spark), "t").count() == 0
