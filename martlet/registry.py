"""Every operator as a named query over a folder of the given tables.

Each table of the star is built once per session, folder and dialect, when a query
first reads it, written to the shared folder, and read by all queries: the reports
are then pruned scans of two wide tables instead of seventy rebuilds of the same joins.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.functions import calendar as cal
from martlet.functions import labels
from martlet.operators import facts, profiling, quality
from martlet.operators.lookups import union_all, with_region
from martlet.operators.warehouse import Warehouse, declare_warehouse, wide_view
from martlet.plans import dashboard, olap, order_bitmaps, reports, semantic
from martlet.schemas import STAGING, STAGING_KEYS
from martlet.sources import audit, files, prepared
from martlet.sources.retail_tables import read_regions, read_staging, retail_settings
from martlet.sources.store import Store, state_of

Query = Callable[[SparkSession, str], DataFrame]

# Report parameters that fit these tables.
DRILL_YEAR, DICE_YEAR, REGION, PAYMENT = 1997, 1998, "ASIA", "credit_card"
SLICERS = {"YearNumber": [1997, 1998], "CustomerRegion": ["ASIA", "EUROPE"],
           "OrderStatus": "delivered"}

# Tables the star is built from; when one changes, the star is built anew.
INPUTS = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

_built: dict[tuple, Warehouse] = {}
_lock = Lock()


def warehouse(spark: SparkSession, folder: str, dialect: str = "py") -> Warehouse:
    """The star over a folder, each table built on first use in this session and anew when its files change."""
    state = tuple(state_of(spark, f"{folder}/{table}.parquet") for table in INPUTS)
    key = (spark.sparkContext.applicationId, folder, dialect, state)
    with _lock:
        if key not in _built:
            staging, regions = read_staging(spark, folder), read_regions(spark, folder)
            settings = retail_settings(spark, folder, dialect)
            store = Store(spark, f"warehouse-{dialect}")
            _built[key] = declare_warehouse(spark, staging, settings, regions, store)
    return _built[key]


_bitmaps: dict[int, tuple[Warehouse, DataFrame]] = {}


def _on_bitmaps(ask: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    """A question to the stored bitmaps of orders (built on first use) and the lines they were made from."""

    def run(spark, folder):
        held = warehouse(spark, folder)
        with _lock:
            if id(held) not in _bitmaps:
                _bitmaps[id(held)] = held, order_bitmaps.build(held.sales, Store(spark, "order-bitmaps"))
        return plain(ask(_bitmaps[id(held)][1], held.sales))

    return run


def plain(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Result columns as plain types: money as double, means rounded to ``digits``."""

    def shown(f: T.StructField) -> Column:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            column = column.cast("double")
        if digits is not None and isinstance(f.dataType, T.DoubleType):
            column = F.round(column, digits)
        return column.alias(f.name)

    return df.select(*[shown(f) for f in df.schema])


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


def snake(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.replace(" ", "_").lower() for c in df.columns])


def _on_sales(build: Callable[[DataFrame], DataFrame], dialect: str = "py") -> Query:
    return lambda spark, folder: build(warehouse(spark, folder, dialect).sales)


def _on_warehouse(build: Callable[[Warehouse], DataFrame], dialect: str = "py") -> Query:
    return lambda spark, folder: build(warehouse(spark, folder, dialect))


def _on_staging(build: Callable[[Mapping[str, DataFrame]], DataFrame]) -> Query:
    return lambda spark, folder: build(read_staging(spark, folder))


def _on_model(build: Callable[[semantic.Model], DataFrame]) -> Query:
    return lambda spark, folder: build(semantic.warehouse_model(warehouse(spark, folder)))


def _dimension(table: str, dialect: str = "py") -> Query:
    def run(spark, folder):
        return warehouse(spark, folder, dialect).dims[table]

    return run


def _measure(name: str, by=("YearNumber", "CustomerRegion")) -> Query:
    def run(model):
        result = semantic.evaluate(model, [name], by).withColumnRenamed(name, "value")
        return result.withColumn("value", F.round(F.col("value").cast("double"), 6))

    return _on_model(run)


def _visual(name: str) -> Query:
    def run(model):
        return snake(plain(reports.VISUALS[name].frame(model), 6))

    return _on_model(run)


# Round trips through the source and sink formats -------------------------------------------


def _csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    staging = read_staging(spark, folder)
    path = Store(spark, "csv").path("reviews")
    files.write_csv(staging["reviews"], path)
    return files.read_csv(spark, path, STAGING["reviews"], multi_line=True)


def _json_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    staging = read_staging(spark, folder)
    path = Store(spark, "json").path("sellers")
    files.write_json(staging["sellers"], path)
    return spark.read.schema(STAGING["sellers"]).json(path)


def _found_categories(staging: Mapping[str, DataFrame]) -> DataFrame:
    """Each category of the product table with its English name."""
    name, english = "product_category_name", "product_category_name_english"
    found = staging["products"].select(name).filter(F.col(name).isNotNull()).distinct()
    known = staging["category_translation"]
    return found.join(known, name, "left").select(name, F.coalesce(english, name).alias(english))


def _xml_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    staging = read_staging(spark, folder)
    path = Store(spark, "xml").path("categories")
    files.write_category_xml(_found_categories(staging), path)
    return files.read_category_xml(spark, path)


def _mixed_encodings(spark: SparkSession, folder: str) -> DataFrame:
    """Customers landed half as UTF-8 and half as Latin-1 (columns reversed), read as one folder."""
    customers = read_staging(spark, folder)["customers"].withColumn(
        "customer_city", F.concat(F.lit("S\u00e3o "), F.trim("customer_city")))
    half = F.pmod(F.xxhash64("customer_id"), F.lit(2))
    path = Store(spark, "csv").path("customers")
    files.write_csv(customers.filter(half == 0), path)
    other = customers.filter(half == 1).select(*reversed(customers.columns))
    other.write.mode("append").options(**files.CSV_QUOTING, encoding="ISO-8859-1").csv(path)
    return files.read_csv(spark, path, STAGING["customers"])


def _views(spark: SparkSession, folder: str) -> DataFrame:
    """Sellers registered as a view by their logical name and asked for in SQL."""
    path = Store(spark, "csv").path("sellers")
    files.write_csv(read_staging(spark, folder)["sellers"], path)
    files.read_staging(spark, {"sellers": path})
    return spark.sql("SELECT seller_state, count(*) AS sellers FROM sellers GROUP BY seller_state")


def _holiday_feed(staging: Mapping[str, DataFrame]) -> DataFrame:
    return staging["holidays"].select(
        F.col("holiday_date").cast("string").alias("date"),
        F.col("local_name").alias("localName"),
        F.col("english_name").alias("name"),
        F.col("country_code").alias("countryCode"),
        F.lit(True).alias("global"),
    )


def _feed_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """The holiday feed as JSON arrays of one file for each year and as lines, read from one folder."""
    feed = _holiday_feed(read_staging(spark, folder))
    store = Store(spark, "json")
    years = [r[0] for r in feed.select(F.substring("date", 1, 4)).distinct().collect()]
    for year in sorted(years):  # a feed has one file for each year
        files.write_json_array(feed.filter(F.col("date").startswith(year)), store.path(f"feed/{year}"), "date", "name")
    files.write_json(feed.coalesce(1), store.path("feed/lines"))
    back = files.holidays_staging(files.read_holidays(spark, store.path("feed/*")))
    return back.groupBy("holiday_date", "local_name", "english_name", "country_code").agg(F.count("*").alias("copies"))


def _catalog_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Products replaced twice as a catalog table, then a few columns of sellers inserted by name."""
    staging = read_staging(spark, folder)
    name = f"martlet_{uuid.uuid4().hex[:8]}"
    try:
        files.replace_table(staging["products"].limit(0), name)
        files.replace_table(staging["products"], name)
        files.insert_columns(staging["sellers"].select(F.col("seller_id").alias("product_id")), name)
        return Store(spark, "catalog").put(spark.table(name).select("product_id", "product_category_name"), "rows")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _prepared_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Every prepared piece read back: its rows, and the bytes of a column that tells them apart."""
    staging = read_staging(spark, folder)
    store = Store(spark, "prepared")
    placed = prepared.prepare_sources(staging, _holiday_feed(staging), store.root)
    translation = "product_category_name"
    back = {name: (files.read_csv(spark, placed[name], STAGING[name], name in files.FREE_TEXT), "order_id")
            for name in prepared.TRANSACTIONS}
    back["category_translation_csv"] = (
        files.read_csv(spark, placed["category_translation_csv"], STAGING["category_translation"]), translation)
    back["category_translation_xml"] = (
        files.read_category_xml(spark, placed["category_translation_xml"]), translation)
    back["holidays"] = (files.read_holidays(spark, placed["holidays"]), "name")
    for name in prepared.MASTER_DATA:
        key = "geolocation_city" if name == "geolocation" else f"{name[:-1]}_id"
        back[name] = (spark.read.parquet(placed[name]), key)
    counts = [
        df.agg(F.count("*").alias("rows"), F.sum(F.length(key)).alias("key_chars")).select(
            F.lit(name).alias("piece"), "rows", "key_chars")
        for name, (df, key) in back.items()
    ]
    return union_all(counts)


def _flattened_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Products with their sizes as an array, flattened to text and landed as CSV."""
    products = read_staging(spark, folder)["products"]
    sizes = F.array(*[F.col(c).cast("int") for c in
                      ("product_length_cm", "product_height_cm", "product_width_cm")])
    path = Store(spark, "csv").path("sizes")
    files.write_csv(files.flatten_arrays(products.select("product_id", sizes.alias("sizes"))), path)
    return spark.read.schema("product_id string, sizes string").options(
        **files.CSV_QUOTING).csv(path)


def _gold_import(spark: SparkSession, folder: str) -> DataFrame:
    """Q1 over a star that went out to CSV and came back typed.

    The facts go out as gzip; the dimensions stay plain, as the planner sizes them by their files.
    """
    star = warehouse(spark, folder).export()
    star.prepare()
    store = Store(spark, "gold")
    files.write_gold(star, store.root, {"FactSales": "gzip", "FactPayment": "gzip"})
    back = files.read_gold(spark, store.root)
    return plain(olap.rollup_year_quarter(wide_view(back, first=("DimOrderStatus",))))


def _load_log(spark: SparkSession, folder: str) -> DataFrame:
    staging = read_staging(spark, folder)
    log, store = audit.LoadLog(spark, "staging"), Store(spark, "load")
    for table in ("orders", "customers", "products", "sellers"):
        log.write(staging[table], table, store.path(table))
    log.append_to(store.path("etl_log"))
    return spark.read.schema(log.frame().schema).parquet(store.path("etl_log")).select(
        "PackageName", "TaskName", "Status", "RowsAffected"
    )


def _rejected_rows(staging: Mapping[str, DataFrame]) -> DataFrame:
    rules = {
        "NO_DELIVERY": (
            "delivered without a delivery date",
            (F.col("order_status") == "delivered")
            & F.col("order_delivered_customer_date").isNull(),
        ),
        "LATE": (
            "delivered after the estimate",
            F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date"),
        ),
    }
    _, rejected = quality.split_rejected(staging["orders"], "orders", "order_id", rules)
    return rejected.drop("RejectedAt")


def _appended_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """The rejected rows appended in two loads and read back."""
    rejected = _rejected_rows(read_staging(spark, folder))
    path = Store(spark, "rejected").path("rows")
    for code in ("NO_DELIVERY", "LATE"):
        audit.append_rejected(rejected.filter(F.col("ReasonCode") == code), path)
    return spark.read.schema(rejected.schema).parquet(path)


def _accepted_rows(staging: Mapping[str, DataFrame]) -> DataFrame:
    rules = {"NO_APPROVAL": ("never approved", F.col("order_approved_at").isNull())}
    good, _ = quality.split_rejected(staging["orders"], "orders", "order_id", rules)
    return good.groupBy("order_status").agg(F.count("*").alias("orders"))


# Scalar rules over whole columns ------------------------------------------------------------


def _clean_text(staging: Mapping[str, DataFrame]) -> DataFrame:
    return staging["customers"].select(
        "customer_id",
        labels.tidy_lower(F.col("customer_city")).alias("city"),
        labels.tidy_upper(F.col("customer_state")).alias("state"),
        labels.blank_to(F.col("customer_city"), "none").alias("city_or_none"),
    )


def _order_days(staging: Mapping[str, DataFrame]) -> DataFrame:
    """Both forms of every order-level date rule, side by side."""
    arrived = F.col("order_delivered_customer_date")
    bought, due = F.col("order_purchase_timestamp"), F.col("order_estimated_delivery_date")
    late_py, late_tsql = cal.elapsed_days(arrived, due), cal.boundary_days(arrived, due)
    return staging["orders"].select(
        "order_id",
        cal.date_key(arrived).alias("key_py"),
        cal.calendar_key(arrived, "1996-01-01", "1999-12-31").alias("key_tsql"),
        cal.elapsed_days(arrived, bought).alias("days_py"),
        cal.boundary_days(arrived, bought).alias("days_tsql"),
        late_py.alias("late_py"),
        late_tsql.alias("late_tsql"),
        labels.on_time_flag(arrived, due, late_py, "py").alias("flag_py"),
        labels.on_time_flag(arrived, due, late_tsql, "tsql").alias("flag_tsql"),
    )


def _parsed_timestamps(staging: Mapping[str, DataFrame]) -> DataFrame:
    """Purchase times written as text in several ways, some of them no times at all, and read back."""
    bought, kind = F.col("order_purchase_timestamp"), F.col("order_id").cast("bigint") % 5
    plain_text = F.date_format(bought, "yyyy-MM-dd HH:mm:ss")
    text = (
        F.when(kind == 0, plain_text)
        .when(kind == 1, F.date_format(bought, "yyyy-MM-dd"))
        .when(kind == 2, F.lit("n/a"))
        .when(kind == 3, F.concat(F.substring(plain_text, 1, 5), F.lit("13"), F.substring(plain_text, 8, 12)))
        .otherwise(F.lit(""))
    )
    local = F.when(kind == 2, F.lit("32/01/1997 00:00")).otherwise(F.date_format(bought, "dd/MM/yyyy HH:mm"))
    shown = {"parsed": cal.parse_timestamp(text), "parsed_by_format": cal.parse_timestamp(local, "dd/MM/yyyy HH:mm")}
    return staging["orders"].select(
        "order_id", *[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(n) for n, c in shown.items()]
    )


def _auto_calendar(staging: Mapping[str, DataFrame]) -> DataFrame:
    """The generated date table over the years that hold purchases."""
    day = F.to_date("order_purchase_timestamp")
    ends = staging["orders"].agg(F.min(F.year(day)).alias("a"), F.max(F.year(day)).alias("b"))
    days = ends.select(
        F.explode(
            F.sequence(F.make_date("a", F.lit(1), F.lit(1)), F.make_date("b", F.lit(12), F.lit(31)))
        ).alias("day")
    )
    return days.select(*[c.alias(n) for n, c in cal.auto_calendar_columns(F.col("day")).items()])


def _payment_rules(staging: Mapping[str, DataFrame]) -> DataFrame:
    kind = labels.payment_type(F.col("payment_type"))
    return (
        staging["payments"]
        .groupBy(kind.alias("PaymentType"), labels.payment_group(kind).alias("PaymentTypeGroup"))
        .agg(F.count("*").alias("payments"))
    )


def _weight_classes(staging: Mapping[str, DataFrame]) -> DataFrame:
    kind = labels.weight_class(F.col("product_weight_g"))
    return staging["products"].groupBy(kind.alias("WeightClass")).agg(F.count("*").alias("products"))


def _status_flags(staging: Mapping[str, DataFrame]) -> DataFrame:
    status = F.col("order_status")
    flags = [labels.delivered_flag(status).alias("IsDeliveredFlag"),
             labels.cancelled_flag(status).alias("IsCancelledFlag")]
    return staging["orders"].groupBy(*flags).agg(F.count("*").alias("orders"))


def _customer_regions(spark: SparkSession, folder: str) -> DataFrame:
    customers = read_staging(spark, folder)["customers"].withColumn(
        "state", labels.tidy_upper(F.col("customer_state"))
    )
    placed = with_region(customers, "state", read_regions(spark, folder), "region")
    return placed.groupBy("region").agg(F.count("*").alias("customers"))


def _metrics_rows(w: Warehouse) -> DataFrame:
    """The dashboard document, opened again into (section, place, label, amount) rows."""

    def section(name: str, label: str, value: str) -> Column:
        return F.transform(
            name,
            lambda row, place: F.struct(
                F.lit(name).alias("section"),
                (place + 1).alias("place"),
                row[label].cast("string").alias("label"),
                F.round(row[value], 6).alias("amount"),
            ),
        )

    rows = F.concat(
        section("monthly", "YearMonth", "Revenue"),
        section("top_categories", "CategoryNameEnglish", "Revenue"),
        section("payment_mix", "PaymentType", "PaymentValue"),
        section("region", "CustomerRegion", "Revenue"),
        section("rollup", "QuarterName", "Revenue"),
        section("holiday", "IsHoliday", "Revenue"),
        section("kpi_slowest_categories", "CategoryNameEnglish", "OnTimePct"),
    )
    document = dashboard.metrics_document(w)
    figures = document.schema["kpis"].dataType.names
    kpis = F.array(*[
        F.struct(
            F.lit("kpis").alias("section"),
            F.lit(k + 1).alias("place"),
            F.lit(name).alias("label"),
            F.round(F.col("kpis").getField(name).cast("double"), 6).alias("amount"),
        )
        for k, name in enumerate(figures)
    ])
    return document.select(F.inline(F.concat(kpis, rows)))


def _staging_table(name: str) -> Query:
    return _on_staging(lambda s: plain(s[name]))


QUERIES: dict[str, Query] = {
    # sources, sinks, audit
    **{f"s14_{name}": _staging_table(name) for name in STAGING if name not in (
        "category_translation", "holidays")},
    "s01_csv_round_trip": _csv_round_trip,
    "s02_mixed_encodings": _mixed_encodings,
    "s03_views": _views,
    "s05_json_round_trip": _json_round_trip,
    "s05_holiday_feed": _feed_round_trip,
    "s07_flattened_csv": _flattened_csv,
    "s08_xml_round_trip": _xml_round_trip,
    "s16_catalog_tables": _catalog_tables,
    "s17_gold_import": _gold_import,
    "s19_metrics_rows": _on_warehouse(_metrics_rows),
    "s20_load_log": _load_log,
    "s21_rejected_rows": _on_staging(_rejected_rows),
    "s21_accepted_rows": _on_staging(_accepted_rows),
    "s21_appended_rejects": _appended_rejects,
    # scalar rules
    "c01_clean_text": _on_staging(_clean_text),
    "c02_parsed_timestamps": _on_staging(_parsed_timestamps),
    "c12_order_days": _on_staging(_order_days),
    "c13_customer_regions": _customer_regions,
    "c14_weight_classes": _on_staging(_weight_classes),
    "c15_payment_rules": _on_staging(_payment_rules),
    "c16_status_flags": _on_staging(_status_flags),
    # distinct orders from bitmaps
    "a03_order_count_bitmaps": _on_bitmaps(lambda b, s: order_bitmaps.order_counts(b, ["YearNumber", "CustomerRegion"])),
    "a03_delivered_orders_bitmaps": _on_bitmaps(
        lambda b, s: order_bitmaps.order_counts(b, where=F.col("IsDeliveredFlag") == "Y", name="total_orders_delivered")
    ),
    "a03_months_bitmaps": _on_bitmaps(
        lambda b, s: order_bitmaps.order_counts(b, ["YearNumber", "MonthNumber", "MonthName", "OrderStatus"])
    ),
    "a03_rollup_bitmaps": _on_bitmaps(
        lambda b, s: order_bitmaps.with_sums(
            b, s, ["YearNumber", "QuarterName"], {"Revenue": F.sum("LineTotal").cast("double"), "Items": F.sum("Quantity")},
            F.col("IsDeliveredFlag") == "Y",
        )
    ),
    "c24_card_texts": _on_warehouse(lambda w: dashboard.card_texts(olap.headline(w.sales))),
    "c26_auto_calendar": _on_staging(_auto_calendar),
    # profiling and quality
    "t1_profile": _on_staging(
        lambda s: profiling.profile(
            {n: s[n] for n in STAGING if n not in ("category_translation", "holidays")}
        )
    ),
    "t2_orphans": _on_staging(profiling.integrity_checks),
    "t4_untranslated": _on_staging(profiling.untranslated_categories),
    "t5_geolocation": _on_staging(lambda s: profiling.geolocation_coverage(s["geolocation"])),
    "t6_prepared_sources": _prepared_sources,
    "dq1_duplicates": _on_warehouse(lambda w: quality.star_uniqueness(w.tables())),
    "dq1_staging_duplicates": _on_staging(
        lambda s: quality.uniqueness(
            s, {n: k for n, k in STAGING_KEYS.items() if n not in (
                "category_translation", "holidays")}
        )
    ),
    "dq2_foreign_keys": _on_warehouse(lambda w: quality.broken_references(w.tables())),
    "dq3_missing_values": _on_warehouse(lambda w: quality.missing_values(w.tables())),
    # dimensions and facts
    "dm1_dim_date": _dimension("DimDate"),
    "dm2_dim_geolocation": _on_warehouse(
        lambda w: rounded(w.dims["DimGeolocation"], "Latitude", "Longitude")
    ),
    "dm3_dim_customer": _dimension("DimCustomer"),
    "dm3_dim_customer_tsql": _dimension("DimCustomer", "tsql"),
    "dm4_dim_product": _dimension("DimProduct"),
    "dm5_dim_seller": _dimension("DimSeller"),
    "dm6_dim_payment_type": _dimension("DimPaymentType"),
    "dm6_dim_payment_type_tsql": _dimension("DimPaymentType", "tsql"),
    "dm7_dim_order_status": _dimension("DimOrderStatus"),
    "w1_primary_payment": _on_staging(lambda s: facts.primary_payment(s["payments"])),
    "a08_review_per_order": _on_staging(lambda s: facts.review_per_order(s["reviews"])),
    "ft1_fact_sales": _on_warehouse(lambda w: plain(w.fact_sales)),
    "ft1_fact_sales_tsql": _on_warehouse(lambda w: plain(w.fact_sales), "tsql"),
    "ft2_fact_payment": _on_warehouse(lambda w: plain(w.fact_payment)),
    "ft2_fact_payment_tsql": _on_warehouse(lambda w: plain(w.fact_payment), "tsql"),
    "ft3_wide_view": _on_warehouse(lambda w: plain(wide_view(w.tables()))),
    # fixed analytic questions
    "q01_rollup": _on_sales(olap.rollup_year_quarter),
    "q01_rollup_tsql": _on_sales(lambda s: olap.rollup_year_quarter(s, "tsql"), "tsql"),
    "q02_drilldown": _on_sales(lambda s: olap.drilldown_months(s, DRILL_YEAR)),
    "q02_drilldown_tsql": _on_sales(
        lambda s: olap.drilldown_months(s, DRILL_YEAR, "tsql"), "tsql"),
    "q03_slice": _on_sales(lambda s: olap.slice_region_categories(s, REGION)),
    "q03_slice_tsql": _on_sales(
        lambda s: olap.slice_region_categories(s, REGION, dialect="tsql"), "tsql"),
    "q03_slice_top": _on_sales(lambda s: olap.slice_region_categories(s, REGION, top=3)),
    "q04_dice": _on_sales(
        lambda s: rounded(olap.dice_states(s, DICE_YEAR, PAYMENT), "AvgReview")),
    "q04_dice_tsql": _on_sales(
        lambda s: rounded(olap.dice_states(s, DICE_YEAR, PAYMENT), "AvgReview"), "tsql"),
    "q05_pivot": _on_sales(olap.pivot_region_year),
    "q05_pivot_tsql": _on_warehouse(
        lambda w: olap.pivot_region_year(
            w.sales, olap.calendar_years(w.dims["DimDate"]), "tsql"), "tsql"),
    "q06_kpi_by_category": _on_sales(
        lambda s: rounded(olap.kpi_by_category(s), "OnTimePct", "AvgDeliveryDays", "AvgReview")),
    "q06_kpi_by_category_tsql": _on_sales(
        lambda s: rounded(
            olap.kpi_by_category(s, dialect="tsql"), "OnTimePct", "AvgDeliveryDays", "AvgReview"),
        "tsql"),
    "q07_holiday": _on_sales(lambda s: rounded(olap.holiday_split(s), "AvgReview")),
    "q07_holiday_tsql": _on_sales(
        lambda s: rounded(olap.holiday_split(s, "tsql"), "AvgReview"), "tsql"),
    "q08_orphan_facts": _on_sales(olap.orphan_facts),
    "q08_orphan_facts_tsql": _on_sales(lambda s: olap.orphan_facts(s, -1), "tsql"),
    "q09_top_categories": _on_sales(lambda s: rounded(olap.top_categories(s), "AvgReview")),
    "q09_top_three": _on_sales(lambda s: rounded(olap.top_categories(s, 3), "AvgReview")),
    "q10_payment_mix": _on_warehouse(lambda w: olap.payment_mix(w.payments)),
    "q11_monthly": _on_sales(olap.monthly),
    "q12_region": _on_sales(lambda s: rounded(olap.region_totals(s), "AvgReview")),
    "q13_slowest": _on_sales(
        lambda s: rounded(
            olap.slowest_categories(s, 3), "OnTimePct", "AvgDeliveryDays", "AvgReview")),
    "q14_row_counts": _on_warehouse(olap.row_counts),
    "q15_delivered_revenue": _on_sales(lambda s: olap.kpi(s, "total_revenue_delivered")),
    "q16_delivered_orders": _on_sales(lambda s: olap.kpi(s, "total_orders_delivered")),
    "q17_avg_review": _on_sales(lambda s: rounded(olap.kpi(s, "avg_review"), "avg_review")),
    "q18_on_time_rate": _on_sales(lambda s: rounded(olap.kpi(s, "ontime_rate"), "ontime_rate")),
    "q19_avg_delivery_days": _on_sales(
        lambda s: rounded(olap.kpi(s, "avg_delivery_days"), "avg_delivery_days")),
    # measures by year and region
    "m01_revenue": _measure("Revenue"),
    "m02_items_sold": _measure("Items Sold"),
    "m03_order_count": _measure("Order Count"),
    "m04_aov": _measure("AOV"),
    "m05_avg_review": _measure("Avg Review"),
    "m06_avg_delivery_days": _measure("Avg Delivery Days"),
    "m07_on_time_items": _measure("On Time Items"),
    "m08_on_time_rate": _measure("On Time Rate"),
    "m09_freight_ratio": _measure("Freight Ratio"),
    "m10_yoy_revenue": _measure("YoY Revenue"),
    "m10_yoy_by_day": _measure("YoY Revenue", ("FullDate",)),
    "m10_yoy_by_region": _measure("YoY Revenue", ("CustomerRegion",)),
    "m10_yoy_by_state_and_day": _measure("YoY Revenue", ("CustomerState", "FullDate")),
    "m11_delivered_revenue": _measure("Delivered Revenue"),
    "m12_delivered_orders": _measure("Delivered Orders"),
    "m13_holiday_revenue": _measure("Holiday Revenue"),
    "m13_holiday_by_flag": _measure("Holiday Revenue", ("IsHoliday", "CustomerRegion")),
    "m14_bad_review_items": _measure("Bad Review Items"),
    "m15_bad_review_rate": _measure("Bad Review Rate"),
    "m16_payment_value": _measure("Payment Value"),
    "m17_payment_count": _measure("Payment Count"),
    "m18_avg_installments": _measure("Avg Installments"),
    "m19_slicers": _on_model(
        lambda m: snake(plain(semantic.evaluate(
            m, ["Revenue", "Delivered Orders", "Avg Review", "Payment Value"],
            ["CustomerRegion"], SLICERS), 6))),
    "m19_replaced_filter": _on_model(
        lambda m: snake(plain(semantic.evaluate(
            m, ["Revenue", "Delivered Revenue", "Delivered Orders", "Holiday Revenue"],
            ["YearNumber"], {"IsDeliveredFlag": "N", "IsHoliday": 0}), 6))),
    "m19_blank_filter": _on_model(
        lambda m: snake(plain(semantic.evaluate(
            m, ["Revenue", "Items Sold", "On Time Rate"], ["YearNumber"], {"OnTimeFlag": ["Y", None]}), 6))),
    "m19_only_blanks": _on_model(
        lambda m: snake(plain(semantic.evaluate(
            m, ["Revenue", "Order Count"], ["CustomerRegion"], {"OnTimeFlag": None}), 6))),
    "m20_drill_quarter": _on_model(
        lambda m: snake(plain(semantic.drill_down(m, ["Revenue"], [DRILL_YEAR])))),
    "m20_drill_month": _on_model(
        lambda m: snake(plain(semantic.drill_down(m, ["Revenue"], [DRILL_YEAR, "Q2"])))),
    "m20_drill_date": _on_model(
        lambda m: snake(plain(semantic.drill_down(
            m, ["Revenue", "Order Count"], [DRILL_YEAR, "Q2", "May"])))),
    "m21_model_columns": _on_model(lambda m: semantic.model_columns(m.dims)),
    "m_sales_by_geo": _on_model(
        lambda m: snake(plain(semantic.evaluate(m, ["Revenue", "Items Sold"], ["Region"]), 6))),
    # report visuals
    "v01_executive_cards": _visual("executive_cards"),
    "v02_monthly_revenue": _visual("monthly_revenue"),
    "v03_region_revenue": _visual("region_revenue"),
    "v04_category_revenue": _visual("category_revenue"),
    "v05_category_review": _visual("category_review"),
    "v06_category_on_time": _visual("category_on_time"),
    "v07_holiday_revenue": _visual("holiday_revenue"),
    "v08_state_delivery_days": _visual("state_delivery_days"),
    "v09_logistics_on_time": _visual("logistics_on_time"),
    "v10_logistics_cards": _visual("logistics_cards"),
    "v11_payment_type_value": _visual("payment_type_value"),
    "v12_installment_count": _visual("installment_count"),
    "v13_payment_cards": _visual("payment_cards"),
    "v14_state_revenue": _visual("state_revenue"),
    "v15_delivery_histogram": _on_sales(reports.delivery_histogram),
    "v16_delay_by_state": _on_sales(
        lambda s: rounded(reports.delay_by_state(s), "AvgDelayDays")),
    "v17_payment_group_value": _visual("payment_group_value"),
    "v18_category_lines": _on_sales(
        lambda s: plain(reports.category_lines(s, "promotion"))),
}
