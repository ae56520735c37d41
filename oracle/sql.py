"""Independent DuckDB SQL for every registered query.

The star is written here the long way, with surrogate keys from row_number() and
joins by key, and shares nothing with the Spark code.
"""

from __future__ import annotations

STAGING = """
stg_orders AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
    CASE WHEN o_custkey % 101 = 0 THEN 'gone-' ELSE '' END || CAST(o_custkey AS VARCHAR) AS customer_id,
    CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' WHEN 'P' THEN 'canceled' END AS order_status,
    o_orderdate + to_hours((o_orderkey * 5) % 24) AS order_purchase_timestamp,
    CASE WHEN o_orderkey % 625 <> 0 THEN o_orderdate + to_hours((o_orderkey * 5) % 24) + to_hours(1) END AS order_approved_at,
    CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + to_days(1) END AS order_delivered_carrier_date,
    CASE WHEN o_orderstatus = 'F' AND o_orderkey % 50 <> 0
      THEN o_orderdate + to_days(CAST((o_orderkey * 7) % 30 + 1 AS INTEGER)) + to_hours(o_orderkey % 24) END AS order_delivered_customer_date,
    o_orderdate + to_days(20) AS order_estimated_delivery_date
  FROM orders),
stg_items AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id,
    CASE WHEN l_partkey % 101 = 0 THEN 'gone-' ELSE '' END || CAST(l_partkey AS VARCHAR) AS product_id,
    CASE WHEN l_suppkey % 51 = 0 THEN 'gone-' ELSE '' END || CAST(l_suppkey AS VARCHAR) AS seller_id,
    l_shipdate AS shipping_limit_date, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(12,2)) AS freight_value
  FROM lineitem),
stg_payments AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS payment_sequential,
    CASE l_returnflag || l_linestatus WHEN 'RF' THEN 'credit_card' WHEN 'RO' THEN 'debit_card'
      WHEN 'AF' THEN 'boleto' WHEN 'AO' THEN 'voucher' WHEN 'NF' THEN 'not_defined' END AS payment_type,
    CAST(l_quantity AS INTEGER) % 24 + 1 AS payment_installments,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(12,2)) AS payment_value
  FROM lineitem),
stg_reviews AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS review_id,
    CAST(l_orderkey AS VARCHAR) AS order_id, score AS review_score,
    CASE WHEN score = 5 THEN 'great' END AS review_comment_title,
    CASE WHEN score <> 3 THEN 'score ' || CAST(score AS VARCHAR) END AS review_comment_message,
    l_shipdate AS review_creation_date, l_shipdate + to_days(1) AS review_answer_timestamp
  FROM (SELECT *, CASE WHEN l_returnflag <> 'N' THEN CAST(l_quantity AS INTEGER) % 5 + 1 END AS score FROM lineitem)),
stg_products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id,
    CASE WHEN p_partkey % 50 <> 0 THEN lower(p_type) END AS product_category_name,
    CAST(length(p_name) AS INTEGER) AS product_name_lenght,
    CAST(length(p_name) + length(p_brand) AS INTEGER) AS product_description_lenght,
    p_size % 7 + 1 AS product_photos_qty,
    CASE WHEN p_partkey % 97 <> 0 THEN CAST(p_size * 100 AS DOUBLE) END AS product_weight_g,
    CAST(p_size + 10 AS DOUBLE) AS product_length_cm, CAST(p_size + 5 AS DOUBLE) AS product_height_cm,
    CAST(p_size + 2 AS DOUBLE) AS product_width_cm
  FROM part),
stg_customers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, CAST(c_custkey // 2 AS VARCHAR) AS customer_unique_id,
    CAST(c_nationkey * 10 + c_custkey % 10 + CASE WHEN (c_nationkey * 10 + c_custkey % 10) % 37 = 0 THEN 90000 ELSE 0 END AS INTEGER) AS customer_zip_code_prefix,
    '  ' || n_name AS customer_city, lower(n_name) AS customer_state
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
stg_sellers AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS seller_id,
    CAST(s_nationkey * 10 + s_suppkey % 10 + CASE WHEN (s_nationkey * 10 + s_suppkey % 10) % 37 = 0 THEN 90000 ELSE 0 END AS INTEGER) AS seller_zip_code_prefix,
    '  ' || n_name AS seller_city, lower(n_name) AS seller_state
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey),
stg_geolocation AS (
  SELECT CAST(zip AS INTEGER) AS geolocation_zip_code_prefix, bal / 200 AS geolocation_lat, bal / -100 AS geolocation_lng,
    lower(n_name) AS geolocation_city, n_name AS geolocation_state
  FROM (SELECT c_nationkey * 10 + c_custkey % 10 AS zip, c_acctbal AS bal, c_nationkey AS nk FROM customer
        UNION ALL SELECT s_nationkey * 10 + s_suppkey % 10, s_acctbal, s_nationkey FROM supplier)
  LEFT JOIN nation ON nk = n_nationkey),
stg_translation(pt, en) AS (VALUES ('economy', 'economy_goods'), ('small', 'small_goods'),
  ('medium', 'medium_goods'), ('promo', 'promotion')),
span AS (SELECT min(year(o_orderdate)) AS y0, max(year(o_orderdate)) AS y1 FROM orders),
stg_holidays AS (
  SELECT make_date(y, m, d) AS holiday_date, n AS english_name
  FROM (SELECT unnest(range(y0, y1 + 1)) AS y FROM span),
    (VALUES (1, 1, 'New Year'), (3, 20, 'Spring Day'), (4, 21, 'Founders Day'), (5, 1, 'Labour Day'),
      (6, 12, 'Summer Day'), (9, 7, 'Independence Day'), (10, 12, 'Harvest Day'), (11, 2, 'Remembrance'),
      (12, 25, 'Christmas'), (12, 25, 'Winter Day')) AS h(m, d, n)),
regions AS (SELECT upper(n_name) AS state, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey)
"""


def _star(dialect: str) -> str:
    py = dialect == "py"
    unknown, first = (1, 1) if py else (-1, 0)  # keys of real members start at first + 1
    city = "unknown" if py else "Unknown"
    kind = (
        "coalesce(payment_type, 'not_defined')"
        if py
        else "coalesce(nullif(trim(payment_type), ''), 'not_defined')"
    )
    rank = "0" if py else "2"
    ymd = "CAST(year({0}) * 10000 + month({0}) * 100 + day({0}) AS INTEGER)"

    def key(column: str, fallback: bool) -> str:
        expr = ymd.format(column)
        if py:
            return f"coalesce({expr}, 19000101)"
        held = f"(SELECT DateKey FROM DimDate WHERE FullDate = CAST({column} AS DATE))"
        return f"coalesce({held}, 19000101)" if fallback else held

    def gap(later: str, earlier: str) -> str:
        if py:
            return (
                f"CAST(floor((epoch_us({later}) - epoch_us({earlier})) / 86400000000.0) AS INTEGER)"
            )
        return f"CAST(date_diff('day', CAST({earlier} AS DATE), CAST({later} AS DATE)) AS INTEGER)"

    arrived, due = "o.order_delivered_customer_date", "o.order_estimated_delivery_date"
    bought = "o.order_purchase_timestamp"
    on_time = f"{gap(arrived, due)} <= 0" if py else f"{arrived} <= {due}"
    score = (
        "avg(review_score)" if py
        else "CAST(CAST(avg(CAST(review_score AS DECIMAL(4,2))) AS DECIMAL(4,2)) AS DOUBLE)"
    )
    raw_kind = "{0}.payment_type" if py else "rtrim({0}.payment_type)"
    unknown_kind = "(SELECT PaymentTypeKey FROM DimPaymentType WHERE PaymentType = 'unknown')"
    return f"""
DimDate AS MATERIALIZED (
  SELECT {ymd.format("d")} AS DateKey, d AS FullDate, CAST(day(d) AS INTEGER) AS DayNumber, dayname(d) AS DayName,
    CASE WHEN isodow(d) >= 6 THEN 'N' ELSE 'Y' END AS WeekdayFlag,
    CASE WHEN isodow(d) >= 6 THEN 'Y' ELSE 'N' END AS WeekendFlag,
    CAST(week(d) AS INTEGER) AS WeekOfYear, CAST(month(d) AS INTEGER) AS MonthNumber, monthname(d) AS MonthName,
    CAST(quarter(d) AS INTEGER) AS QuarterNumber, 'Q' || CAST(quarter(d) AS VARCHAR) AS QuarterName,
    CAST(year(d) AS INTEGER) AS YearNumber, strftime(d, '%Y-%m') AS YearMonth,
    CASE WHEN h.holiday_date IS NULL THEN 0 ELSE 1 END AS IsHoliday, h.name AS HolidayName
  FROM (SELECT CAST(unnest(generate_series(make_date(y0, 1, 1), make_date(y1, 12, 31), INTERVAL 1 DAY)) AS DATE) AS d FROM span)
  LEFT JOIN (SELECT holiday_date, max(english_name) AS name FROM stg_holidays GROUP BY 1) h ON h.holiday_date = d
  UNION ALL SELECT 19000101, DATE '1900-01-01', 1, 'Monday', 'Y', 'N', 1, 1, 'January', 1, 'Q1', 1900, '1900-01', 0, NULL),
DimGeolocation AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY ZipPrefix) AS GeoKey, ZipPrefix, City, g.State AS State, coalesce(regions.region, 'Unknown') AS Region, Latitude, Longitude
  FROM (SELECT geolocation_zip_code_prefix AS ZipPrefix, max(geolocation_city) AS City, max(geolocation_state) AS State,
          avg(geolocation_lat) AS Latitude, avg(geolocation_lng) AS Longitude FROM stg_geolocation GROUP BY 1) g
  LEFT JOIN regions ON regions.state = g.State),
DimCustomer AS MATERIALIZED (
  SELECT CAST({unknown} AS BIGINT) AS CustomerKey, 'UNKNOWN' AS CustomerID, 'UNKNOWN' AS CustomerUniqueID, '{city}' AS CustomerCity,
    'XX' AS CustomerState, 'Unknown' AS CustomerRegion, 0 AS CustomerZipPrefix, 1 AS IsUnknown
  UNION ALL SELECT {first} + row_number() OVER (ORDER BY customer_id), customer_id, customer_unique_id, lower(trim(customer_city)),
    upper(trim(customer_state)), coalesce(region, 'Unknown'), customer_zip_code_prefix, 0
  FROM stg_customers LEFT JOIN regions ON state = upper(trim(customer_state))),
DimProduct AS MATERIALIZED (
  SELECT CAST({unknown} AS BIGINT) AS ProductKey, 'UNKNOWN' AS ProductID, 'unknown' AS CategoryNamePortuguese, 'Unknown' AS CategoryNameEnglish,
    CAST(NULL AS DOUBLE) AS WeightG, CAST(NULL AS DOUBLE) AS LengthCm, CAST(NULL AS DOUBLE) AS HeightCm, CAST(NULL AS DOUBLE) AS WidthCm,
    CAST(NULL AS INTEGER) AS PhotosQty, 'Unknown' AS WeightClass, 1 AS IsUnknown
  UNION ALL SELECT {first} + row_number() OVER (ORDER BY product_id), product_id, coalesce(product_category_name, 'unknown'),
    coalesce(en, CASE product_category_name WHEN 'standard' THEN 'standard_goods' ELSE 'Other' END),
    product_weight_g, product_length_cm, product_height_cm, product_width_cm, product_photos_qty,
    CASE WHEN product_weight_g IS NULL THEN 'Unknown' WHEN product_weight_g < 500 THEN 'Light'
      WHEN product_weight_g < 2000 THEN 'Medium' ELSE 'Heavy' END, 0
  FROM stg_products LEFT JOIN stg_translation ON pt = product_category_name),
DimSeller AS MATERIALIZED (
  SELECT CAST({unknown} AS BIGINT) AS SellerKey, 'UNKNOWN' AS SellerID, '{city}' AS SellerCity, 'XX' AS SellerState,
    'Unknown' AS SellerRegion, 0 AS SellerZipPrefix, 1 AS IsUnknown
  UNION ALL SELECT {first} + row_number() OVER (ORDER BY seller_id), seller_id, lower(trim(seller_city)), upper(trim(seller_state)),
    coalesce(region, 'Unknown'), seller_zip_code_prefix, 0
  FROM stg_sellers LEFT JOIN regions ON state = upper(trim(seller_state))),
DimPaymentType AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY r, PaymentType) AS PaymentTypeKey, PaymentType,
    CASE WHEN PaymentType IN ('credit_card', 'debit_card') THEN 'Card' WHEN PaymentType = 'boleto' THEN 'Bank slip'
      WHEN PaymentType = 'voucher' THEN 'Voucher' ELSE 'Other' END AS PaymentTypeGroup
  FROM (SELECT DISTINCT 1 AS r, {kind} AS PaymentType FROM stg_payments
        UNION ALL SELECT {rank}, 'unknown' WHERE NOT EXISTS (SELECT 1 FROM stg_payments WHERE payment_type = 'unknown'))),
DimOrderStatus AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY order_status) AS OrderStatusKey, order_status AS OrderStatus,
    CASE WHEN order_status = 'delivered' THEN 'Y' ELSE 'N' END AS IsDeliveredFlag,
    CASE WHEN order_status IN ('canceled', 'cancelled') THEN 'Y' ELSE 'N' END AS IsCancelledFlag
  FROM (SELECT DISTINCT order_status FROM stg_orders)),
primary_pay AS (
  SELECT order_id, payment_type FROM (SELECT order_id, payment_type,
    row_number() OVER (PARTITION BY order_id ORDER BY payment_sequential, payment_type NULLS FIRST) AS rn FROM stg_payments) WHERE rn = 1),
order_review AS (SELECT order_id, {score} AS review_score FROM stg_reviews GROUP BY 1),
order_facts AS (
    SELECT o.order_id AS oid, {key(bought, True)} AS PurchaseDateKey, {key(arrived, False)} AS DeliveredDateKey,
      {key(due, False)} AS EstimatedDeliveryDateKey, coalesce(c.CustomerKey, {unknown}) AS CustomerKey, g.GeoKey AS CustomerGeoKey,
      coalesce(pt.PaymentTypeKey, {unknown_kind}) AS PaymentTypeKey, os.OrderStatusKey,
      {gap(arrived, bought)} AS DeliveryDays, {gap(arrived, due)} AS DelayDays,
      CASE WHEN {arrived} IS NULL OR {due} IS NULL THEN NULL WHEN {on_time} THEN 'Y' ELSE 'N' END AS OnTimeFlag,
      r.review_score AS ReviewScore
    FROM stg_orders o
    LEFT JOIN DimCustomer c ON c.CustomerID = o.customer_id
    LEFT JOIN DimGeolocation g ON g.ZipPrefix = c.CustomerZipPrefix
    LEFT JOIN primary_pay pp ON pp.order_id = o.order_id
    LEFT JOIN DimPaymentType pt ON pt.PaymentType = {raw_kind.format("pp")}
    LEFT JOIN DimOrderStatus os ON os.OrderStatus = o.order_status
    LEFT JOIN order_review r ON r.order_id = o.order_id),
FactSales AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY OrderID, OrderItemID, ProductKey, SellerKey, Price, FreightValue) AS SalesKey, *
  FROM (SELECT h.PurchaseDateKey, h.DeliveredDateKey, h.EstimatedDeliveryDateKey, h.CustomerKey, coalesce(p.ProductKey, {unknown}) AS ProductKey,
      coalesce(s.SellerKey, {unknown}) AS SellerKey, h.CustomerGeoKey, h.PaymentTypeKey, h.OrderStatusKey, i.order_id AS OrderID,
      i.order_item_id AS OrderItemID, i.price AS Price, i.freight_value AS FreightValue,
      CAST(i.price + i.freight_value AS DECIMAL(12,2)) AS LineTotal, 1 AS Quantity, h.DeliveryDays, h.DelayDays, h.OnTimeFlag, h.ReviewScore
    FROM stg_items i JOIN order_facts h ON h.oid = i.order_id
    LEFT JOIN DimProduct p ON p.ProductID = i.product_id LEFT JOIN DimSeller s ON s.SellerID = i.seller_id)),
FactPayment AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY OrderID, PaymentSequential, PaymentTypeKey, PaymentInstallments, PaymentValue) AS PaymentKey, *
  FROM (SELECT {key(bought, True)} AS PurchaseDateKey, coalesce(c.CustomerKey, {unknown}) AS CustomerKey,
      coalesce(pt.PaymentTypeKey, {unknown_kind}) AS PaymentTypeKey, y.order_id AS OrderID, y.payment_sequential AS PaymentSequential,
      y.payment_installments AS PaymentInstallments, y.payment_value AS PaymentValue
    FROM stg_payments y JOIN stg_orders o ON o.order_id = y.order_id
    LEFT JOIN DimCustomer c ON c.CustomerID = o.customer_id
    LEFT JOIN DimPaymentType pt ON pt.PaymentType = {raw_kind.format("y")})),
wide AS MATERIALIZED (
  SELECT f.*, d.FullDate, d.YearNumber, d.QuarterNumber, d.QuarterName, d.MonthNumber, d.MonthName, d.YearMonth, d.IsHoliday,
    p.CategoryNameEnglish, p.WeightClass, c.CustomerState, c.CustomerRegion, c.CustomerCity,
    s.OrderStatus, s.IsDeliveredFlag, s.IsCancelledFlag, t.PaymentType, t.PaymentTypeGroup, v.SellerState, v.SellerRegion, g.Region
  FROM FactSales f LEFT JOIN DimDate d ON d.DateKey = f.PurchaseDateKey LEFT JOIN DimProduct p USING (ProductKey)
  LEFT JOIN DimCustomer c USING (CustomerKey) LEFT JOIN DimOrderStatus s USING (OrderStatusKey)
  LEFT JOIN DimPaymentType t USING (PaymentTypeKey) LEFT JOIN DimSeller v USING (SellerKey)
  LEFT JOIN DimGeolocation g ON g.GeoKey = f.CustomerGeoKey),
done AS (SELECT * FROM wide WHERE IsDeliveredFlag = 'Y'),
paid AS MATERIALIZED (
  SELECT f.*, d.YearNumber, c.CustomerRegion, t.PaymentType, t.PaymentTypeGroup
  FROM FactPayment f LEFT JOIN DimDate d ON d.DateKey = f.PurchaseDateKey
  LEFT JOIN DimCustomer c USING (CustomerKey) LEFT JOIN DimPaymentType t USING (PaymentTypeKey))
"""


def _staged(body: str) -> str:
    return f"WITH {STAGING.strip()}\n{body}"


def _py(body: str) -> str:
    return f"WITH {STAGING.strip()},\n{_star('py').strip()}\n{body}"


def _tsql(body: str) -> str:
    return f"WITH {STAGING.strip()},\n{_star('tsql').strip()}\n{body}"


def _model_columns() -> str:
    """Every column of the dimensions with its display metadata and the number of its values."""
    parts = []
    for table in ("DimDate", "DimGeolocation", "DimCustomer", "DimProduct", "DimSeller", "DimPaymentType", "DimOrderStatus"):
        parts.append(f"""SELECT '{table}' AS table_name, name AS column_name,
          name IN ('DateKey', 'CustomerKey', 'ProductKey', 'SellerKey', 'GeoKey', 'PaymentTypeKey', 'OrderStatusKey', 'IsUnknown') AS hidden,
          CASE WHEN name IN ('City', 'CustomerCity') THEN 'City' WHEN name IN ('State', 'CustomerState') THEN 'StateOrProvince'
            WHEN name IN ('Latitude', 'Longitude') THEN name WHEN name = 'FullDate' THEN 'Time' END AS data_category,
          CASE name WHEN 'MonthName' THEN 'MonthNumber' WHEN 'QuarterName' THEN 'QuarterNumber' WHEN 'DayName' THEN 'DayOfWeek' END AS sort_by,
          count(v) AS filled
          FROM (SELECT CAST(COLUMNS(*) AS VARCHAR) FROM {table}) UNPIVOT INCLUDE NULLS (v FOR name IN (COLUMNS(*))) GROUP BY name""")
    return " UNION ALL ".join(parts)


SALES_COLUMNS = """SalesKey, PurchaseDateKey, DeliveredDateKey, EstimatedDeliveryDateKey, CustomerKey, ProductKey, SellerKey,
  CustomerGeoKey, PaymentTypeKey, OrderStatusKey, OrderID, OrderItemID, CAST(Price AS DOUBLE) AS Price,
  CAST(FreightValue AS DOUBLE) AS FreightValue, CAST(LineTotal AS DOUBLE) AS LineTotal, Quantity, DeliveryDays, DelayDays, OnTimeFlag, ReviewScore"""
PAYMENT_COLUMNS = """PaymentKey, PurchaseDateKey, CustomerKey, PaymentTypeKey, OrderID, PaymentSequential, PaymentInstallments,
  CAST(PaymentValue AS DOUBLE) AS PaymentValue"""
WIDE_COLUMNS = """YearNumber, QuarterNumber, QuarterName, MonthNumber, MonthName, YearMonth, IsHoliday, CategoryNameEnglish, WeightClass,
  CustomerState, CustomerRegion, CustomerCity, OrderStatus, IsDeliveredFlag, IsCancelledFlag, PaymentType, PaymentTypeGroup, SellerState, SellerRegion"""

REV = "CAST(sum(LineTotal) AS DOUBLE)"
ITEMS = "CAST(sum(Quantity) AS BIGINT)"
ORDERS = "count(DISTINCT OrderID)"
REVIEW = "round(avg(ReviewScore), 6)"
PCT = "round(avg(CASE WHEN OnTimeFlag = 'Y' THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END), 6)"
DAYS = "round(avg(DeliveryDays), 6)"


def _div(top: str, bottom: str) -> str:
    return f"round(CAST({top} AS DOUBLE) / nullif(CAST({bottom} AS DOUBLE), 0), 6)"


def _pick(value: str, rule: str) -> str:
    return f"sum(CASE WHEN {rule} THEN {value} END)"


ON_TIME = _pick("Quantity", "OnTimeFlag = 'Y'")
BAD = _pick("Quantity", "coalesce(ReviewScore, 0) < 3")
DELIVERED = f"CAST({_pick('LineTotal', chr(39).join(['IsDeliveredFlag = ', 'Y', '']))} AS DOUBLE)"
DELIVERED_ORDERS = "nullif(count(DISTINCT CASE WHEN IsDeliveredFlag = 'Y' THEN OrderID END), 0)"
HOLIDAY = "CAST(sum(CASE WHEN IsHoliday = 1 THEN LineTotal END) AS DOUBLE)"


def _measure(expr: str, table: str = "wide") -> str:
    return _py(
        f"SELECT * FROM (SELECT YearNumber, CustomerRegion, round(CAST({expr} AS DOUBLE), 6) AS value FROM {table} "
        "GROUP BY 1, 2) WHERE value IS NOT NULL"
    )


def _counts(pairs, label: str, value: str) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS \"{label}\", {q} AS {value}" for n, q in pairs)


def _profile(tables) -> str:
    parts = []
    for table, (source, columns) in tables.items():
        for column, kind in columns:
            nulls = f"count(*) FILTER ({column} IS NULL)"
            dtype = f"CASE WHEN {nulls} > 0 THEN 'float64' ELSE 'int64' END" if kind == "int64" else f"'{kind}'"
            parts.append(
                f"SELECT '{table}' AS \"table\", '{column}' AS attribute, {dtype} AS dtype, count(*) AS records, "
                f"{nulls} AS null_count, round_even({nulls} * 100.0::DOUBLE / count(*) * 100, 0) / 100 AS null_pct, "
                f"count(DISTINCT {column}) AS distinct_values FROM {source}"
            )
    return _staged("\nUNION ALL ".join(parts))


_S, _I, _F = "str", "int64", "float64"
PROFILED = {
    "customers": ("stg_customers", [("customer_id", _S), ("customer_unique_id", _S), ("customer_zip_code_prefix", _I),
                                    ("customer_city", _S), ("customer_state", _S)]),
    "orders": ("stg_orders", [(c, _S) for c in (
        "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
        "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date")]),
    "order_items": ("stg_items", [("order_id", _S), ("order_item_id", _I), ("product_id", _S), ("seller_id", _S),
                                  ("shipping_limit_date", _S), ("price", _F), ("freight_value", _F)]),
    "payments": ("stg_payments", [("order_id", _S), ("payment_sequential", _I), ("payment_type", _S),
                                  ("payment_installments", _I), ("payment_value", _F)]),
    "reviews": ("stg_reviews", [("review_id", _S), ("order_id", _S), ("review_score", _I), ("review_comment_title", _S),
                                ("review_comment_message", _S), ("review_creation_date", _S), ("review_answer_timestamp", _S)]),
    "products": ("stg_products", [("product_id", _S), ("product_category_name", _S), ("product_name_lenght", _I),
                                  ("product_description_lenght", _I), ("product_photos_qty", _I), ("product_weight_g", _F),
                                  ("product_length_cm", _F), ("product_height_cm", _F), ("product_width_cm", _F)]),
    "sellers": ("stg_sellers", [("seller_id", _S), ("seller_zip_code_prefix", _I), ("seller_city", _S), ("seller_state", _S)]),
    "geolocation": ("stg_geolocation", [("geolocation_zip_code_prefix", _I), ("geolocation_lat", _F), ("geolocation_lng", _F),
                                        ("geolocation_city", _S), ("geolocation_state", _S)]),
}


def _orphans(name, left, lk, right, rk) -> str:
    return (
        f"SELECT '{name}' AS \"check\", count(*) AS missing FROM (SELECT DISTINCT {lk} AS k FROM {left}) "
        f"WHERE NOT EXISTS (SELECT 1 FROM {right} WHERE {rk} = k)"
    )


def _repeats(pairs) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS \"table\", '{'+'.join(k)}' AS business_key, count(*) AS repeated_keys, "
        f"CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS surplus_rows FROM "
        f"(SELECT count(*) AS c FROM {t} GROUP BY {', '.join(k)} HAVING count(*) > 1)"
        for n, t, k in pairs
    )


def _broken(fact, column, dim, key) -> str:
    return (
        f"SELECT '{fact}' AS fact, '{column}' AS \"column\", '{dim}' AS dimension, count(*) AS broken_rows FROM {fact} f "
        f"WHERE f.{column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{key} = f.{column})"
    )


_YEARS = range(1995, 2002)


def _pivot(years) -> str:
    cells = ", ".join(
        f"CAST(coalesce(sum(LineTotal) FILTER (YearNumber = {y}), 0) AS DOUBLE) AS \"{y}\"" for y in years)
    return f"SELECT CustomerRegion, {cells} FROM done GROUP BY 1"


def _pivot_nulls(years) -> str:
    cells = ", ".join(f"CAST(sum(LineTotal) FILTER (YearNumber = {y}) AS DOUBLE) AS \"{y}\"" for y in years)
    return f"SELECT CustomerRegion, {cells} FROM done GROUP BY 1"


_KPI = f"""SELECT CategoryNameEnglish, {ITEMS} AS Items, {PCT} AS OnTimePct, {DAYS} AS AvgDeliveryDays, {REVIEW} AS AvgReview,
  {REV} AS Revenue FROM done WHERE OnTimeFlag IS NOT NULL GROUP BY 1 HAVING sum(Quantity) >= 200"""
_ORPHAN = [("Missing customer", "CustomerKey = {0}"), ("Missing product", "ProductKey = {0}"),
           ("Missing seller", "SellerKey = {0}"), ("Missing purchase date", "PurchaseDateKey = 19000101")]


def _orphan_facts(key) -> str:
    return _counts([(n, f"(SELECT count(*) FROM FactSales WHERE {r.format(key)})") for n, r in _ORPHAN], "Issue", "RowsFound")


_DAY = """SELECT order_id,
  coalesce(CAST(year(a) * 10000 + month(a) * 100 + day(a) AS INTEGER), 19000101) AS key_py,
  CASE WHEN CAST(a AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' THEN CAST(year(a) * 10000 + month(a) * 100 + day(a) AS INTEGER) END AS key_tsql,
  CAST(floor((epoch_us(a) - epoch_us(b)) / 86400000000.0) AS INTEGER) AS days_py,
  CAST(date_diff('day', CAST(b AS DATE), CAST(a AS DATE)) AS INTEGER) AS days_tsql,
  CAST(floor((epoch_us(a) - epoch_us(e)) / 86400000000.0) AS INTEGER) AS late_py,
  CAST(date_diff('day', CAST(e AS DATE), CAST(a AS DATE)) AS INTEGER) AS late_tsql,
  CASE WHEN a IS NULL THEN NULL WHEN floor((epoch_us(a) - epoch_us(e)) / 86400000000.0) <= 0 THEN 'Y' ELSE 'N' END AS flag_py,
  CASE WHEN a IS NULL THEN NULL WHEN a <= e THEN 'Y' ELSE 'N' END AS flag_tsql
FROM (SELECT order_id, order_delivered_customer_date AS a, order_purchase_timestamp AS b, order_estimated_delivery_date AS e FROM stg_orders)"""

_SECTIONS = [
    ("monthly", "YearMonth", f"SELECT YearMonth AS label, {REV} AS amount, YearMonth AS o1, 0 AS o2 FROM done GROUP BY 1"),
    ("top_categories", None, f"SELECT CategoryNameEnglish AS label, {REV} AS amount FROM done GROUP BY 1 ORDER BY amount DESC, label LIMIT 10"),
    ("payment_mix", None, "SELECT PaymentType AS label, CAST(sum(PaymentValue) AS DOUBLE) AS amount FROM paid GROUP BY 1"),
    ("region", None, f"SELECT CustomerRegion AS label, {REV} AS amount FROM done GROUP BY 1"),
    ("holiday", "label", f"SELECT CAST(IsHoliday AS VARCHAR) AS label, {REV} AS amount FROM wide WHERE IsHoliday IS NOT NULL GROUP BY 1"),
    ("kpi_slowest_categories", "amount", f"SELECT CategoryNameEnglish AS label, OnTimePct AS amount FROM ({_KPI}) ORDER BY amount, label LIMIT 8"),
]


def _document() -> str:
    parts = []
    for name, order, query in _SECTIONS:
        by = {"YearMonth": "label", "label": "label", "amount": "amount, label", None: "amount DESC, label"}[order]
        parts.append(
            f"SELECT '{name}' AS section, CAST(row_number() OVER (ORDER BY {by}) AS INTEGER) AS place, label, round(amount, 6) AS amount FROM ({query})"
        )
    parts.append(
        f"SELECT 'rollup', CAST(row_number() OVER (ORDER BY y, q) AS INTEGER), q, round(amount, 6) FROM "
        f"(SELECT YearNumber AS y, QuarterName AS q, {REV} AS amount FROM done GROUP BY 1, 2)"
    )
    for place, (name, query) in enumerate(_HEADLINE, 1):
        parts.append(f"SELECT 'kpis', {place}, '{name}', round(CAST(({query}) AS DOUBLE), 6)")
    return " UNION ALL ".join(parts)


_HEADLINE = [
    ("fact_sales_rows", "SELECT count(*) FROM FactSales"),
    ("unknown_customer_facts", "SELECT count(*) FROM FactSales WHERE CustomerKey = 1"),
    ("unknown_product_facts", "SELECT count(*) FROM FactSales WHERE ProductKey = 1"),
    ("unknown_seller_facts", "SELECT count(*) FROM FactSales WHERE SellerKey = 1"),
    ("fact_payment_rows", "SELECT count(*) FROM FactPayment"),
    ("dim_customer_rows", "SELECT count(*) FROM DimCustomer"),
    ("dim_product_rows", "SELECT count(*) FROM DimProduct"),
    ("dim_seller_rows", "SELECT count(*) FROM DimSeller"),
    ("dim_date_rows", "SELECT count(*) FROM DimDate"),
    ("total_revenue_delivered", f"SELECT {REV} FROM done"),
    ("total_orders_delivered", f"SELECT {ORDERS} FROM done"),
    ("avg_review", "SELECT avg(ReviewScore) FROM done"),
    ("ontime_rate", "SELECT avg(CASE WHEN OnTimeFlag = 'Y' THEN 100.0::DOUBLE WHEN OnTimeFlag IS NOT NULL THEN 0.0::DOUBLE END) FROM done"),
    ("avg_delivery_days", "SELECT avg(DeliveryDays) FROM done"),
]
_PIECES = [
    ("orders", "stg_orders", "order_id"), ("order_items", "stg_items", "order_id"), ("payments", "stg_payments", "order_id"),
    ("reviews", "stg_reviews", "order_id"), ("category_translation_csv", "stg_translation", "pt"),
    ("category_translation_xml", "stg_translation", "pt"), ("holidays", "stg_holidays", "english_name"),
    ("customers", "stg_customers", "customer_id"), ("products", "stg_products", "product_id"),
    ("sellers", "stg_sellers", "seller_id"), ("geolocation", "stg_geolocation", "geolocation_city"),
]
_SLICE = "YearNumber IN (1997, 1998) AND CustomerRegion IN ('ASIA', 'EUROPE')"
_YOY_REGION = """
SELECT * FROM (SELECT CustomerRegion, {0} AS value FROM
  (SELECT CustomerRegion, sum(LineTotal) AS r FROM wide GROUP BY 1) n FULL JOIN
  (SELECT CustomerRegion, sum(LineTotal) AS p FROM wide WHERE YearNumber < (SELECT y1 FROM span) GROUP BY 1) b USING (CustomerRegion))
WHERE value IS NOT NULL""".format(_div("coalesce(n.r, 0) - b.p", "b.p"))
_YOY_DAY = """
SELECT * FROM (SELECT FullDate, {0} AS value FROM
  (SELECT FullDate, sum(LineTotal) AS r FROM wide GROUP BY 1) n FULL JOIN
  (SELECT d.FullDate, sum(w.LineTotal) AS p FROM DimDate d JOIN wide w ON w.FullDate = CAST(d.FullDate - INTERVAL 1 YEAR AS DATE)
   WHERE d.YearNumber > 1900 GROUP BY 1) b USING (FullDate)) WHERE value IS NOT NULL""".format(_div("coalesce(n.r, 0) - b.p", "b.p"))
_YOY_STATE_DAY = """
SELECT * FROM (SELECT CustomerState, FullDate, {0} AS value FROM
  (SELECT CustomerState, FullDate, sum(LineTotal) AS r FROM wide GROUP BY 1, 2) n FULL JOIN
  (SELECT w.CustomerState, d.FullDate, sum(w.LineTotal) AS p FROM DimDate d JOIN wide w ON w.FullDate = CAST(d.FullDate - INTERVAL 1 YEAR AS DATE)
   WHERE d.YearNumber > 1900 GROUP BY 1, 2) b USING (CustomerState, FullDate)) WHERE value IS NOT NULL""".format(_div("coalesce(n.r, 0) - b.p", "b.p"))
_YOY = """
SELECT * FROM (SELECT YearNumber, CustomerRegion, {0} AS value FROM
  (SELECT YearNumber, CustomerRegion, sum(LineTotal) AS r FROM wide GROUP BY 1, 2) n FULL JOIN
  (SELECT YearNumber + 1 AS YearNumber, CustomerRegion, sum(LineTotal) AS p FROM wide
   WHERE YearNumber < (SELECT y1 FROM span) GROUP BY 1, 2) b USING (YearNumber, CustomerRegion))
WHERE value IS NOT NULL""".format(_div("coalesce(n.r, 0) - b.p", "b.p"))

ORACLE: dict[str, str] = {
    **{f"s14_{n}": _staged(f"SELECT * FROM stg_{t}") for n, t in (
        ("customers", "customers"), ("orders", "orders"), ("products", "products"), ("sellers", "sellers"),
        ("geolocation", "geolocation"), ("reviews", "reviews"))},
    "s14_order_items": _staged("SELECT * REPLACE (CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value) FROM stg_items"),
    "s14_payments": _staged("SELECT * REPLACE (CAST(payment_value AS DOUBLE) AS payment_value) FROM stg_payments"),
    "s01_csv_round_trip": _staged("SELECT * FROM stg_reviews"),
    "s02_mixed_encodings": _staged("""SELECT customer_id, customer_unique_id, customer_zip_code_prefix,
      'São ' || trim(customer_city) AS customer_city, customer_state FROM stg_customers"""),
    "s03_views": _staged("SELECT seller_state, count(*) AS sellers FROM stg_sellers GROUP BY 1"),
    "s05_holiday_feed": _staged("""SELECT holiday_date, upper(english_name) AS local_name, english_name, 'ZZ' AS country_code,
      2 * count(*) AS copies FROM stg_holidays GROUP BY ALL"""),
    "s16_catalog_tables": _staged("""SELECT product_id, product_category_name FROM stg_products
      UNION ALL SELECT seller_id, NULL FROM stg_sellers"""),
    "t6_prepared_sources": _staged(" UNION ALL ".join(
        f"SELECT '{piece}' AS piece, count(*) AS \"rows\", CAST(sum(length({key})) AS BIGINT) AS key_chars FROM {table}"
        for piece, table, key in _PIECES)),
    "s05_json_round_trip": _staged("SELECT * FROM stg_sellers"),
    "s07_flattened_csv": _staged(
        "SELECT product_id, '[' || CAST(product_length_cm AS INTEGER) || ',' || CAST(product_height_cm AS INTEGER) || ',' || CAST(product_width_cm AS INTEGER) || ']' AS sizes FROM stg_products"),
    "s08_xml_round_trip": _staged(
        "SELECT DISTINCT product_category_name, coalesce(en, product_category_name) AS product_category_name_english FROM stg_products LEFT JOIN stg_translation ON pt = product_category_name WHERE product_category_name IS NOT NULL"),
    "s17_gold_import": _py(f"SELECT YearNumber, QuarterName, {REV} AS Revenue, {ITEMS} AS Items, {ORDERS} AS Orders FROM done GROUP BY 1, 2"),
    "s19_metrics_rows": _py(_document()),
    "s20_load_log": _staged(" UNION ALL ".join(
        f"SELECT 'staging' AS PackageName, '{n}' AS TaskName, 'SUCCESS' AS Status, count(*) AS RowsAffected FROM {t}"
        for n, t in (("orders", "stg_orders"), ("customers", "stg_customers"), ("products", "stg_products"), ("sellers", "stg_sellers")))),
    "s21_rejected_rows": _staged("""SELECT 'orders' AS SourceTable, order_id AS BusinessKey, 'NO_DELIVERY' AS ReasonCode, 'delivered without a delivery date' AS ReasonText
      FROM stg_orders WHERE order_status = 'delivered' AND order_delivered_customer_date IS NULL
      UNION ALL SELECT 'orders', order_id, 'LATE', 'delivered after the estimate' FROM stg_orders WHERE order_delivered_customer_date > order_estimated_delivery_date"""),
    "s21_appended_rejects": _staged("""SELECT 'orders' AS SourceTable, order_id AS BusinessKey, 'NO_DELIVERY' AS ReasonCode, 'delivered without a delivery date' AS ReasonText
      FROM stg_orders WHERE order_status = 'delivered' AND order_delivered_customer_date IS NULL
      UNION ALL SELECT 'orders', order_id, 'LATE', 'delivered after the estimate' FROM stg_orders WHERE order_delivered_customer_date > order_estimated_delivery_date"""),
    "s21_accepted_rows": _staged("SELECT order_status, count(*) AS orders FROM stg_orders WHERE order_approved_at IS NOT NULL GROUP BY 1"),
    "c01_clean_text": _staged("SELECT customer_id, lower(trim(customer_city)) AS city, upper(trim(customer_state)) AS state, coalesce(nullif(trim(customer_city), ''), 'none') AS city_or_none FROM stg_customers"),
    "c02_parsed_timestamps": _staged("""SELECT order_id, strftime(TRY_CAST(CASE kind WHEN 0 THEN body WHEN 1 THEN left(body, 10) WHEN 2 THEN 'n/a'
        WHEN 3 THEN left(body, 5) || '13' || substr(body, 8) ELSE '' END AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS parsed,
      CASE WHEN kind <> 2 THEN strftime(bought, '%Y-%m-%d %H:%M:00') END AS parsed_by_format
      FROM (SELECT order_id, CAST(order_id AS BIGINT) % 5 AS kind, order_purchase_timestamp AS bought,
        strftime(order_purchase_timestamp, '%Y-%m-%d %H:%M:%S') AS body FROM stg_orders)"""),
    "m21_model_columns": _py(_model_columns()),
    "c12_order_days": _staged(_DAY),
    "c13_customer_regions": _staged("SELECT coalesce(region, 'Unknown') AS region, count(*) AS customers FROM stg_customers LEFT JOIN regions ON state = upper(trim(customer_state)) GROUP BY 1"),
    "c14_weight_classes": _staged("""SELECT CASE WHEN product_weight_g IS NULL THEN 'Unknown' WHEN product_weight_g < 500 THEN 'Light'
      WHEN product_weight_g < 2000 THEN 'Medium' ELSE 'Heavy' END AS WeightClass, count(*) AS products FROM stg_products GROUP BY 1"""),
    "c16_status_flags": _staged("""SELECT CASE WHEN order_status = 'delivered' THEN 'Y' ELSE 'N' END AS IsDeliveredFlag,
      CASE WHEN order_status IN ('canceled', 'cancelled') THEN 'Y' ELSE 'N' END AS IsCancelledFlag, count(*) AS orders FROM stg_orders GROUP BY 1, 2"""),
    "c15_payment_rules": _staged("""SELECT coalesce(payment_type, 'not_defined') AS PaymentType, CASE coalesce(payment_type, 'not_defined')
      WHEN 'credit_card' THEN 'Card' WHEN 'debit_card' THEN 'Card' WHEN 'boleto' THEN 'Bank slip' WHEN 'voucher' THEN 'Voucher' ELSE 'Other' END AS PaymentTypeGroup,
      count(*) AS payments FROM stg_payments GROUP BY 1, 2"""),
    "c24_card_texts": _py(f"""SELECT 'R$ ' || format('{{:,}}', CAST(round_even(CAST(sum(LineTotal) AS DOUBLE), 0) AS BIGINT)) AS revenue,
      format('{{:,}}', {ORDERS}) AS orders,
      format('{{:.1f}}', avg(CASE WHEN OnTimeFlag = 'Y' THEN 100.0::DOUBLE WHEN OnTimeFlag IS NOT NULL THEN 0.0::DOUBLE END)) || '%' AS on_time,
      format('{{:.2f}}', avg(ReviewScore)) || ' / 5' AS review, format('{{:.1f}}', avg(DeliveryDays)) AS days FROM done"""),
    "c26_auto_calendar": _staged("""SELECT d AS "Date", CAST(year(d) AS INTEGER) AS "Year", CAST(month(d) AS INTEGER) AS MonthNo, monthname(d) AS "Month",
      CAST(quarter(d) AS INTEGER) AS QuarterNo, 'Qtr ' || CAST(quarter(d) AS VARCHAR) AS "Quarter", CAST(day(d) AS INTEGER) AS "Day"
      FROM (SELECT CAST(unnest(generate_series(make_date(y0, 1, 1), make_date(y1, 12, 31), INTERVAL 1 DAY)) AS DATE) AS d FROM span)"""),
    "t1_profile": _profile(PROFILED),
    "t2_orphans": _staged(" UNION ALL ".join(_orphans(*c) for c in (
        ("order_items without order", "stg_items", "order_id", "stg_orders", "order_id"),
        ("payments without order", "stg_payments", "order_id", "stg_orders", "order_id"),
        ("reviews without order", "stg_reviews", "order_id", "stg_orders", "order_id"),
        ("orders without customer", "stg_orders", "customer_id", "stg_customers", "customer_id"),
        ("items without product", "stg_items", "product_id", "stg_products", "product_id"),
        ("items without seller", "stg_items", "seller_id", "stg_sellers", "seller_id")))),
    "t4_untranslated": _staged("SELECT DISTINCT product_category_name FROM stg_products WHERE product_category_name IS NOT NULL AND product_category_name NOT IN (SELECT pt FROM stg_translation)"),
    "t5_geolocation": _staged("SELECT count(*) AS geo_rows, count(DISTINCT geolocation_zip_code_prefix) AS unique_zips FROM stg_geolocation"),
    "dq1_duplicates": _py(_repeats([(t, t, (k,)) for t, k in (
        ("DimCustomer", "CustomerID"), ("DimProduct", "ProductID"), ("DimSeller", "SellerID"), ("DimGeolocation", "ZipPrefix"),
        ("DimPaymentType", "PaymentType"), ("DimOrderStatus", "OrderStatus"))])),
    "dq1_staging_duplicates": _staged(_repeats([
        ("customers", "stg_customers", ("customer_id",)), ("orders", "stg_orders", ("order_id",)),
        ("order_items", "stg_items", ("order_id", "order_item_id")), ("payments", "stg_payments", ("order_id", "payment_sequential")),
        ("reviews", "stg_reviews", ("review_id",)), ("products", "stg_products", ("product_id",)), ("sellers", "stg_sellers", ("seller_id",))])),
    "dq2_foreign_keys": _py(" UNION ALL ".join(_broken(*r) for r in (
        ("FactSales", "PurchaseDateKey", "DimDate", "DateKey"), ("FactSales", "CustomerKey", "DimCustomer", "CustomerKey"),
        ("FactSales", "ProductKey", "DimProduct", "ProductKey"), ("FactSales", "SellerKey", "DimSeller", "SellerKey"),
        ("FactSales", "OrderStatusKey", "DimOrderStatus", "OrderStatusKey"), ("FactPayment", "PurchaseDateKey", "DimDate", "DateKey"),
        ("FactPayment", "CustomerKey", "DimCustomer", "CustomerKey"), ("FactPayment", "PaymentTypeKey", "DimPaymentType", "PaymentTypeKey")))),
    "dq3_missing_values": _py(" UNION ALL ".join(
        f"SELECT '{f}' AS fact, '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS null_rows FROM {f}"
        for f, cs in (("FactSales", "SalesKey PurchaseDateKey CustomerKey ProductKey SellerKey OrderStatusKey OrderID OrderItemID Price FreightValue LineTotal Quantity"),
                      ("FactPayment", "PaymentKey PurchaseDateKey CustomerKey PaymentTypeKey OrderID PaymentSequential PaymentInstallments PaymentValue"))
        for c in cs.split())),
    "dm1_dim_date": _py("SELECT * FROM DimDate"),
    "dm2_dim_geolocation": _py("SELECT * REPLACE (round(Latitude, 6) AS Latitude, round(Longitude, 6) AS Longitude) FROM DimGeolocation"),
    "dm3_dim_customer": _py("SELECT * FROM DimCustomer"),
    "dm3_dim_customer_tsql": _tsql("SELECT * FROM DimCustomer"),
    "dm4_dim_product": _py("SELECT * FROM DimProduct"),
    "dm5_dim_seller": _py("SELECT * FROM DimSeller"),
    "dm6_dim_payment_type": _py("SELECT * FROM DimPaymentType"),
    "dm6_dim_payment_type_tsql": _tsql("SELECT * FROM DimPaymentType"),
    "dm7_dim_order_status": _py("SELECT * FROM DimOrderStatus"),
    "w1_primary_payment": _py("SELECT order_id, payment_type FROM primary_pay"),
    "a08_review_per_order": _py("SELECT order_id, review_score FROM order_review"),
    "ft1_fact_sales": _py(f"SELECT {SALES_COLUMNS} FROM FactSales"),
    "ft1_fact_sales_tsql": _tsql(f"SELECT {SALES_COLUMNS} FROM FactSales"),
    "ft2_fact_payment": _py(f"SELECT {PAYMENT_COLUMNS} FROM FactPayment"),
    "ft2_fact_payment_tsql": _tsql(f"SELECT {PAYMENT_COLUMNS} FROM FactPayment"),
    "ft3_wide_view": _py(f"SELECT {SALES_COLUMNS}, {WIDE_COLUMNS} FROM wide"),
    "a03_order_count_bitmaps": _py(f"SELECT YearNumber, CustomerRegion, {ORDERS} AS Orders FROM wide WHERE YearNumber IS NOT NULL AND CustomerRegion IS NOT NULL GROUP BY 1, 2"),
    "a03_delivered_orders_bitmaps": _py(f"SELECT {ORDERS} AS total_orders_delivered FROM done"),
    "a03_months_bitmaps": _py(f"SELECT YearNumber, MonthNumber, MonthName, OrderStatus, {ORDERS} AS Orders FROM wide WHERE MonthNumber IS NOT NULL AND OrderStatus IS NOT NULL GROUP BY 1, 2, 3, 4"),
    "a03_rollup_bitmaps": _py(f"SELECT YearNumber, QuarterName, {REV} AS Revenue, {ITEMS} AS Items, {ORDERS} AS Orders FROM done GROUP BY 1, 2"),
    "q01_rollup": _py(f"SELECT YearNumber, QuarterName, {REV} AS Revenue, {ITEMS} AS Items, {ORDERS} AS Orders FROM done GROUP BY 1, 2"),
    "q01_rollup_tsql": _tsql(f"SELECT YearNumber, QuarterName, {REV} AS Revenue, {ITEMS} AS ItemsSold, {ORDERS} AS Orders FROM done GROUP BY 1, 2"),
    "q02_drilldown": _py(f"SELECT MonthNumber, MonthName, {REV} AS Revenue, {ORDERS} AS Orders FROM done WHERE YearNumber = 1997 GROUP BY 1, 2"),
    "q02_drilldown_tsql": _tsql(f"SELECT YearMonth, MonthName, {REV} AS Revenue FROM wide WHERE YearNumber = 1997 GROUP BY 1, 2"),
    "q03_slice_top": _py(f"SELECT CategoryNameEnglish, {REV} AS Revenue FROM done WHERE CustomerRegion = 'ASIA' GROUP BY 1 ORDER BY Revenue DESC, 1 LIMIT 3"),
    "q03_slice": _py(f"SELECT CategoryNameEnglish, {REV} AS Revenue FROM done WHERE CustomerRegion = 'ASIA' GROUP BY 1 ORDER BY Revenue DESC, 1 LIMIT 15"),
    "q03_slice_tsql": _tsql(f"SELECT CategoryNameEnglish, {REV} AS Revenue FROM wide WHERE CustomerRegion = 'ASIA' GROUP BY 1"),
    "q04_dice": _py(f"SELECT CustomerState, {REV} AS Revenue, {REVIEW} AS AvgReview FROM done WHERE YearNumber = 1998 AND PaymentType = 'credit_card' GROUP BY 1"),
    "q04_dice_tsql": _tsql(f"SELECT CustomerState, {REV} AS Revenue, {REVIEW} AS AvgReview FROM done WHERE YearNumber = 1998 AND PaymentType = 'credit_card' GROUP BY 1"),
    "q05_pivot": _py(_pivot(_YEARS)),
    "q05_pivot_tsql": _tsql(_pivot_nulls(_YEARS)),
    "q06_kpi_by_category": _py(_KPI),
    "q06_kpi_by_category_tsql": _tsql(f"""SELECT CategoryNameEnglish, count(*) AS DeliveredItems, {PCT} AS OnTimePct, {DAYS} AS AvgDeliveryDays, {REVIEW} AS AvgReview
      FROM done WHERE OnTimeFlag IS NOT NULL GROUP BY 1 HAVING count(*) >= 200"""),
    "q07_holiday": _py(f"SELECT IsHoliday, {ORDERS} AS Orders, {REV} AS Revenue, {REVIEW} AS AvgReview FROM wide WHERE IsHoliday IS NOT NULL GROUP BY 1"),
    "q07_holiday_tsql": _tsql(f"SELECT CASE WHEN IsHoliday = 1 THEN 'Holiday' ELSE 'Non-holiday' END AS DayType, {ORDERS} AS Orders, {REV} AS Revenue, {REVIEW} AS AvgReview FROM wide GROUP BY 1"),
    "q08_orphan_facts": _py(_orphan_facts(1)),
    "q08_orphan_facts_tsql": _tsql(_orphan_facts(-1)),
    "q09_top_three": _py(f"SELECT CategoryNameEnglish, {REV} AS Revenue, {ORDERS} AS Orders, {REVIEW} AS AvgReview FROM done GROUP BY 1 ORDER BY Revenue DESC, 1 LIMIT 3"),
    "q09_top_categories": _py(f"SELECT CategoryNameEnglish, {REV} AS Revenue, {ORDERS} AS Orders, {REVIEW} AS AvgReview FROM done GROUP BY 1 ORDER BY Revenue DESC, 1 LIMIT 10"),
    "q10_payment_mix": _py("SELECT PaymentType, CAST(sum(PaymentValue) AS DOUBLE) AS PaymentValue, count(DISTINCT OrderID) AS Txn FROM paid GROUP BY 1"),
    "q11_monthly": _py(f"SELECT YearMonth, {REV} AS Revenue, {ORDERS} AS Orders FROM done GROUP BY 1"),
    "q12_region": _py(f"SELECT CustomerRegion, {REV} AS Revenue, {ORDERS} AS Orders, {REVIEW} AS AvgReview FROM done GROUP BY 1"),
    "q13_slowest": _py(f"{_KPI} ORDER BY OnTimePct, CategoryNameEnglish LIMIT 3"),
    "q14_row_counts": _py(_counts([(n, f"(SELECT count(*) FROM {t})") for n, t in (
        ("fact_sales_rows", "FactSales"), ("fact_payment_rows", "FactPayment"), ("dim_customer_rows", "DimCustomer"),
        ("dim_product_rows", "DimProduct"), ("dim_seller_rows", "DimSeller"), ("dim_date_rows", "DimDate"))], "metric", "rows")),
    "q15_delivered_revenue": _py(f"SELECT {REV} AS total_revenue_delivered FROM done"),
    "q16_delivered_orders": _py(f"SELECT {ORDERS} AS total_orders_delivered FROM done"),
    "q17_avg_review": _py(f"SELECT {REVIEW} AS avg_review FROM done"),
    "q18_on_time_rate": _py(f"SELECT {PCT} AS ontime_rate FROM done WHERE OnTimeFlag IS NOT NULL"),
    "q19_avg_delivery_days": _py(f"SELECT {DAYS} AS avg_delivery_days FROM done"),
    "m01_revenue": _measure("sum(LineTotal)"),
    "m02_items_sold": _measure("sum(Quantity)"),
    "m03_order_count": _measure(ORDERS),
    "m04_aov": _measure(f"CAST(sum(LineTotal) AS DOUBLE) / {ORDERS}"),
    "m05_avg_review": _measure("avg(ReviewScore)"),
    "m06_avg_delivery_days": _measure("avg(DeliveryDays)"),
    "m07_on_time_items": _measure(ON_TIME),
    "m08_on_time_rate": _measure(_div(ON_TIME, "sum(Quantity)")),
    "m09_freight_ratio": _measure(_div("sum(FreightValue)", "sum(LineTotal)")),
    "m10_yoy_revenue": _py(_YOY),
    "m10_yoy_by_state_and_day": _py(_YOY_STATE_DAY),
    "m19_blank_filter": _py(f"""SELECT YearNumber AS yearnumber, round({REV}, 6) AS revenue, {ITEMS} AS items_sold,
      {_div("sum(Quantity) FILTER (OnTimeFlag = 'Y')", "sum(Quantity)")} AS on_time_rate
      FROM wide WHERE OnTimeFlag = 'Y' OR OnTimeFlag IS NULL GROUP BY 1"""),
    "m19_only_blanks": _py(f"""SELECT CustomerRegion AS customerregion, round({REV}, 6) AS revenue, {ORDERS} AS order_count
      FROM wide WHERE OnTimeFlag IS NULL GROUP BY 1"""),
    "m10_yoy_by_day": _py(_YOY_DAY),
    "m10_yoy_by_region": _py(_YOY_REGION),
    "m11_delivered_revenue": _measure(DELIVERED),
    "m12_delivered_orders": _measure(DELIVERED_ORDERS),
    "m13_holiday_revenue": _measure(HOLIDAY),
    "m13_holiday_by_flag": _py("""SELECT * FROM (SELECT DISTINCT IsHoliday, CustomerRegion FROM wide) JOIN
      (SELECT CustomerRegion, round(CAST(sum(LineTotal) AS DOUBLE), 6) AS value FROM wide WHERE IsHoliday = 1 GROUP BY 1) USING (CustomerRegion)"""),
    "m14_bad_review_items": _measure(BAD),
    "m15_bad_review_rate": _measure(_div(BAD, "sum(Quantity)")),
    "m16_payment_value": _measure("sum(PaymentValue)", "paid"),
    "m17_payment_count": _measure("count(*)", "paid"),
    "m18_avg_installments": _measure("avg(PaymentInstallments)", "paid"),
    "m19_slicers": _py(f"""SELECT CustomerRegion AS customerregion, revenue, delivered_orders, avg_review, payment_value FROM
      (SELECT CustomerRegion, round({REV}, 6) AS revenue, {DELIVERED_ORDERS} AS delivered_orders, {REVIEW} AS avg_review FROM done WHERE {_SLICE} GROUP BY 1)
      JOIN (SELECT CustomerRegion, round(CAST(sum(PaymentValue) AS DOUBLE), 6) AS payment_value FROM paid WHERE {_SLICE} GROUP BY 1) USING (CustomerRegion)"""),
    "m19_replaced_filter": _py("""SELECT YearNumber AS yearnumber,
      CAST(sum(LineTotal) FILTER (IsDeliveredFlag = 'N' AND IsHoliday = 0) AS DOUBLE) AS revenue,
      CAST(sum(LineTotal) FILTER (IsDeliveredFlag = 'Y' AND IsHoliday = 0) AS DOUBLE) AS delivered_revenue,
      count(DISTINCT OrderID) FILTER (IsDeliveredFlag = 'Y' AND IsHoliday = 0) AS delivered_orders,
      CAST(sum(LineTotal) FILTER (IsDeliveredFlag = 'N' AND IsHoliday = 1) AS DOUBLE) AS holiday_revenue FROM wide GROUP BY 1"""),
    "m20_drill_quarter": _py(f"SELECT QuarterName AS quartername, {REV} AS revenue FROM wide WHERE YearNumber = 1997 GROUP BY 1"),
    "m20_drill_month": _py(f"SELECT MonthName AS monthname, {REV} AS revenue FROM wide WHERE YearNumber = 1997 AND QuarterName = 'Q2' GROUP BY 1"),
    "m20_drill_date": _py(f"SELECT FullDate AS fulldate, {REV} AS revenue, {ORDERS} AS order_count FROM wide WHERE YearMonth = '1997-05' GROUP BY 1"),
    "m_sales_by_geo": _py(f"SELECT Region AS region, {REV} AS revenue, {ITEMS} AS items_sold FROM wide GROUP BY 1"),
    "v01_executive_cards": _py(f"""SELECT {DELIVERED} AS delivered_revenue, {DELIVERED_ORDERS} AS delivered_orders, {_div(ON_TIME, 'sum(Quantity)')} AS on_time_rate,
      {REVIEW} AS avg_review, {DAYS} AS avg_delivery_days FROM wide"""),
    "v02_monthly_revenue": _py(f"SELECT YearNumber AS yearnumber, YearMonth AS yearmonth, {REV} AS delivered_revenue FROM done GROUP BY 1, 2"),
    "v03_region_revenue": _py(f"SELECT CustomerRegion AS customerregion, {REV} AS delivered_revenue FROM done GROUP BY 1"),
    "v04_category_revenue": _py(f"SELECT CategoryNameEnglish AS categorynameenglish, {REV} AS revenue FROM wide GROUP BY 1"),
    "v05_category_review": _py(f"SELECT CategoryNameEnglish AS categorynameenglish, {REVIEW} AS avg_review FROM wide GROUP BY 1"),
    "v06_category_on_time": _py(f"SELECT CategoryNameEnglish AS categorynameenglish, {_div(ON_TIME, 'sum(Quantity)')} AS on_time_rate FROM wide GROUP BY 1"),
    "v07_holiday_revenue": _py(f"SELECT IsHoliday AS isholiday, {REV} AS revenue FROM wide GROUP BY 1"),
    "v08_state_delivery_days": _py(f"SELECT CustomerState AS customerstate, {DAYS} AS avg_delivery_days FROM wide GROUP BY 1"),
    "v09_logistics_on_time": _py(f"SELECT CategoryNameEnglish AS categorynameenglish, {_div(ON_TIME, 'sum(Quantity)')} AS on_time_rate FROM wide GROUP BY 1"),
    "v10_logistics_cards": _py(f"""SELECT {DAYS} AS avg_delivery_days, {_div(ON_TIME, 'sum(Quantity)')} AS on_time_rate, {_div(BAD, 'sum(Quantity)')} AS bad_review_rate,
      {_div('sum(FreightValue)', 'sum(LineTotal)')} AS freight_ratio FROM wide"""),
    "v11_payment_type_value": _py("SELECT PaymentType AS paymenttype, CAST(sum(PaymentValue) AS DOUBLE) AS payment_value FROM paid GROUP BY 1"),
    "v12_installment_count": _py("SELECT PaymentInstallments AS paymentinstallments, count(*) AS payment_count FROM paid GROUP BY 1"),
    "v13_payment_cards": _py("SELECT CAST(sum(PaymentValue) AS DOUBLE) AS payment_value, count(*) AS payment_count, round(avg(PaymentInstallments), 6) AS avg_installments FROM paid"),
    "v14_state_revenue": _py(f"SELECT CustomerState AS customerstate, {REV} AS revenue FROM wide GROUP BY 1"),
    "v15_delivery_histogram": _py("SELECT CAST(floor(DeliveryDays / 5.0) * 5 AS INTEGER) AS DaysFrom, count(*) AS Items FROM wide WHERE DeliveryDays IS NOT NULL GROUP BY 1"),
    "v16_delay_by_state": _py("SELECT CustomerState, round(avg(DelayDays), 6) AS AvgDelayDays FROM wide GROUP BY 1"),
    "v17_payment_group_value": _py("SELECT PaymentTypeGroup AS paymenttypegroup, CAST(sum(PaymentValue) AS DOUBLE) AS payment_value FROM paid GROUP BY 1"),
    "v18_category_lines": _py("""SELECT OrderID, OrderItemID, YearMonth, CustomerState, SellerState, CAST(Price AS DOUBLE) AS Price, CAST(FreightValue AS DOUBLE) AS FreightValue,
      CAST(LineTotal AS DOUBLE) AS LineTotal, DeliveryDays, DelayDays, OnTimeFlag, ReviewScore FROM wide WHERE CategoryNameEnglish = 'promotion'"""),
}
