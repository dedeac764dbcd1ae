"""The registered queries once more, as SQL over the given tables, to check the results against."""

from __future__ import annotations

FIRST_DAY = "(SELECT MIN(CAST(o_orderdate AS DATE)) FROM orders)"
AS_OF = "(SELECT MAX(CAST(o_orderdate AS DATE)) FROM orders)"

# Facts of the given tables: first line per (order, part, retailer), amounts in whole cents.
LINES = """
lines AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
         CAST(l_suppkey % 3 + 1 AS INTEGER) AS retailer,
         CAST(l_quantity AS INTEGER) AS q,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS cents
  FROM lineitem
)"""
STAR = LINES + """,
firsts AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
      PARTITION BY l_orderkey, l_partkey, retailer
      ORDER BY l_linenumber, l_suppkey, cents, q) AS rn
    FROM lines) WHERE rn = 1
),
fs AS (
  SELECT CAST(o_orderdate AS DATE) AS date,
         CAST(l_partkey AS BIGINT) AS product_id,
         CASE WHEN o_custkey % 10 <> 0 THEN o_custkey END AS customer_id,
         CASE WHEN l_suppkey % 25 <> 0 THEN l_suppkey END AS store_id,
         retailer AS retailer_id,
         CAST(l_orderkey AS VARCHAR) AS transaction_id,
         q AS quantity,
         CAST(((2 * cents + q) // (2 * q)) * 0.01 AS DECIMAL(10,2)) AS unit_price,
         CAST(cents * 0.01 AS DECIMAL(10,2)) AS total_amount,
         'Retailer ' || retailer AS retailer_name,
         'retailer_' || retailer AS retailer_code,
         CAST(l_partkey AS VARCHAR) AS product_sku,
         p_name AS product_name,
         CASE WHEN p_type <> 'PROMO' THEN p_type END AS category,
         CAST(year(o_orderdate) AS INTEGER) AS year,
         CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
         CAST(month(o_orderdate) AS INTEGER) AS month,
         CAST(weekofyear(o_orderdate) AS INTEGER) AS week,
         CAST(day(o_orderdate) AS INTEGER) AS day
  FROM firsts
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
)"""


def avg(column: str) -> str:
    return f"CAST(SUM({column}) AS DOUBLE) / COUNT({column})"


VIEWS = STAR + f""",
mv1 AS (
  SELECT date, year, month, quarter, retailer_id, retailer_name,
         COUNT(*) AS transaction_count,
         COUNT(DISTINCT transaction_id) AS unique_transactions,
         CAST(SUM(quantity) AS BIGINT) AS total_quantity,
         SUM(total_amount) AS total_revenue,
         {avg("unit_price")} AS avg_unit_price,
         MIN(total_amount) AS min_transaction_amount,
         MAX(total_amount) AS max_transaction_amount
  FROM fs GROUP BY date, year, month, quarter, retailer_id, retailer_name
),
mv2 AS (
  SELECT year, month, quarter, category, retailer_id, retailer_name,
         COUNT(*) AS transaction_count,
         COUNT(DISTINCT transaction_id) AS unique_transactions,
         COUNT(DISTINCT product_id) AS unique_products,
         CAST(SUM(quantity) AS BIGINT) AS total_quantity,
         SUM(total_amount) AS total_revenue,
         {avg("unit_price")} AS avg_unit_price
  FROM fs WHERE category IS NOT NULL
  GROUP BY year, month, quarter, category, retailer_id, retailer_name
),
mv3 AS (
  SELECT product_id, product_sku, product_name, category, retailer_id, retailer_name,
         COUNT(*) AS transaction_count,
         COUNT(DISTINCT transaction_id) AS unique_transactions,
         CAST(SUM(quantity) AS BIGINT) AS total_quantity_sold,
         SUM(total_amount) AS total_revenue,
         {avg("unit_price")} AS avg_unit_price,
         MIN(unit_price) AS min_unit_price,
         MAX(unit_price) AS max_unit_price
  FROM fs GROUP BY product_id, product_sku, product_name, category, retailer_id, retailer_name
),
mv4 AS (
  SELECT year, week, quarter, retailer_id, retailer_name,
         COUNT(*) AS transaction_count,
         COUNT(DISTINCT transaction_id) AS unique_transactions,
         COUNT(DISTINCT date) AS days_with_sales,
         CAST(SUM(quantity) AS BIGINT) AS total_quantity,
         SUM(total_amount) AS total_revenue,
         {avg("total_amount")} AS avg_transaction_amount,
         MIN(date) AS week_start_date,
         MAX(date) AS week_end_date
  FROM fs GROUP BY year, week, quarter, retailer_id, retailer_name
),
mv5 AS (
  SELECT year, quarter, retailer_id, retailer_name,
         COUNT(*) AS transaction_count,
         COUNT(DISTINCT transaction_id) AS unique_transactions,
         COUNT(DISTINCT date) AS days_with_sales,
         COUNT(DISTINCT product_id) AS unique_products,
         CAST(SUM(quantity) AS BIGINT) AS total_quantity,
         SUM(total_amount) AS total_revenue,
         {avg("total_amount")} AS avg_transaction_amount
  FROM fs GROUP BY year, quarter, retailer_id, retailer_name
),
mv6 AS (
  SELECT date, year, month, product_id, product_sku, product_name, category,
         retailer_id, retailer_name,
         COUNT(*) AS transaction_count,
         CAST(SUM(quantity) AS BIGINT) AS total_quantity_sold,
         SUM(total_amount) AS total_revenue,
         {avg("unit_price")} AS avg_unit_price
  FROM fs
  GROUP BY date, year, month, product_id, product_sku, product_name, category,
           retailer_id, retailer_name
)"""

MONEY_COLUMNS = (
    "total_revenue", "min_transaction_amount", "max_transaction_amount", "min_unit_price",
    "max_unit_price", "revenue", "monthly_revenue", "max_daily_revenue", "q1_revenue",
    "q2_revenue", "q3_revenue", "q4_revenue", "unit_price", "total_amount", "Retailer 1",
    "Retailer 2", "Retailer 3",
)
DATE_COLUMNS = (
    "date", "week_start_date", "week_end_date", "time", "period_start", "period_end",
    "date_range_start", "date_range_end", "latest_date", "file_date",
)


def out(body: str, columns: str) -> str:
    """``body`` with the listed columns, money as DOUBLE and dates as text."""
    picked = []
    for name in columns.split(", "):
        quoted = f'"{name}"'
        if name in MONEY_COLUMNS:
            quoted = f"CAST({quoted} AS DOUBLE) AS {quoted}"
        elif name in DATE_COLUMNS:
            quoted = f"CAST({quoted} AS VARCHAR) AS {quoted}"
        picked.append(quoted)
    return f"SELECT {', '.join(picked)} FROM ({body})"


def star(body: str, columns: str) -> str:
    return f"WITH {STAR} {out(body, columns)}"


def views(body: str, columns: str) -> str:
    return f"WITH {VIEWS} {out(body, columns)}"


MV1 = ("date, year, month, quarter, retailer_id, retailer_name, transaction_count, "
       "unique_transactions, total_quantity, total_revenue, avg_unit_price, "
       "min_transaction_amount, max_transaction_amount")
MV2 = ("year, month, quarter, category, retailer_id, retailer_name, transaction_count, "
       "unique_transactions, unique_products, total_quantity, total_revenue, avg_unit_price")
MV3 = ("product_id, product_sku, product_name, category, retailer_id, retailer_name, "
       "transaction_count, unique_transactions, total_quantity_sold, total_revenue, "
       "avg_unit_price, min_unit_price, max_unit_price")
MV4 = ("year, week, quarter, retailer_id, retailer_name, transaction_count, "
       "unique_transactions, days_with_sales, total_quantity, total_revenue, "
       "avg_transaction_amount, week_start_date, week_end_date")
MV5 = ("year, quarter, retailer_id, retailer_name, transaction_count, unique_transactions, "
       "days_with_sales, unique_products, total_quantity, total_revenue, avg_transaction_amount")
MV6 = ("date, product_id, product_sku, product_name, category, retailer_id, retailer_name, "
       "transaction_count, total_quantity_sold, total_revenue, avg_unit_price, year, month")


# Source tables and records -----------------------------------------------------------------

ALL_LINES = LINES + """,
sold AS (
  SELECT lines.*, o_orderdate, o_custkey, p_name,
         CASE WHEN p_type <> 'PROMO' THEN p_type END AS category,
         CAST(cents * 0.01 AS DECIMAL(10,2)) AS total,
         CAST(((2 * cents + q) // (2 * q)) * 0.01 AS DECIMAL(10,2)) AS price,
         CAST(CASE WHEN o_custkey % 10 <> 0 THEN o_custkey END AS VARCHAR) AS customer,
         CAST(CASE WHEN l_suppkey % 25 <> 0 THEN l_suppkey END AS VARCHAR) AS store,
         CAST(l_orderkey AS VARCHAR) AS txn,
         CAST(l_partkey AS VARCHAR) AS sku,
         CAST(o_orderdate AS DATE) AS day,
         'retailer_' || retailer AS code,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS stamp,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS iso
  FROM lines
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
)"""


def sold(body: str) -> str:
    return f"WITH {ALL_LINES} {body}"


SCAN = {
    1: """SELECT txn AS order_id, stamp AS order_date, customer AS customer_id, store AS store_id,
       sku, p_name AS product_name, category, q AS quantity,
       CAST(price AS DOUBLE) AS price, CAST(total AS DOUBLE) AS total,
       CASE WHEN l_linenumber > 2 THEN CAST(l_linenumber AS DOUBLE) END AS discount_percentage,
       CASE WHEN l_linenumber % 2 = 0 THEN 'Cash' ELSE 'Credit Card' END AS payment_method
       FROM sold WHERE retailer = 1""",
    2: """SELECT txn AS transaction_number, stamp AS date, customer AS member_id,
       store AS location_id, sku AS item_code, p_name AS item_name, category AS department,
       q AS qty, CAST(price AS DOUBLE) AS unit_cost, CAST(total AS DOUBLE) AS amount,
       CASE WHEN l_linenumber <> 3 THEN CAST(l_linenumber AS DOUBLE) END AS tax_amount,
       CASE WHEN l_linenumber > 1 THEN q END AS loyalty_points_earned,
       CASE WHEN l_linenumber = 7 THEN 'PROMO-10' END AS promotion_code,
       'REP-' || l_linenumber AS sales_rep_id
       FROM sold WHERE retailer = 2""",
    3: """SELECT txn AS sale_id, stamp AS "timestamp", customer AS buyer_id, store AS outlet_id,
       sku AS product_code, p_name AS name, category AS type, q AS count,
       CAST(price AS DOUBLE) AS price_per_unit, CAST(total AS DOUBLE) AS revenue,
       CASE WHEN l_linenumber < 5 THEN CAST(l_linenumber AS DOUBLE) END AS shipping_cost,
       CASE WHEN l_linenumber % 2 = 1 THEN l_linenumber * 6 END AS warranty_months,
       CASE WHEN l_linenumber = 1 THEN 0 WHEN l_linenumber = 2 THEN 60 END AS return_policy_days,
       'SUP-' || l_suppkey AS supplier_id
       FROM sold WHERE retailer = 3""",
}

RECORDS = """SELECT code AS retailer_id, txn AS transaction_id, sku AS product_id,
       p_name AS product_name, category, q AS quantity, CAST(price AS DOUBLE) AS unit_price,
       CAST(total AS DOUBLE) AS total_amount, stamp AS transaction_date,
       customer AS customer_id, store AS store_id FROM sold"""

# The damaged feed records: what each line's quantity or number spoils (see the query module).
REJECTED_FEED = "q IN (50, 49, 47)"

# The damaged landed records, as the gate and the loader see them.
LANDED = ALL_LINES + """,
landed AS (
  SELECT *,
    CASE WHEN q IN (50, 49, 48) THEN 'missing_fields' WHEN q = 47 THEN 'bad_date' ELSE 'valid' END
      AS status,
    CASE WHEN q = 49 THEN NULL WHEN q = 46 THEN 'retailer_9' ELSE code END AS seen_code,
    CASE WHEN q <> 44 THEN p_name END AS seen_name,
    CASE WHEN q = 43 THEN '' ELSE category END AS seen_category,
    CASE WHEN q <> 45 THEN q END AS seen_quantity,
    CASE WHEN q = 42 THEN '' ELSE customer END AS seen_customer
  FROM sold
),
loadable AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
      PARTITION BY l_orderkey, l_partkey, retailer
      ORDER BY day, code, l_orderkey, l_linenumber, l_suppkey, cents, q) AS rn
    FROM landed WHERE status = 'valid' AND q NOT IN (46, 45, 44)
  ) WHERE rn = 1
)"""


def landed(body: str) -> str:
    return f"WITH {LANDED} {body}"


MISSING_TEXT = """'Record ' || l_linenumber || ': Missing required fields: [' ||
  CASE q WHEN 50 THEN '''unit_price''' WHEN 49 THEN '''retailer_id'''
    ELSE '''transaction_date'', ''transaction_id''' END || ']'"""

ERROR_TEXT = f"""CASE WHEN q >= 48 THEN {MISSING_TEXT} ELSE 'Record ' || l_linenumber || ': ' ||
  CASE q WHEN 47 THEN 'Unreadable transaction_date' WHEN 46 THEN 'Unknown retailer retailer_9'
    WHEN 45 THEN 'No value for quantity' ELSE 'No value for product_name' END END"""

LAST_PRODUCT = """
SELECT product_sku, product_name, category FROM (
  SELECT sku AS product_sku, seen_name AS product_name, seen_category AS category,
    row_number() OVER (PARTITION BY sku ORDER BY day DESC, code DESC, l_orderkey DESC,
      l_linenumber DESC, l_suppkey DESC, cents DESC, q DESC) AS rn
  FROM landed WHERE status = 'valid' AND seen_name IS NOT NULL) WHERE rn = 1"""


# Analytics ---------------------------------------------------------------------------------


def summary(where: str) -> str:
    return star(
        f"""SELECT COUNT(DISTINCT transaction_id) AS total_transactions,
        COUNT(*) AS total_line_items, CAST(SUM(quantity) AS BIGINT) AS total_quantity,
        SUM(total_amount) AS total_revenue, {avg("total_amount")} AS avg_transaction_amount,
        MIN(total_amount) AS min_transaction_amount, MAX(total_amount) AS max_transaction_amount,
        COUNT(DISTINCT product_id) AS unique_products,
        COUNT(DISTINCT customer_id) AS unique_customers,
        COUNT(DISTINCT store_id) AS unique_stores FROM fs WHERE {where}""",
        "total_transactions, total_line_items, total_quantity, total_revenue, "
        "avg_transaction_amount, min_transaction_amount, max_transaction_amount, "
        "unique_products, unique_customers, unique_stores",
    )


def top(where: str, n: int) -> str:
    return f"""SELECT product_id, product_sku, product_name, category,
        SUM(total_amount) AS total_revenue, CAST(SUM(quantity) AS BIGINT) AS total_quantity_sold,
        COUNT(*) AS transaction_count, {avg("unit_price")} AS avg_unit_price
        FROM fs WHERE {where} GROUP BY product_id, product_sku, product_name, category
        ORDER BY SUM(total_amount) DESC, product_sku LIMIT {n}"""


TOP = ("product_id, product_sku, product_name, category, total_revenue, total_quantity_sold, "
       "transaction_count, avg_unit_price")


def trends(label: str, keys: str, where: str = "true") -> str:
    return f"""SELECT {label} AS period_label, MIN(date) AS period_start, MAX(date) AS period_end,
        SUM(total_amount) AS total_revenue, CAST(SUM(quantity) AS BIGINT) AS total_quantity,
        COUNT(DISTINCT transaction_id) AS transaction_count,
        {avg("total_amount")} AS avg_transaction_amount
        FROM fs WHERE {where} GROUP BY {keys}"""


TRENDS = ("period_label, period_start, period_end, total_revenue, total_quantity, "
          "transaction_count, avg_transaction_amount")
DAILY = ("CAST(date AS VARCHAR)", "date")
WEEKLY = ("year || '-W' || lpad(CAST(week AS VARCHAR), 2, '0')", "year, week")
MONTHLY = ("year || '-' || lpad(CAST(month AS VARCHAR), 2, '0')", "year, month")
QUARTERLY = ("year || '-Q' || quarter", "year, quarter")


def percent(whole: str) -> str:
    return (f"CASE WHEN ({whole}) > 0 THEN "
            f"round(CAST(SUM(total_amount) AS DOUBLE) / ({whole}) * 100, 2) ELSE 0 END")


def by_category(where: str) -> str:
    whole = f"SELECT CAST(SUM(total_amount) AS DOUBLE) FROM fs WHERE {where} AND category IS NOT NULL"
    return star(
        f"""SELECT category, SUM(total_amount) AS total_revenue,
        CAST(SUM(quantity) AS BIGINT) AS total_quantity,
        COUNT(DISTINCT transaction_id) AS transaction_count,
        COUNT(DISTINCT product_id) AS unique_products, {avg("unit_price")} AS avg_unit_price,
        {percent(whole)} AS revenue_percentage
        FROM fs WHERE {where} AND category IS NOT NULL GROUP BY category""",
        "category, total_revenue, total_quantity, transaction_count, unique_products, "
        "avg_unit_price, revenue_percentage",
    )


def performance(where: str) -> str:
    whole = f"SELECT CAST(SUM(total_amount) AS DOUBLE) FROM fs WHERE {where}"
    return f"""SELECT retailer_id, retailer_name, SUM(total_amount) AS total_revenue,
        CAST(SUM(quantity) AS BIGINT) AS total_quantity,
        COUNT(DISTINCT transaction_id) AS transaction_count,
        COUNT(DISTINCT product_id) AS unique_products,
        COUNT(DISTINCT customer_id) AS unique_customers,
        {avg("total_amount")} AS avg_transaction_amount, {percent(whole)} AS revenue_percentage
        FROM fs WHERE {where} GROUP BY retailer_id, retailer_name"""


PERFORMANCE = ("retailer_id, retailer_name, total_revenue, total_quantity, transaction_count, "
               "unique_products, unique_customers, avg_transaction_amount, revenue_percentage")

# Quality -----------------------------------------------------------------------------------

CHECKS = STAR + f""",
days AS (
  SELECT CAST(unnest(generate_series({FIRST_DAY}, {AS_OF}, INTERVAL 1 DAY)) AS DATE) AS date
),
fq AS (
  SELECT date, CASE WHEN quantity <> 47 THEN quantity END AS quantity,
    CASE WHEN quantity <> 48 THEN unit_price END AS unit_price,
    CASE WHEN quantity <> 45 THEN total_amount END AS total_amount,
    CASE WHEN quantity = 50 THEN -product_id WHEN quantity <> 49 THEN product_id END AS product_id,
    CASE WHEN quantity = 46 THEN 9 WHEN quantity <> 44 THEN retailer_id END AS retailer_id
  FROM fs
),
m AS (
  SELECT days.date, CAST(days.date AS VARCHAR) AS d, COUNT(fq.date) AS n,
    COALESCE(SUM(CASE WHEN abs(total_amount - quantity * unit_price) > 0.01 THEN 1 ELSE 0 END), 0)
      AS v,
    COUNT(fq.date) - COUNT(quantity) AS n1, COUNT(fq.date) - COUNT(unit_price) AS n2,
    COUNT(fq.date) - COUNT(total_amount) AS n3, COUNT(fq.date) - COUNT(product_id) AS n4,
    COUNT(fq.date) - COUNT(retailer_id) AS n5,
    COUNT(CASE WHEN fq.date IS NOT NULL AND (product_id IS NULL OR product_id < 0) THEN 1 END) AS o1,
    COUNT(CASE WHEN fq.date IS NOT NULL AND (retailer_id IS NULL OR retailer_id = 9) THEN 1 END) AS o2,
    datediff('day', days.date, {AS_OF}) AS age
  FROM days LEFT JOIN fq ON fq.date = days.date GROUP BY days.date
),
c1 AS (
  SELECT d AS date, 'record_count' AS check_name, n > 0 AS passed,
    'Record count check: ' || n || ' records found for ' || d AS message,
    '{{"record_count":"' || n || '","date":"' || d || '"}}' AS details FROM m
),
c2 AS (
  SELECT d AS date, 'data_completeness' AS check_name, n > 0 AND n1 + n2 + n3 + n4 + n5 = 0 AS passed,
    CASE WHEN n = 0 THEN 'No records found for ' || d ELSE
      'Data completeness check: ' || n || ' records, ' || CASE WHEN n1 + n2 + n3 + n4 + n5 = 0
        THEN 'No null values in critical fields'
        ELSE 'Found nulls - quantity: ' || n1 || ', unit_price: ' || n2 || ', total_amount: ' || n3 ||
          ', product_id: ' || n4 || ', retailer_id: ' || n5 END END AS message,
    CASE WHEN n = 0 THEN '{{"total_records":"0"}}' ELSE '{{"total_records":"' || n ||
      '","null_quantity":"' || n1 || '","null_unit_price":"' || n2 || '","null_total_amount":"' || n3 ||
      '","null_product_id":"' || n4 || '","null_retailer_id":"' || n5 || '"}}' END AS details FROM m
),
c3 AS (
  SELECT d AS date, 'business_rules' AS check_name, n > 0 AND v = 0 AS passed,
    CASE WHEN n = 0 THEN 'No records found for ' || d ELSE
      'Business rules check: ' || n || ' records, ' || v || ' violations found' ||
      CASE WHEN v > 0 THEN ' (total_amount != quantity * unit_price)' ELSE '' END END AS message,
    CASE WHEN n = 0 THEN '{{"total_records":"0"}}' ELSE '{{"total_records":"' || n ||
      '","rule_violations":"' || v || '"}}' END AS details FROM m
),
c4 AS (
  SELECT d AS date, 'referential_integrity' AS check_name, n > 0 AND o1 + o2 = 0 AS passed,
    CASE WHEN n = 0 THEN 'No records found for ' || d ELSE
      'Referential integrity check: ' || n || ' records' || CASE WHEN o1 + o2 = 0
        THEN ', All foreign keys valid'
        ELSE ', Found orphaned records - product: ' || o1 || ', retailer: ' || o2 END END AS message,
    CASE WHEN n = 0 THEN '{{"total_records":"0"}}' ELSE '{{"total_records":"' || n ||
      '","orphaned_product":"' || o1 || '","orphaned_retailer":"' || o2 || '"}}' END AS details FROM m
),
c5 AS (
  SELECT d AS date, 'data_freshness' AS check_name, age <= 7 AS passed,
    'Data freshness check: Data is ' || age || ' days old' ||
      CASE WHEN age > 7 THEN ' (exceeds maximum of 7 days)' ELSE '' END AS message,
    '{{"target_date":"' || d || '","days_old":"' || age || '","max_days_old":"7"}}' AS details
  FROM m
)"""
ALL_CHECKS = " UNION ALL ".join(f"SELECT * FROM c{i}" for i in range(1, 6))

QUALITY = """SELECT COUNT(*) AS n, COUNT(customer_id) AS with_customer,
    COUNT(store_id) AS with_store, COUNT(DISTINCT transaction_id) AS txns,
    COUNT(DISTINCT (transaction_id, product_id, retailer_id)) AS keys,
    COUNT(CASE WHEN total_amount IS NULL OR total_amount = 0 THEN 1 END) AS zero_amounts,
    COUNT(CASE WHEN total_amount < 0 THEN 1 END) AS negative_amounts,
    COUNT(CASE WHEN quantity <= 0 THEN 1 END) AS zero_quantities FROM fs"""


def pct(part: str) -> str:
    return f"round({part} * 100.0 / n, 2)"


SUMMARY_ROWS = (
    ("total_records", "n", "CAST(NULL AS DOUBLE)"),
    ("records_with_customer", "with_customer", pct("with_customer")),
    ("records_with_store", "with_store", pct("with_store")),
    ("unique_transactions", "txns", "CAST(NULL AS DOUBLE)"),
    ("null_or_zero_amounts", "zero_amounts", pct("zero_amounts")),
    ("negative_amounts", "negative_amounts", pct("negative_amounts")),
    ("zero_quantities", "zero_quantities", pct("zero_quantities")),
)

VIEW_NAMES = (
    ("mv_daily_sales_summary", "mv1", MV1),
    ("mv_monthly_sales_by_category", "mv2", MV2),
    ("mv_top_products_by_revenue", "mv3", MV3),
    ("mv_weekly_sales_trends", "mv4", MV4),
    ("mv_quarterly_sales_summary", "mv5", MV5),
    ("mv_daily_sales_by_product", "mv6", MV6),
)


def quality_row(where: str) -> str:
    return f"""WITH {STAR} SELECT n AS total_records,
        with_customer AS records_with_customer, {pct("with_customer")} AS customer_percentage,
        with_store AS records_with_store, {pct("with_store")} AS store_percentage,
        txns AS unique_transactions, n - keys AS potential_duplicates,
        zero_amounts AS null_or_zero_amounts, negative_amounts, zero_quantities
        FROM ({QUALITY} WHERE {where})"""


def quality_rows(where: str) -> str:
    return f"WITH {STAR}, s AS ({QUALITY} WHERE {where}) " + " UNION ALL ".join(
        f"SELECT '{name}' AS metric_name, {value} AS metric_value, "
        f"CAST({share} AS DOUBLE) AS metric_percentage FROM s"
        for name, value, share in SUMMARY_ROWS
    )


def last(days: int) -> str:
    return f"date BETWEEN {AS_OF} - {days} AND {AS_OF}"


def per_view(columns: str) -> str:
    parts = [
        f"SELECT '{name}' AS view_name, "
        + columns.replace("$LIST", f"'{listing}'")
        + f" FROM {table}"
        for name, table, listing in VIEW_NAMES
    ]
    return f"WITH {VIEWS} " + " UNION ALL ".join(parts)


TOP_ROLLUP = "SELECT * FROM mv3 ORDER BY total_revenue DESC, product_sku, retailer_id"
YEAR = f"year = year({AS_OF})"
LAST_YEAR = f"{YEAR} - 1"
MONTH_RANGE = (f"make_date(year, month, 1) BETWEEN {FIRST_DAY} AND {AS_OF}")
COMPARISON = f"""SELECT retailer_name, COUNT(DISTINCT date) AS days_active,
    SUM(total_revenue) AS total_revenue,
    CAST(SUM(transaction_count) AS BIGINT) AS total_transactions,
    {avg("total_revenue")} AS avg_daily_revenue, MAX(total_revenue) AS max_daily_revenue
    FROM mv1 WHERE date >= {AS_OF} - 30 GROUP BY retailer_name"""
CATEGORY_TOP = f"""SELECT category, retailer_name, SUM(total_revenue) AS total_revenue
    FROM mv2 WHERE {YEAR} GROUP BY category, retailer_name HAVING SUM(total_revenue) > 0
    ORDER BY SUM(total_revenue) DESC, category, retailer_name LIMIT 15"""


def pivoted(key: str, source: str, fill: str = "NULL") -> str:
    cells = ", ".join(
        f"COALESCE(SUM(CASE WHEN retailer_name = 'Retailer {i}' THEN total_revenue END), {fill})"
        f' AS "Retailer {i}"'
        for i in (1, 2, 3)
    )
    return f"SELECT {key}, {cells} FROM ({source}) GROUP BY {key}"


PIVOT = ", Retailer 1, Retailer 2, Retailer 3"

ORACLE: dict[str, str] = {
    # sources and landing
    "scan_source_1": sold(SCAN[1]),
    "scan_source_2": sold(SCAN[2]),
    "scan_source_3": sold(SCAN[3]),
    "source_defaults": sold("""
        SELECT source, column_name, CAST(value AS DOUBLE) AS value, COUNT(*) AS rows FROM (
          SELECT 'retailer_1' AS source, 'discount_percentage' AS column_name,
            CASE WHEN l_linenumber > 2 THEN l_linenumber ELSE 0 END AS value
            FROM sold WHERE retailer = 1
          UNION ALL SELECT 'retailer_2', 'tax_amount',
            CASE WHEN l_linenumber <> 3 THEN l_linenumber ELSE 0 END FROM sold WHERE retailer = 2
          UNION ALL SELECT 'retailer_2', 'loyalty_points_earned',
            CASE WHEN l_linenumber > 1 THEN q ELSE 0 END FROM sold WHERE retailer = 2
          UNION ALL SELECT 'retailer_3', 'shipping_cost',
            CASE WHEN l_linenumber < 5 THEN l_linenumber ELSE 0 END FROM sold WHERE retailer = 3
          UNION ALL SELECT 'retailer_3', 'warranty_months',
            CASE WHEN l_linenumber % 2 = 1 THEN l_linenumber * 6 ELSE 0 END
            FROM sold WHERE retailer = 3
          UNION ALL SELECT 'retailer_3', 'return_policy_days',
            CASE WHEN l_linenumber = 2 THEN 60 ELSE 30 END FROM sold WHERE retailer = 3
        ) GROUP BY source, column_name, value"""),
    "source_row_counts": sold("""
        SELECT CASE retailer WHEN 1 THEN 'sales' WHEN 2 THEN 'transactions' ELSE 'purchases' END
          AS source, COUNT(*) AS row_count FROM sold GROUP BY retailer"""),
    "source_insert_if_absent": sold("""
        SELECT order_id, sku, quantity, total, added FROM (
          SELECT txn AS order_id, sku, q AS quantity, CAST(total AS DOUBLE) AS total,
            day >= DATE '1998-06-01' AS added,
            row_number() OVER (PARTITION BY l_orderkey
              ORDER BY sku, l_linenumber, l_suppkey, cents, q) AS rn
          FROM sold WHERE retailer = 1) WHERE rn = 1"""),
    "landing_roundtrip": sold("""
        SELECT CASE WHEN q = 46 THEN 'retailer_9' ELSE code END AS retailer_id,
          txn AS transaction_id, sku AS product_id,
          CASE WHEN q <> 44 THEN p_name END AS product_name, category,
          CASE WHEN q <> 45 THEN q END AS quantity, CAST(price AS DOUBLE) AS unit_price,
          CAST(total AS DOUBLE) AS total_amount,
          CASE WHEN q <> 47 THEN stamp END AS transaction_date,
          CASE WHEN q = 42 THEN '' ELSE customer END AS customer_id, store AS store_id,
          CASE WHEN q = 47 THEN 'bad_date' ELSE 'valid' END AS status FROM sold"""),
    "landing_parse_arrays": sold("""
        SELECT code AS retailer, CAST(last_day(day) AS VARCHAR) AS file_date,
          CASE WHEN q = 47 THEN 'bad_date' ELSE 'valid' END AS status,
          COUNT(*) AS records, CAST(SUM(CASE WHEN q <> 45 THEN q END) AS BIGINT) AS quantity
        FROM sold GROUP BY 1, 2, 3
        UNION ALL SELECT DISTINCT code, CAST(last_day(day) AS VARCHAR), 'unreadable', 1, NULL
        FROM sold WHERE retailer = 2"""),
    "landing_rejected_files": sold("""
        SELECT DISTINCT code AS retailer, CAST(last_day(day) AS VARCHAR) AS file_date,
          CASE month(day) WHEN 2 THEN 'not JSON' ELSE 'no records' END AS reason
        FROM sold WHERE retailer <> 2 AND month(day) IN (2, 3)"""),
    "landing_scan_day": sold("""
        SELECT code AS retailer, CAST(ceil(COUNT(*) / 100000) AS BIGINT) AS files, true AS has_data
        FROM sold WHERE last_day(day) = DATE '2001-08-31' GROUP BY code"""),
    "landing_parse": sold("""
        SELECT code AS retailer, field, COUNT(*) AS present, COUNT(value) AS with_value FROM (
          SELECT code, 'retailer_id' AS field, code AS value FROM sold
          UNION ALL SELECT code, 'transaction_id', txn FROM sold
          UNION ALL SELECT code, 'product_id', sku FROM sold
          UNION ALL SELECT code, 'product_name', CASE WHEN q <> 44 THEN p_name END FROM sold
          UNION ALL SELECT code, 'category', category FROM sold
          UNION ALL SELECT code, 'quantity', CASE WHEN q <> 45 THEN CAST(q AS VARCHAR) END FROM sold
          UNION ALL SELECT code, 'unit_price', CAST(price AS VARCHAR) FROM sold
          UNION ALL SELECT code, 'total_amount', CAST(total AS VARCHAR) FROM sold
          UNION ALL SELECT code, 'transaction_date', iso FROM sold
          UNION ALL SELECT code, 'customer_id', CASE WHEN q = 42 THEN '' ELSE customer END FROM sold
          UNION ALL SELECT code, 'store_id', store FROM sold
        ) GROUP BY code, field"""),
    "path_partition_values": sold("""
        SELECT code AS retailer, CAST(last_day(day) AS VARCHAR) AS file_date, COUNT(*) AS records
        FROM sold GROUP BY code, last_day(day)"""),
    "processed_zone": landed("""
        SELECT code AS retailer, CAST(last_day(day) AS VARCHAR) AS file_date, COUNT(*) AS records,
          COUNT(seen_quantity) AS with_quantity
        FROM landed WHERE status <> 'missing_fields' GROUP BY code, last_day(day)"""),
    "landing_inventory": sold("""
        SELECT code AS retailer, CAST(SUM(ceil(n / 100000)) AS BIGINT) AS files,
          CAST(SUM(n) AS BIGINT) AS records, true AS all_filled, 'category,customer_id,product_id,product_name,quantity,retailer_id,'
          || 'store_id,total_amount,transaction_date,transaction_id,unit_price' AS record_keys
        FROM (SELECT code, COUNT(*) AS n FROM sold GROUP BY code, last_day(day)) GROUP BY code"""),
    "landing_external_table": sold("""
        SELECT code AS retailer, strftime(day, '%Y') AS year, COUNT(*) AS records, 0 AS unreadable,
          CAST(SUM(CASE WHEN q <> 45 THEN q END) AS BIGINT) AS quantity,
          CAST(SUM(CASE WHEN q = 47 THEN 1 ELSE 0 END) AS BIGINT) AS bad_dates
        FROM sold GROUP BY 1, 2"""),
    "export_daily_summary": views("SELECT * FROM mv1 WHERE date >= DATE '1996-01-01'", MV1),
    # normalise and validate
    "normalize_source_1": sold(f"{RECORDS} WHERE retailer = 1"),
    "normalize_source_2": sold(f"{RECORDS} WHERE retailer = 2"),
    "normalize_source_3": sold(f"{RECORDS} WHERE retailer = 3"),
    "union_sources": sold(RECORDS),
    "normalize_defaults": sold(f"""
        SELECT code AS retailer_id, CASE WHEN q = 46 THEN 'None' ELSE txn END AS transaction_id,
          sku AS product_id, p_name AS product_name,
          CASE WHEN q = 45 AND l_linenumber <> 7 THEN '' ELSE category END AS category,
          q AS quantity, CAST(price AS DOUBLE) AS unit_price,
          CASE WHEN l_linenumber = 7 THEN 0 ELSE CAST(total AS DOUBLE) END AS total_amount,
          CASE WHEN q = 48 AND l_linenumber <> 7 THEN '2001-08-01 12:00:00' ELSE stamp END
            AS transaction_date,
          customer AS customer_id, store AS store_id
        FROM sold WHERE NOT ({REJECTED_FEED})"""),
    "normalize_rejects": sold(f"""
        SELECT code AS retailer_id, txn AS transaction_id, sku AS product_id,
          p_name AS product_name, category, customer AS customer_id, store AS store_id
        FROM sold WHERE {REJECTED_FEED}"""),
    "serialize_record": sold("""
        SELECT '{"retailer_id":"' || code || '","transaction_id":"' || txn || '","product_id":"' ||
          sku || '","product_name":"' || p_name || '","category":' ||
          COALESCE('"' || category || '"', 'null') || ',"quantity":' || q || ',"unit_price":' ||
          CAST(price AS VARCHAR) || ',"total_amount":' || CAST(total AS VARCHAR) ||
          ',"transaction_date":"' || iso || '","customer_id":' ||
          COALESCE('"' || customer || '"', 'null') || ',"store_id":' ||
          COALESCE('"' || store || '"', 'null') || ',"raw_data":{"part":"' || sku || '","customer":' ||
          COALESCE('"' || customer || '"', 'null') || '}}' AS value FROM sold"""),
    "required_fields_gate": landed("""
        SELECT code AS retailer, status <> 'missing_fields' AS complete, COUNT(*) AS records
        FROM landed GROUP BY code, status <> 'missing_fields'"""),
    "missing_field_errors": landed(f"""
        SELECT sku AS product_id, {MISSING_TEXT} AS error
        FROM landed WHERE status = 'missing_fields'"""),
    "load_errors": landed(f"""
        SELECT {ERROR_TEXT} AS error FROM landed WHERE q BETWEEN 44 AND 50
        ORDER BY day, code, l_orderkey, l_linenumber, l_suppkey, cents, q LIMIT 10"""),
    "record_errors": landed(f"""
        SELECT sku AS product_id, {ERROR_TEXT} AS error FROM landed WHERE q BETWEEN 44 AND 50"""),
    "unknown_retailer_rejects": landed("""
        SELECT seen_code AS retailer_id, txn AS transaction_id, sku AS product_id, q AS quantity
        FROM landed WHERE q = 46"""),
    "bad_date_rejects": landed("""
        SELECT code AS retailer_id, txn AS transaction_id, sku AS product_id, q AS quantity
        FROM landed WHERE q = 47"""),
    # dimensions and facts
    "dim_date": landed("""
        SELECT DISTINCT CAST(strftime(day, '%Y%m%d') AS INTEGER) AS date_id,
          CAST(day AS VARCHAR) AS date, CAST(year(day) AS INTEGER) AS year,
          CAST(quarter(day) AS INTEGER) AS quarter, CAST(month(day) AS INTEGER) AS month,
          CAST(weekofyear(day) AS INTEGER) AS week, CAST(dayofmonth(day) AS INTEGER) AS day,
          CAST(isodow(day) AS INTEGER) AS day_of_week, dayname(day) AS day_name,
          isodow(day) >= 6 AS is_weekend
        FROM landed WHERE status = 'valid'"""),
    "dim_product": landed(LAST_PRODUCT),
    "dim_product_scd1": sold("""
        SELECT sku AS product_sku,
          CASE WHEN MAX(day) >= DATE '1998-06-01' THEN p_name || ' v2' ELSE p_name END
            AS product_name, category,
          CASE WHEN MIN(day) < DATE '1998-06-01' THEN '1998-06-01 02:00:00'
            ELSE '2001-08-02 02:00:00' END AS created_at,
          CASE WHEN MAX(day) < DATE '1998-06-01' THEN '1998-06-01 02:00:00'
            ELSE '2001-08-02 02:00:00' END AS updated_at
        FROM sold GROUP BY sku, p_name, category"""),
    "dim_customer": landed("""
        SELECT DISTINCT seen_customer AS customer_external_id FROM landed
        WHERE status = 'valid' AND seen_name IS NOT NULL AND seen_customer <> ''"""),
    "dim_store": landed("""
        SELECT DISTINCT store AS store_external_id FROM landed
        WHERE status = 'valid' AND seen_name IS NOT NULL AND store IS NOT NULL"""),
    "dim_surrogate_keys": landed("""
        SELECT dimension, COUNT(DISTINCT key) AS members, COUNT(DISTINCT key) AS keys, true AS above_zero, 0 AS changed
        FROM (
          SELECT 'product' AS dimension, sku AS key FROM landed WHERE status = 'valid' AND seen_name IS NOT NULL
          UNION ALL SELECT 'customer', seen_customer FROM landed
            WHERE status = 'valid' AND seen_name IS NOT NULL AND seen_customer <> ''
          UNION ALL SELECT 'store', store FROM landed
            WHERE status = 'valid' AND seen_name IS NOT NULL AND store IS NOT NULL)
        GROUP BY dimension"""),
    "dim_retailer": """
        SELECT * FROM (VALUES (1, 'retailer_1', 'Retailer 1'), (2, 'retailer_2', 'Retailer 2'),
          (3, 'retailer_3', 'Retailer 3')) AS t(retailer_id, retailer_code, retailer_name)""",
    "fact_sales": landed("""
        SELECT CAST(day AS VARCHAR) AS date, sku AS product_sku,
          CASE WHEN seen_customer <> '' THEN seen_customer END AS customer_external_id,
          store AS store_external_id, code AS retailer_code, txn AS transaction_id,
          q AS quantity, CAST(price AS DOUBLE) AS unit_price, CAST(total AS DOUBLE) AS total_amount
        FROM loadable"""),
    "fact_dedupe": star(
        """SELECT *, CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_id FROM fs""",
        "date_id, product_id, customer_id, store_id, retailer_id, transaction_id, quantity, "
        "unit_price, total_amount",
    ),
    "fact_idempotent_reload": landed("""
        SELECT COUNT(*) AS facts_before, CAST(0 AS BIGINT) AS inserted FROM loadable"""),
    "load_counters": landed("""
        SELECT * FROM (
          SELECT outcome, COUNT(*) AS records FROM (
            SELECT CASE WHEN status <> 'valid' THEN status WHEN q = 46 THEN 'unknown_retailer'
              WHEN q IN (45, 44) THEN 'constraint' END AS outcome FROM landed)
          WHERE outcome IS NOT NULL GROUP BY outcome
          UNION ALL SELECT 'inserted', COUNT(*) FROM loadable
          UNION ALL SELECT 'duplicate', (SELECT COUNT(*) FROM landed WHERE status = 'valid'
            AND q NOT IN (46, 45, 44)) - COUNT(*) FROM loadable
        ) WHERE records > 0"""),
    "fact_constraint_rejects": landed("""
        SELECT seen_code AS retailer_id, txn AS transaction_id, sku AS product_id,
          seen_name AS product_name, seen_quantity AS quantity
        FROM landed WHERE q IN (45, 44)"""),
    "process_date_summary": landed("""
        SELECT code AS retailer, CAST(ceil(COUNT(*) / 100000) AS BIGINT) AS files_found,
          CAST(ceil(COUNT(*) / 100000) AS BIGINT) AS files_processed, COUNT(*) AS records_found,
          (SELECT COUNT(*) FROM loadable
           WHERE last_day(day) = DATE '2001-08-31' AND loadable.code = landed.code)
            AS records_loaded
        FROM landed WHERE last_day(day) = DATE '2001-08-31' GROUP BY code"""),
    "sales_enriched": star(
        """SELECT *, CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_id,
          CAST(isodow(date) AS INTEGER) AS day_of_week, dayname(date) AS day_name,
          isodow(date) >= 6 AS is_weekend, CAST(customer_id AS VARCHAR) AS customer_external_id,
          CAST(store_id AS VARCHAR) AS store_external_id FROM fs""",
        "date_id, product_id, customer_id, store_id, retailer_id, transaction_id, quantity, "
        "unit_price, total_amount, date, year, quarter, month, week, day, day_of_week, day_name, "
        "is_weekend, product_sku, product_name, category, retailer_code, retailer_name, "
        "customer_external_id, store_external_id",
    ),
    # rollups
    "daily_sales_summary": views("SELECT * FROM mv1", MV1),
    "monthly_sales_by_category": views("SELECT * FROM mv2", MV2),
    "top_products_by_revenue": views("SELECT * FROM mv3", MV3),
    "weekly_sales_trends": views("SELECT * FROM mv4", MV4),
    "quarterly_sales_summary": views("SELECT * FROM mv5", MV5),
    "daily_sales_by_product": views("SELECT * FROM mv6", MV6),
    "refresh_one": views("SELECT * FROM mv4", MV4),
    "refresh_all_status": per_view(
        "true AS successful, COUNT(*) AS row_count, CAST(SUM(total_revenue) AS DOUBLE) AS total_revenue"
    ),
    "refresh_together_status": per_view(
        "true AS successful, COUNT(*) AS row_count, CAST(SUM(total_revenue) AS DOUBLE) AS total_revenue"
    ),
    "touched_daily_sales_summary": views("SELECT * FROM mv1", MV1),
    "touched_monthly_sales_by_category": views("SELECT * FROM mv2", MV2),
    "touched_top_products_by_revenue": views("SELECT * FROM mv3", MV3),
    "touched_weekly_sales_trends": views("SELECT * FROM mv4", MV4),
    "touched_quarterly_sales_summary": views("SELECT * FROM mv5", MV5),
    "touched_daily_sales_by_product": views("SELECT * FROM mv6", MV6),
    "touched_sales_summary": summary("true"),
    "touched_status": per_view(
        "true AS successful, COUNT(*) AS row_count, CAST(SUM(total_revenue) AS DOUBLE) AS total_revenue"
    ),
    "view_info": per_view('true AS "exists", COUNT(*) AS row_count'),
    "verify_views": per_view(
        'true AS "exists", COUNT(*) AS row_count, COUNT(*) > 0 AS has_data, true AS queryable, '
        "$LIST AS columns, CAST(NULL AS VARCHAR) AS issue"
    ),
    "view_row_counts": per_view("COUNT(*) AS row_count"),
    # parameterised analytics
    "sales_summary": summary("true"),
    "sales_summary_retailer": summary("retailer_id = 2"),
    "top_products": star(top("true", 10), TOP),
    "top_products_retailer": star(top("retailer_id = 3", 25), TOP),
    "sales_trends_daily": star(trends(*DAILY), TRENDS),
    "sales_trends_weekly": star(trends(*WEEKLY), TRENDS),
    "sales_trends_monthly": star(trends(*MONTHLY), TRENDS),
    "sales_trends_quarterly": star(trends(*QUARTERLY), TRENDS),
    "sales_trends_retailer": star(trends(*WEEKLY, "retailer_id = 1"), TRENDS),
    "sales_by_category": by_category("true"),
    "sales_by_category_retailer": by_category("retailer_id = 1"),
    "retailer_performance": star(performance("true"), PERFORMANCE),
    "sales_summary_30d": summary(last(30)),
    "top_products_90d": star(top(last(90), 20), TOP),
    "sales_trends_90d": star(trends(*WEEKLY, last(90)), TRENDS),
    "sales_by_category_90d": by_category(last(90)),
    "retailer_performance_30d": star(performance(last(30)), PERFORMANCE),
    "dq_report_30d": quality_row(last(30)),
    "dq_summary_30d": quality_rows(last(30)),
    "recent_sales": star(
        f"""SELECT date, SUM(total_amount) AS total_revenue,
        CAST(SUM(quantity) AS BIGINT) AS total_quantity,
        COUNT(DISTINCT transaction_id) AS transaction_count,
        {avg("total_amount")} AS avg_transaction_amount
        FROM fs WHERE date >= {AS_OF} - 6 GROUP BY date""",
        "date, total_revenue, total_quantity, transaction_count, avg_transaction_amount",
    ),
    "database_statistics": star(
        """SELECT COUNT(*) AS total_sales_records, MIN(date) AS date_range_start,
        MAX(date) AS date_range_end, SUM(total_amount) AS total_revenue,
        COUNT(DISTINCT product_id) AS total_products,
        COUNT(DISTINCT customer_id) AS total_customers, COUNT(DISTINCT store_id) AS total_stores,
        CAST(3 AS BIGINT) AS total_retailers FROM fs""",
        "total_sales_records, date_range_start, date_range_end, total_revenue, total_products, "
        "total_customers, total_stores, total_retailers",
    ),
    # quality
    "dq_record_count": f"WITH {CHECKS} SELECT * FROM c1",
    "dq_completeness": f"WITH {CHECKS} SELECT * FROM c2",
    "dq_business_rules": f"WITH {CHECKS} SELECT * FROM c3",
    "dq_referential_integrity": f"WITH {CHECKS} SELECT * FROM c4",
    "dq_freshness": f"""WITH {CHECKS}, newest AS (
      SELECT d, CAST(max(CASE WHEN n > 0 THEN date END) OVER (ORDER BY date) AS VARCHAR) AS latest FROM m)
      SELECT c5.* REPLACE (details[:-2] || ',"latest_date":' ||
        CASE WHEN latest IS NULL THEN 'null' ELSE '"' || latest || '"' END || '}}' AS details)
      FROM c5 JOIN newest ON c5.date = newest.d""",
    "dq_latest_by_retailer": star(
        f"""SELECT retailer_name, MAX(date) AS latest_date,
        CAST(datediff('day', MAX(date), {AS_OF}) AS INTEGER) AS days_old,
        datediff('day', MAX(date), {AS_OF}) <= 7 AS passed FROM fs GROUP BY retailer_name""",
        "retailer_name, latest_date, days_old, passed",
    ),
    "dq_run_all": f"WITH {CHECKS} {ALL_CHECKS}",
    "dq_run_summary": f"""WITH {CHECKS} SELECT date, COUNT(*) AS total_checks,
        COUNT(CASE WHEN passed THEN 1 END) AS passed_checks,
        COUNT(CASE WHEN NOT passed THEN 1 END) AS failed_checks, bool_and(passed) AS all_passed
        FROM ({ALL_CHECKS}) GROUP BY date""",
    "dq_report": quality_row("true"),
    "dq_summary": quality_rows("true"),
    # example reports
    "rpt_daily_dashboard": views(
        f"""SELECT * FROM mv1 WHERE date >= {AS_OF} - 7
        ORDER BY date DESC, total_revenue DESC, retailer_name LIMIT 20""",
        "date, retailer_name, total_revenue, transaction_count, total_quantity, avg_unit_price",
    ),
    "rpt_top_products": views(
        f"{TOP_ROLLUP} LIMIT 10",
        "product_name, category, retailer_name, total_revenue, total_quantity_sold, "
        "avg_unit_price",
    ),
    "rpt_category_performance": views(
        f"""SELECT * FROM mv2 WHERE {YEAR} ORDER BY year DESC, month DESC, total_revenue DESC,
        category, retailer_name LIMIT 20""",
        "year, month, category, retailer_name, total_revenue, unique_products, avg_unit_price",
    ),
    "rpt_weekly_trends": views(
        f"""SELECT * FROM mv4 WHERE {YEAR} ORDER BY year DESC, week DESC, quarter, retailer_name
        LIMIT 10""",
        "year, week, retailer_name, total_revenue, avg_transaction_amount, days_with_sales, "
        "week_start_date, week_end_date",
    ),
    "rpt_quarterly_summary": views(
        f"SELECT * FROM mv5 WHERE {YEAR}",
        "retailer_name, year, quarter, total_revenue, unique_products, transaction_count, "
        "avg_transaction_amount",
    ),
    "rpt_top_product_trends": views(
        f"""SELECT mv6.date, t.product_name, mv6.retailer_name, mv6.total_revenue,
        mv6.total_quantity_sold, mv6.avg_unit_price
        FROM mv6 JOIN ({TOP_ROLLUP} LIMIT 5) t ON mv6.product_id = t.product_id
        WHERE mv6.date >= {AS_OF} - 30
        ORDER BY mv6.date DESC, mv6.total_revenue DESC, mv6.product_sku, mv6.retailer_id,
        t.retailer_id LIMIT 20""",
        "date, product_name, retailer_name, total_revenue, total_quantity_sold, avg_unit_price",
    ),
    "rpt_retailer_comparison": views(
        COMPARISON,
        "retailer_name, days_active, total_revenue, total_transactions, avg_daily_revenue, "
        "max_daily_revenue",
    ),
    "rpt_category_growth": views(
        f"""SELECT category, retailer_name,
        SUM(CASE WHEN month <= 3 THEN total_revenue ELSE 0 END) AS q1_revenue,
        SUM(CASE WHEN month > 3 AND month <= 6 THEN total_revenue ELSE 0 END) AS q2_revenue,
        SUM(CASE WHEN month > 6 AND month <= 9 THEN total_revenue ELSE 0 END) AS q3_revenue,
        SUM(CASE WHEN month > 9 THEN total_revenue ELSE 0 END) AS q4_revenue,
        SUM(total_revenue) AS total_revenue
        FROM mv2 WHERE {YEAR} GROUP BY category, retailer_name HAVING SUM(total_revenue) > 0
        ORDER BY SUM(total_revenue) DESC, category, retailer_name LIMIT 15""",
        "category, retailer_name, q1_revenue, q2_revenue, q3_revenue, q4_revenue, total_revenue",
    ),
    # charts
    "chart_daily_pivot": views(
        pivoted("date", f"SELECT * FROM mv1 WHERE date >= {AS_OF} - 30"), "date" + PIVOT
    ),
    "chart_top_products": views(
        f"""SELECT *, CASE WHEN length(product_name) > 30
        THEN substr(product_name, 1, 30) || '...' ELSE product_name END AS product_name_short
        FROM ({TOP_ROLLUP} LIMIT 10)""",
        "product_name, total_revenue, retailer_name, product_name_short",
    ),
    "chart_category_pivot": views(pivoted("category", CATEGORY_TOP, "0"), "category" + PIVOT),
    "chart_weekly_pivot": views(
        pivoted("week", f"SELECT * FROM mv4 WHERE {YEAR}"), "week" + PIVOT
    ),
    "chart_retailer_comparison": views(
        COMPARISON, "retailer_name, total_revenue, total_transactions, avg_daily_revenue"
    ),
    # panels
    "panel_daily_revenue": views(
        "SELECT *, date AS time FROM mv1", "time, retailer_name, total_revenue"
    ),
    "panel_daily_txn": views(
        "SELECT *, date AS time FROM mv1", "time, retailer_name, transaction_count"
    ),
    "panel_retailer_7d": star(
        f"SELECT *, total_revenue AS revenue FROM "
        f"({performance(f'date BETWEEN {AS_OF} - 7 AND {AS_OF}')})",
        "retailer_name, revenue",
    ),
    "panel_today": star(performance(f"date = {AS_OF}"), "retailer_name, total_revenue"),
    "panel_top_revenue": star(top("true", 10), "product_name, total_revenue"),
    "panel_top_quantity": star(top("true", 10), "product_name, total_quantity_sold"),
    "panel_category_monthly": views(
        f"""SELECT make_date(year, month, 1) AS time, category, SUM(total_revenue) AS revenue
        FROM mv2 WHERE {MONTH_RANGE} GROUP BY year, month, category""",
        "time, category, revenue",
    ),
    "panel_category_heatmap": views(
        f"""SELECT make_date(year, month, 1) AS time, category, SUM(total_revenue) AS revenue
        FROM mv2 WHERE {MONTH_RANGE} GROUP BY year, month, category""",
        "category, time, revenue",
    ),
    "panel_weekly": star(
        f"SELECT period_start AS time, total_revenue FROM ({trends(*WEEKLY)})",
        "time, total_revenue",
    ),
    "panel_quarterly": star(
        f"SELECT *, period_label AS year_quarter FROM ({trends(*QUARTERLY)})",
        "year_quarter, total_revenue, transaction_count",
    ),
    # documented queries
    "doc_daily_by_retailer": star(
        """SELECT date, retailer_name, SUM(total_amount) AS total_revenue,
        COUNT(*) AS transaction_count FROM fs GROUP BY date, retailer_name""",
        "date, retailer_name, total_revenue, transaction_count",
    ),
    "doc_top_by_name": star(
        """SELECT product_name, category, SUM(total_amount) AS total_revenue,
        CAST(SUM(quantity) AS BIGINT) AS total_quantity FROM fs GROUP BY product_name, category
        ORDER BY SUM(total_amount) DESC, product_name, category NULLS LAST LIMIT 20""",
        "product_name, category, total_revenue, total_quantity",
    ),
    "doc_monthly_revenue": star(
        "SELECT year, month, SUM(total_amount) AS monthly_revenue FROM fs GROUP BY year, month",
        "year, month, monthly_revenue",
    ),
    "doc_by_retailer": star(
        """SELECT retailer_name, COUNT(*) AS record_count, SUM(total_amount) AS total_revenue
        FROM fs GROUP BY retailer_name""",
        "retailer_name, record_count, total_revenue",
    ),
    "doc_category_year": views(
        f"SELECT category, SUM(total_revenue) AS revenue FROM mv2 WHERE {YEAR} GROUP BY category",
        "category, revenue",
    ),
    "doc_daily_one_retailer": views(
        f"SELECT * FROM mv1 WHERE retailer_name = 'Retailer 1' AND date >= {FIRST_DAY}",
        "date, total_revenue, transaction_count, total_quantity",
    ),
    "doc_daily_one_sku": views(
        f"""SELECT * FROM mv6 WHERE product_sku = '77' AND retailer_name = 'Retailer 1'
        AND date >= {FIRST_DAY}""",
        "date, total_revenue, total_quantity_sold, avg_unit_price",
    ),
    "doc_average_daily_revenue": views(
        COMPARISON, "retailer_name, total_revenue, avg_daily_revenue"
    ),
    "doc_top_one_retailer": views(
        """SELECT * FROM mv3 WHERE retailer_name = 'Retailer 1'
        ORDER BY total_revenue DESC, product_sku LIMIT 10""",
        "product_name, category, total_revenue, total_quantity_sold",
    ),
    "doc_monthly_one_retailer": views(
        f"SELECT * FROM mv2 WHERE retailer_name = 'Retailer 1' AND {LAST_YEAR}",
        "year, month, category, total_revenue, unique_products",
    ),
    "doc_weekly_one_retailer": views(
        f"SELECT * FROM mv4 WHERE retailer_name = 'Retailer 1' AND {LAST_YEAR}",
        "year, week, total_revenue, avg_transaction_amount, days_with_sales",
    ),
    "doc_quarterly_year": views(
        f"SELECT * FROM mv5 WHERE {LAST_YEAR}",
        "retailer_name, year, quarter, total_revenue, unique_products",
    ),
    "doc_top_current_month": star(
        top(f"date BETWEEN date_trunc('month', {AS_OF}) AND last_day({AS_OF})", 20),
        "product_name, category, total_revenue, total_quantity_sold, transaction_count",
    ),
    "doc_retailers_last_quarter": star(
        f"""SELECT *, revenue_percentage AS market_share FROM
        ({performance(f"date >= date_trunc('quarter', {AS_OF}) - INTERVAL 3 MONTH AND date < date_trunc('quarter', {AS_OF})")})""",
        "retailer_name, total_revenue, market_share, avg_transaction_amount, unique_customers",
    ),
    "doc_top20": views(
        f"{TOP_ROLLUP} LIMIT 20", "product_name, category, total_revenue, total_quantity_sold"
    ),
    "doc_monthly_category_list": views(
        f"SELECT * FROM mv2 WHERE {YEAR}", "year, month, category, total_revenue"
    ),
    "doc_quarterly_list": views(
        "SELECT * FROM mv5", "year, quarter, retailer_name, total_revenue, transaction_count"
    ),
    "load_activity": star(
        """SELECT strftime(MAX(date) + INTERVAL 1 DAY + INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S')
        AS last_loaded, COUNT(*) AS fact_count FROM fs""",
        "last_loaded, fact_count",
    ),
    "newest_rows": star(
        """SELECT *, CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_id,
        strftime(date + INTERVAL 1 DAY + INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') AS created_at
        FROM fs ORDER BY date DESC, transaction_id, product_id, retailer_id LIMIT 10""",
        "date_id, product_id, customer_id, store_id, retailer_id, transaction_id, quantity, "
        "unit_price, total_amount, created_at",
    ),
}
