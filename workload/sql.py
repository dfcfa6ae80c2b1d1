"""The order tables read as shipments, in SQL: the other side of ``star``."""

from __future__ import annotations

from plumbline.plans.check_catalog import DELIVERY_STATUSES
from plumbline.plans.staging import STAGING_COLUMNS

_LINES = """
lines AS (
    SELECT *,
        ((date_diff('day', o_orderdate, l_shipdate) % 7) + 7) % 7 AS real_days,
        CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1
            WHEN '3-MEDIUM' THEN 2 ELSE 4 END AS scheduled_days,
        CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
        CAST(l_discount AS DECIMAL(8,4)) AS discount,
        CAST(1 AS DECIMAL(8,4)) - CAST(l_discount AS DECIMAL(8,4)) AS kept_share,
        CAST(l_tax AS DECIMAL(8,4)) - CAST(0.02 AS DECIMAL(8,4)) AS margin,
        o_orderstatus = 'P' AND l_returnflag = 'R' AS canceled
    FROM lineitem
    LEFT JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey
    LEFT JOIN part ON l_partkey = p_partkey
)"""

_STAGING = """
stg AS (
    SELECT
        l_orderkey AS order_id,
        o_custkey AS order_customer_id,
        CAST(l_linenumber AS BIGINT) AS order_item_id,
        o_orderdate AS order_date,
        l_shipdate AS ship_date,
        CAST(real_days AS BIGINT) AS days_shipping_real,
        CAST(scheduled_days AS BIGINT) AS days_shipping_scheduled,
        CASE WHEN canceled THEN 'Shipping canceled' WHEN real_days > scheduled_days
            THEN 'Late delivery' WHEN real_days = scheduled_days THEN 'Shipping on time'
            ELSE 'Advance shipping' END AS delivery_status,
        CAST(CASE WHEN real_days > scheduled_days OR canceled THEN 1 ELSE 0 END AS BIGINT)
            AS late_delivery_risk_flag,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'Same Day' WHEN '2-HIGH' THEN 'First Class'
            WHEN '3-MEDIUM' THEN 'Second Class' ELSE 'Standard Class' END AS shipping_mode,
        CASE l_returnflag WHEN 'A' THEN 'DEBIT' WHEN 'N' THEN 'PAYMENT' ELSE 'TRANSFER' END
            AS transaction_type,
        o_orderstatus AS order_status,
        price AS sales,
        CAST(price * kept_share AS DECIMAL(12,2)) AS order_item_total,
        CAST(price * kept_share * margin AS DECIMAL(12,2)) AS order_profit,
        CAST(price * kept_share * margin AS DECIMAL(12,2)) AS benefit_per_order,
        CAST(price * discount AS DECIMAL(12,2)) AS order_item_discount,
        discount AS order_item_discount_rate,
        CAST(p_retailprice AS DECIMAL(12,2)) AS order_item_product_price,
        CAST(kept_share * margin AS DECIMAL(8,4)) AS order_item_profit_ratio,
        CAST(l_quantity AS BIGINT) AS order_item_quantity,
        CAST(price * kept_share AS DECIMAL(12,2)) AS sales_per_customer,
        o_custkey AS customer_id,
        split_part(c_name, '#', 1) AS customer_first_name,
        c_name AS customer_last_name,
        lower(replace(c_name, '#', '.')) || '@mail.test' AS customer_email,
        c_mktsegment AS customer_segment,
        n_name AS customer_city,
        n_name AS customer_state,
        r_name AS customer_country,
        c_custkey || ' Main Street' AS customer_street,
        CAST(10000 + c_custkey % 90000 AS DECIMAL(10,0)) AS customer_zipcode,
        l_partkey AS product_id,
        p_name AS product_name,
        CAST(p_retailprice AS DECIMAL(12,2)) AS product_price,
        CAST(p_partkey * 0 AS BIGINT) AS product_status,
        CAST(length(p_type) * 100 + ascii(p_type) AS BIGINT) AS category_id,
        p_type AS category_name,
        CAST(split_part(p_brand, '#', 2) AS BIGINT) AS department_id,
        p_brand AS department_name,
        r_name AS market,
        n_name AS order_region,
        n_name AS order_country,
        n_name AS order_state,
        n_name AS order_city,
        CAST(n_nationkey AS DECIMAL(10,6)) AS latitude,
        CAST(-n_nationkey AS DECIMAL(10,6)) AS longitude,
        CASE WHEN real_days > scheduled_days THEN 1 ELSE 0 END AS is_late,
        l_suppkey AS supplier_id
    FROM lines
)"""

_ITEMS = """
items AS (
    SELECT *, greatest(days_shipping_real - days_shipping_scheduled, 0) AS days_late
    FROM (
        SELECT *, row_number() OVER (
            PARTITION BY order_id, order_item_id
            ORDER BY order_date NULLS FIRST, product_id NULLS FIRST, supplier_id NULLS FIRST,
                ship_date NULLS FIRST, sales NULLS FIRST, order_item_quantity NULLS FIRST,
                order_item_discount_rate NULLS FIRST, order_profit NULLS FIRST,
                transaction_type NULLS FIRST) AS row_num
        FROM stg)
    WHERE row_num = 1
)"""

_FACT = """
fact AS (
    SELECT * EXCLUDE (order_date, ship_date, row_num),
        order_date AS order_date_id, ship_date AS ship_date_id
    FROM items
)"""

_CUSTOMERS = """
customers AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (
            PARTITION BY customer_id
            ORDER BY order_date DESC NULLS LAST, order_id DESC, order_item_id DESC,
                product_id, supplier_id) AS row_num
        FROM stg)
    WHERE row_num = 1
)"""

_PRODUCTS = """
products AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (
            PARTITION BY product_id
            ORDER BY order_date DESC NULLS LAST, order_id DESC, order_item_id DESC,
                supplier_id) AS row_num
        FROM stg)
    WHERE row_num = 1
)"""

_DATES = """
dates AS (
    SELECT CAST(day AS DATE) AS date_id
    FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY))
        AS day FROM orders)
)"""


def _text_of(column: str, reading: str) -> str:
    if reading == "stamp":
        return f"strftime({column}, '%m/%d/%Y %H:%M')"
    return f"CAST({column} AS VARCHAR)"


def _raw() -> str:
    used = ",\n        ".join(
        f'{_text_of(name, reading)} AS "{raw_name}"' for name, raw_name, reading in STAGING_COLUMNS
    )
    return f"""
raw AS (
    SELECT
        {used},
        CASE WHEN customer_id % 7 = 0 THEN CAST(customer_zipcode AS VARCHAR) END
            AS "Order Zipcode",
        CAST(product_id AS VARCHAR) AS "Order Item Cardprod Id",
        'XXXXXXXXX' AS "Customer Password",
        CAST(category_id AS VARCHAR) AS "Product Category Id",
        CAST(NULL AS VARCHAR) AS "Product Description",
        'http://images.test/' || product_id AS "Product Image"
    FROM stg
)"""


_FAULTY = """
faulty AS (
    SELECT * EXCLUDE ("Order Zipcode", "Order Region")
        REPLACE (
            CASE WHEN "Order Item Id" IN ('1', '2') THEN 'pending' ELSE "Sales" END AS "Sales",
            CASE WHEN "Order Item Id" = '3' THEN '1.5' ELSE "Order Item Quantity" END
                AS "Order Item Quantity",
            CASE WHEN "Order Item Id" <> '7' THEN "shipping date (DateOrders)" END
                AS "shipping date (DateOrders)",
            '2020-02-29' AS "Order Country"),
        'by road' AS "Carrier Note"
    FROM raw
)"""


def _profile(table: str) -> str:
    return f"""
long AS (
    SELECT * FROM {table} UNPIVOT INCLUDE NULLS (value FOR column_name IN (COLUMNS(*)))
),
typed AS (
    SELECT column_name, value,
        lower(trim(value)) IN ('true', 'false', '1', '0', 'yes', 'no', 't', 'f', 'y', 'n')
            AS is_boolean,
        TRY_CAST(trim(value) AS DOUBLE) AS number,
        TRY_CAST(trim(value) AS DOUBLE) IS NULL AND (
            try_strptime(value, '%m/%d/%Y %H:%M') IS NOT NULL
            OR try_strptime(value, '%Y-%m-%d') IS NOT NULL) AS is_date
    FROM long
),
counts AS (
    SELECT column_name,
        count(*) AS row_count,
        count(*) - count(value) AS null_count,
        count(value) AS present,
        count(*) FILTER (is_boolean) AS booleans,
        count(number) AS numbers,
        count(*) FILTER (number <> floor(number)) AS fractions,
        count(*) FILTER (is_date) AS dates
    FROM typed GROUP BY column_name
),
profile AS (
    SELECT column_name, row_count, null_count,
        CASE WHEN present > 0 THEN booleans / present ELSE 0.0 END AS boolean_rate,
        CASE WHEN fractions > 0 OR present = 0 THEN 0.0 ELSE numbers / present END
            AS integer_rate,
        CASE WHEN present > 0 THEN numbers / present ELSE 0.0 END AS numeric_rate,
        CASE WHEN present = 0 OR numbers / present >= 0.5 THEN 0.0 ELSE dates / present END
            AS date_rate
    FROM counts
),
inferred AS (
    SELECT *,
        CASE WHEN row_count = null_count THEN 'string'
            WHEN boolean_rate >= 0.95 THEN 'boolean' WHEN integer_rate >= 0.95 THEN 'integer'
            WHEN numeric_rate >= 0.95 THEN 'numeric' WHEN date_rate >= 0.95 THEN 'date'
            ELSE 'string' END AS inferred_type,
        CASE WHEN row_count = null_count THEN 0.0
            WHEN boolean_rate >= 0.95 THEN boolean_rate
            WHEN integer_rate >= 0.95 THEN integer_rate
            WHEN numeric_rate >= 0.95 THEN numeric_rate
            WHEN date_rate >= 0.95 THEN date_rate ELSE 1.0 END AS confidence
    FROM profile
)"""


_STATUS_LIST = ", ".join(f"'{status}'" for status in DELIVERY_STATUSES)

# Check history: each order day is a run over that day's lines. Quantities are one less than
# delivered and full pallets have an unknown status, so that runs differ in what they fail.
_CHECK_HISTORY = f"""
daily AS (
    SELECT *, date_trunc('day', order_date_id) AS run_at
    FROM (SELECT * REPLACE (
            order_item_quantity - 1 AS order_item_quantity,
            CASE WHEN order_item_quantity = 50 THEN 'Lost' ELSE delivery_status END
                AS delivery_status)
        FROM fact)
),
daily_counts AS (
    SELECT run_at,
        count(*) FILTER (ship_date_id < order_date_id) AS assert_ship_date_after_order_date,
        count(*) FILTER (order_item_quantity <= 0) AS assert_no_negative_shipping_quantity,
        count(*) FILTER (delivery_status NOT IN ({_STATUS_LIST})) AS assert_valid_delivery_status,
        count(*) FILTER (is_late <> late_delivery_risk_flag) AS assert_late_flag_consistency,
        count(*) FILTER (order_id IS NULL) AS not_null_fact_shipments_order_id,
        count(*) FILTER (order_item_id IS NULL) AS not_null_fact_shipments_order_item_id,
        count(*) FILTER (customer_id IS NULL) AS not_null_fact_shipments_customer_id,
        count(*) FILTER (product_id IS NULL) AS not_null_fact_shipments_product_id,
        count(*) FILTER (sales IS NULL) AS not_null_fact_shipments_sales,
        count(*) FILTER (is_late IS NULL) AS not_null_fact_shipments_is_late,
        count(*) FILTER (delivery_status IS NULL) AS not_null_fact_shipments_delivery_status
    FROM daily GROUP BY run_at
),
check_history AS (
    SELECT 'run-' || strftime(run_at, '%Y-%m-%d') AS run_id, run_at, test_name,
        'fact_shipments' AS model_name,
        CASE WHEN test_name LIKE 'not_null%'
            THEN replace(test_name, 'not_null_fact_shipments_', '') ELSE '' END AS column_name,
        CASE WHEN failure_count = 0 THEN 'pass'
            WHEN test_name = 'assert_late_flag_consistency' THEN 'warn' ELSE 'fail' END AS status,
        CASE WHEN failure_count = 0 THEN 'info'
            WHEN test_name = 'assert_late_flag_consistency' THEN 'warning'
            ELSE 'critical' END AS severity,
        failure_count
    FROM (UNPIVOT daily_counts ON COLUMNS(* EXCLUDE (run_at))
        INTO NAME test_name VALUE failure_count)
)"""

# Anomaly history: each day of events is a run; "error" stands for a missing event type.
_ANOMALY_HISTORY = """
observed AS (
    UNPIVOT (
        SELECT date_trunc('day', ts) AS run_at,
            CAST(count(*) AS DOUBLE) AS row_count_anomaly,
            avg(value) AS avg_event_value,
            CAST(count(*) FILTER (event_type = 'error' OR event_type = '') AS DOUBLE)
                / count(*) AS null_rate_drift__events__event_type
        FROM events GROUP BY 1)
    ON COLUMNS(* EXCLUDE (run_at)) INTO NAME check_name VALUE observed_value
),
rolled AS (
    SELECT *, count(*) OVER past AS history_runs, avg(observed_value) OVER past AS m,
        stddev_samp(observed_value) OVER past AS s
    FROM observed
    WINDOW past AS (PARTITION BY check_name ORDER BY run_at
        ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)
),
scores AS (
    SELECT *,
        CASE WHEN history_runs < 5 THEN NULL
            WHEN s < 1e-12 THEN CASE WHEN abs(observed_value - m) / greatest(abs(m), 1e-6) < 1e-3
                THEN 0.0 ELSE 9999.0 END
            ELSE (observed_value - m) / s END AS z
    FROM rolled
),
anomaly_history AS (
    SELECT 'run-' || strftime(run_at, '%Y-%m-%d') AS run_id, run_at, check_name,
        'events' AS table_name,
        CASE check_name WHEN 'row_count_anomaly' THEN '' WHEN 'avg_event_value' THEN 'value'
            ELSE 'event_type' END AS column_name,
        CASE WHEN abs(z) > 3 THEN 'critical' WHEN abs(z) > 2 THEN 'warn' ELSE 'pass' END
            AS status,
        CASE WHEN abs(z) > 3 THEN 'critical' WHEN abs(z) > 2 THEN 'warning' ELSE 'info' END
            AS severity,
        round(observed_value, 6) AS observed_value,
        CASE WHEN history_runs >= 5 THEN round(m, 6) END AS expected_value,
        round(z, 6) AS z_score,
        history_runs
    FROM scores
)"""

_BLOCKS = {
    "stg": (_LINES, _STAGING),
    "items": (_LINES, _STAGING, _ITEMS),
    "fact": (_LINES, _STAGING, _ITEMS, _FACT),
    "customers": (_LINES, _STAGING, _CUSTOMERS),
    "products": (_LINES, _STAGING, _PRODUCTS),
    "dates": (_DATES,),
    "raw": (_LINES, _STAGING, _raw()),
    "raw_profile": (_LINES, _STAGING, _raw(), _profile("raw")),
    "faulty_profile": (_LINES, _STAGING, _raw(), _FAULTY, _profile("faulty")),
    "check_history": (_LINES, _STAGING, _ITEMS, _FACT, _CHECK_HISTORY),
    "anomaly_history": (_ANOMALY_HISTORY,),
}


def over(*needs: str, select: str) -> str:
    """``select`` with the named building blocks in front of it."""
    blocks = dict.fromkeys(block for need in needs for block in _BLOCKS[need])
    return f"WITH {','.join(blocks)}\n{select.strip()}"
