"""Deliveries, the load gate, published logs, the gate of every run and the marts of a run.

What a query delivers, loads or publishes it writes to a folder of its own, and reads from there.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.parsing import named
from plumbline.operators import alerts, health
from plumbline.plans import check_catalog, ingest, marts
from plumbline.plans.staging import STAGING_COLUMNS, staging
from plumbline.session import remove, shared_folder
from plumbline.sources import history, published, snapshots

from workload import star
from workload.anomalies import anomaly_history
from workload.models import select_list
from workload.operations import check_history
from workload.profiling import _EVENTS_SQL
from workload.registry import query
from workload.sql import over

_STAGED = [name for name, _, _ in STAGING_COLUMNS] + ["is_late"]
_RUN_AT = "strftime(run_at, '%Y-%m-%d %H:%M:%S') AS run_at"


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _deliver(df: DataFrame, path: str) -> str:
    """As compressed files, each with the rows of a task; whoever has loaded them removes them."""
    df.write.options(header=True, escape='"', compression="gzip").csv(path)
    return path


@query(
    "csv_snapshot",
    over(
        "stg",
        select=f"""
        SELECT {select_list(_STAGED)}
        FROM (SELECT * REPLACE (
            customer_street || chr(10) || 'Door "' || customer_id || '", rear'
                AS customer_street,
            CASE WHEN order_item_id <> 2 THEN customer_city END AS customer_city,
            CASE WHEN order_item_id <> 3 THEN order_status END AS order_status)
            FROM stg)
        """,
    ),
)
def csv_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 53 columns delivered as CSV, loaded into the raw table, and staged from there.

    Streets hold line breaks, quotes and commas; some cities and statuses are null tokens.
    """
    item = named("Order Item Id")
    street = named("Customer Street")
    delivered = star.raw(spark, sf_dir).drop("supplier_id").withColumns(
        {
            "Customer Street": F.concat(
                street, F.lit('\nDoor "'), named("Customer Id"), F.lit('", rear')
            ),
            "Customer City": F.when(item == "2", "N/A").otherwise(named("Customer City")),
            "Order Status": F.when(item == "3", "null").otherwise(named("Order Status")),
        }
    )
    path = _deliver(delivered, _folder(spark, "delivered"))
    raw = _folder(spark, "raw")
    snapshots.replace_raw_table(snapshots.read_snapshot(spark, path, multiline=True), raw)
    remove(spark, path)
    return staging(spark.read.parquet(raw))


@query(
    "load_gate",
    over(
        "faulty_profile",
        select=f"""
        {_EVENTS_SQL}
        SELECT 'faulty' AS run_id, '2024-01-31 06:00:00' AS detected_at,
            'shipments' AS source_table, drift_type, severity, column_name, detail,
            (SELECT count(*) FROM raw) AS raw_rows,
            (SELECT count(*) FROM raw WHERE "Sales" = 'pending') AS pending_rows
        FROM events
        """,
    ),
)
def load_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A good delivery and then a broken one: the drift log of the second, and what the raw table
    holds after both, which is the first."""
    raw, log = _folder(spark, "raw"), _folder(spark, "drift")
    good = star.raw(spark, sf_dir).drop("supplier_id")
    broken = star.with_faults(star.raw(spark, sf_dir))
    for run_id, delivered in (("good", good), ("faulty", broken)):
        path = _deliver(delivered, _folder(spark, "delivered"))
        ingest.run_ingestion(
            spark,
            path,
            raw,
            log,
            run_id=run_id,
            run_at=dt.datetime(2024, 1, 31, 6, tzinfo=dt.timezone.utc),
        )
        remove(spark, path)
    left = spark.read.parquet(raw).agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(F.col("Sales") == "pending").alias("pending_rows"),
    )
    rows = left.first()  # one row
    events = history.read(spark, log, history.DRIFT_EVENTS).filter(F.col("run_id") == "faulty")
    return events.select(
        "run_id",
        "detected_at",
        "source_table",
        "drift_type",
        "severity",
        "column_name",
        "detail",
        F.lit(rows.raw_rows).cast("bigint").alias("raw_rows"),
        F.lit(rows.pending_rows).cast("bigint").alias("pending_rows"),
    )


_MESSAGE_SQL = """
    CASE failure_count % 4 WHEN 0 THEN NULL WHEN 1 THEN 'line one' || chr(10) || 'line "two", x'
        WHEN 2 THEN '  "' || test_name || '", C:\\dir ' ELSE '' END
"""


@query(
    "published_round_trip",
    over(
        "check_history",
        select=f"""
        SELECT run_id, {_RUN_AT}, test_name, model_name, column_name, status, severity,
            failure_count, {_MESSAGE_SQL} AS message
        FROM check_history
        """,
    ),
)
def published_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check history as published and read back, with nulls, empty messages, quotes, commas,
    blanks at the ends, backslashes and line breaks."""
    kind = F.col("failure_count") % 4
    log = check_history(spark, sf_dir).withColumn(
        "message",
        F.when(kind == 1, F.lit('line one\nline "two", x'))
        .when(kind == 2, F.concat(F.lit('  "'), "test_name", F.lit('", C:\\dir ')))
        .when(kind == 3, F.lit("")),
    )
    folder = _folder(spark, "published")
    published.publish({"check_audit": log}, folder)
    # Columns alone are computed here, so every row comes from the files.
    found = published.read_or_compute(spark, folder, "check_audit", lambda: log.filter("false"))
    return found.select(
        "run_id",
        "run_at",
        "test_name",
        "model_name",
        "column_name",
        "status",
        "severity",
        "failure_count",
        "message",
    )


@query(
    "gate_of_run",
    over(
        "check_history",
        "anomaly_history",
        select="""
        , flagged AS (
            SELECT run_id, CASE WHEN status NOT IN ('pass', 'skipped') THEN severity END AS level
            FROM check_history
            UNION ALL
            SELECT run_id, CASE WHEN status <> 'pass' THEN severity END FROM anomaly_history)
        SELECT run_id, CASE WHEN count(*) FILTER (level = 'critical') > 0 THEN 'critical'
                ELSE 'ok' END AS outcome,
            count(*) FILTER (level = 'critical') > 0 AS halted,
            count(*) FILTER (level = 'critical') AS critical,
            count(*) FILTER (level = 'warning') AS warning,
            count(*) FILTER (level = 'info') AS info
        FROM flagged GROUP BY run_id
        """,
    ),
)
def gate_of_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each run judged by its own results, whichever came first or last."""
    return alerts.gate_of_runs(check_history(spark, sf_dir), anomaly_history(spark, sf_dir))


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_CONDITIONS = " ".join(
    f"WHEN {_literal(check.name)} THEN {_literal(check.sql)}" for check in check_catalog.ALL_CHECKS
)


@query(
    "check_messages",
    over(
        "check_history",
        select=f"""
        SELECT run_id, test_name, 'Got ' || failure_count || ' results where 0 are expected: '
            || CASE test_name {_CONDITIONS} END AS message
        FROM check_history WHERE status <> 'pass'
        """,
    ),
)
def check_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the checks that fail say."""
    failed = alerts.non_passing_checks(check_history(spark, sf_dir))
    return failed.select("run_id", "test_name", "message")


@query(
    "freshness_of_successes",
    """
    SELECT event_type,
        strftime(max(ts) FILTER (value >= 20 AND event_type <> 'error'), '%Y-%m-%d %H:%M:%S')
            AS last_run_at,
        (epoch(TIMESTAMP '2024-02-01')
            - floor(epoch(max(ts) FILTER (value >= 20 AND event_type <> 'error')))) / 3600
            AS hours_since
    FROM events GROUP BY event_type
    """,
)
def freshness_of_successes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types as tables and events as loads; low values failed, and errors always did."""
    loads = star.table(spark, sf_dir, "events").select(
        "event_type", F.col("ts").cast("timestamp").alias("run_at"), "value"
    )
    succeeded = (F.col("value") >= 20) & (F.col("event_type") != "error")
    return health.freshness(loads, "event_type", F.lit("2024-02-01").cast("timestamp"), succeeded)


# Attributes that change from order to order and from line to line, and dates that repeat.
_VARIED_SQL = """
, varied AS (
    SELECT * REPLACE (
        order_date + to_days(CAST(supplier_id % 3 AS INTEGER)) AS order_date,
        customer_segment || ' ' || shipping_mode AS customer_segment,
        CASE WHEN order_item_id <> 4 THEN order_id || '.' || customer_email END AS customer_email,
        sales AS product_price,
        product_name || ' ' || transaction_type AS product_name)
    FROM stg)
"""


def _varied(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = F.concat_ws
    staged = star.staging(spark, sf_dir, customers=True, products=True)
    email = F.concat(F.col("order_id").cast("string"), F.lit("."), "customer_email")
    return staged.withColumns(
        {
            "order_date": F.col("order_date")
            + F.make_dt_interval(days=(F.col("supplier_id") % 3).cast("int")),
            "customer_segment": joined(" ", "customer_segment", "shipping_mode"),
            "customer_email": F.when(F.col("order_item_id") != 4, email),
            "product_price": F.col("sales"),
            "product_name": joined(" ", "product_name", "transaction_type"),
        }
    ).drop("supplier_id")


def _first_sql(keys: list[str], columns: tuple[str, ...], date_order: str) -> str:
    rest = [c for c in columns if c not in (*keys, "order_date", "days_late")]
    order = ", ".join([f"order_date {date_order}", *[f"{c} NULLS FIRST" for c in rest]])
    return f"""
        SELECT {select_list(columns)}
        FROM (SELECT *, greatest(days_shipping_real - days_shipping_scheduled, 0) AS days_late,
                row_number() OVER (PARTITION BY {", ".join(keys)} ORDER BY {order}) AS row_num
            FROM varied)
        WHERE row_num = 1
    """


def _mart_sql(keys: list[str], columns: tuple[str, ...], date_order: str) -> str:
    return over("stg", select=_VARIED_SQL + _first_sql(keys, columns, date_order))


@query("mart_customers", _mart_sql(["customer_id"], marts.CUSTOMER_COLUMNS, "DESC NULLS LAST"))
def mart_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension as a run builds it, from attributes that change with each order."""
    return marts.dim_customers(_varied(spark, sf_dir))


@query("mart_products", _mart_sql(["product_id"], marts.PRODUCT_COLUMNS, "DESC NULLS LAST"))
def mart_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension as a run builds it, from attributes that change with each line."""
    return marts.dim_products(_varied(spark, sf_dir))


@query(
    "mart_order_items",
    _mart_sql(["order_id", "order_item_id"], marts.ORDER_ITEM_COLUMNS, "NULLS FIRST"),
)
def mart_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order items as a run builds them, with its tiebreak, from lines of several dates."""
    return marts.order_items(_varied(spark, sf_dir))
