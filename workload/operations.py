"""Check history, its rollups, alerts and the gate. Each order day is a run over its lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import alerts, checks, health
from plumbline.plans import check_catalog
from plumbline.sources import history, run_results
from workload import star
from workload.anomalies import anomaly_history
from workload.registry import query
from workload.sql import over

_DAILY_CHECKS = (
    *check_catalog.ROW_RULES,
    *[check for check in check_catalog.FACT_CHECKS if check.kind == checks.NOT_NULL],
)
_RUN_AT = "strftime(run_at, '%Y-%m-%d %H:%M:%S') AS run_at"
_CHECK_COLUMNS = (
    f"run_id, {_RUN_AT}, test_name, model_name, column_name, status, severity, failure_count"
)
_LATEST_CHECKS = "(SELECT max(run_at) FROM check_history)"
_LATEST_ANOMALIES = "(SELECT max(run_at) FROM anomaly_history)"


def check_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of the row checks for every order day, from one pass over the fact.

    Quantities are one less than delivered and full pallets have an unknown status, so that runs
    differ in what they fail.
    """
    quantity = F.col("order_item_quantity")
    lines = star.fact(spark, sf_dir).withColumns(
        {
            "run_at": F.date_trunc("day", "order_date_id"),
            "order_item_quantity": quantity - 1,
            "delivery_status": F.when(quantity == 50, "Lost").otherwise(F.col("delivery_status")),
        }
    )
    counts = checks.row_failure_counts(lines, _DAILY_CHECKS, by=["run_at"])
    return checks.as_results(
        counts,
        _DAILY_CHECKS,
        run_id=F.concat(F.lit("run-"), F.date_format("run_at", "yyyy-MM-dd")),
        run_at=F.col("run_at"),
    )


def _shown(results: DataFrame) -> DataFrame:
    return results.select(
        "run_id",
        "run_at",
        "test_name",
        "model_name",
        "column_name",
        "status",
        "severity",
        "failure_count",
    )


def _histories(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return (
        check_history(spark, sf_dir),
        history.conform(anomaly_history(spark, sf_dir), history.ANOMALY_RESULTS),
    )


@query(
    "check_history",
    over("check_history", select=f"SELECT {_CHECK_COLUMNS} FROM check_history"),
)
def check_history_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(check_history(spark, sf_dir))


@query(
    "pass_rate_trend",
    over(
        "check_history",
        select=f"""
        SELECT run_id, {_RUN_AT}, count(*) FILTER (status = 'pass') / count(*) * 100 AS pass_rate,
            count(*) AS total_assertions
        FROM check_history GROUP BY run_id, check_history.run_at
        """,
    ),
)
def pass_rate_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.pass_rate_trend(check_history(spark, sf_dir))


@query(
    "health_summary",
    over(
        "check_history",
        "anomaly_history",
        select=f"""
        SELECT count(*) FILTER (status = 'pass') AS passed_tests, count(*) AS total_tests,
            count(*) FILTER (status = 'pass') / count(*) * 100 AS pass_rate,
            CASE WHEN count(*) FILTER (status = 'pass') / count(*) * 100 >= 95
                THEN 'HEALTHY' ELSE 'ATTENTION' END AS health,
            (SELECT count(DISTINCT run_id) FROM check_history) AS total_runs,
            (SELECT count(*) FROM anomaly_history WHERE status <> 'pass') AS anomaly_count
        FROM check_history WHERE run_at = {_LATEST_CHECKS}
        """,
    ),
)
def health_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.health_summary(*_histories(spark, sf_dir))


_ALERTS_SQL = f"""
    SELECT 'Static Business Rule' AS alert_type, test_name AS check_name,
        model_name AS table_name, status, severity,
        CAST(nullif(failure_count, 0) AS DOUBLE) AS observed_value,
        CAST(0 AS DOUBLE) AS expected_value, {_RUN_AT}
    FROM check_history
    WHERE check_history.run_at = {_LATEST_CHECKS} AND status NOT IN ('pass', 'skipped')
    UNION ALL
    SELECT 'Statistical Anomaly', check_name, table_name, status, severity, observed_value,
        expected_value, {_RUN_AT}
    FROM anomaly_history
    WHERE anomaly_history.run_at = {_LATEST_ANOMALIES} AND status <> 'pass'
"""


@query("alerts_open", over("check_history", "anomaly_history", select=_ALERTS_SQL))
def alerts_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alerts.open_alerts(*_histories(spark, sf_dir))
    return found.select(
        "alert_type",
        "check_name",
        "table_name",
        "status",
        "severity",
        F.round("observed_value", 6).alias("observed_value"),
        F.round("expected_value", 6).alias("expected_value"),
        "run_at",
    )


@query(
    "alert_payloads",
    over(
        "check_history",
        "anomaly_history",
        select=f"""
        SELECT check_name, severity, severity IN ('critical', 'warning') AS should_notify,
            'plain_text' AS header_type,
            CASE severity WHEN 'critical' THEN ':red_circle:'
                WHEN 'warning' THEN ':large_yellow_circle:' ELSE ':white_circle:' END
                || ' ' || check_name || ' is ' || severity AS headline
        FROM ({_ALERTS_SQL})
        """,
    ),
)
def alert_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The headline as read back from the notification."""
    found = alerts.with_notification(alerts.open_alerts(*_histories(spark, sf_dir)))
    return found.select(
        "check_name",
        "severity",
        "should_notify",
        F.get_json_object("payload", "$.blocks[0].text.type").alias("header_type"),
        F.get_json_object("payload", "$.blocks[1].text.text").alias("headline"),
    )


@query(
    "severity_gate",
    over(
        "check_history",
        "anomaly_history",
        select=f"""
        SELECT CASE WHEN count(*) FILTER (severity = 'critical') > 0 THEN 'critical' ELSE 'ok' END
                AS outcome,
            count(*) FILTER (severity = 'critical') > 0 AS halted,
            count(*) FILTER (severity = 'critical') AS critical,
            count(*) FILTER (severity = 'warning') AS warning,
            count(*) FILTER (severity = 'info') AS info
        FROM ({_ALERTS_SQL})
        """,
    ),
)
def severity_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.gate(alerts.open_alerts(*_histories(spark, sf_dir)))


@query(
    "severity_breakdown",
    over(
        "check_history",
        "anomaly_history",
        select="""
        SELECT 'static' AS check_type, status, severity, count(*) AS check_count
        FROM check_history GROUP BY status, severity
        UNION ALL
        SELECT 'statistical', status, severity, count(*)
        FROM anomaly_history GROUP BY status, severity
        """,
    ),
)
def severity_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    static, statistical = check_history(spark, sf_dir), anomaly_history(spark, sf_dir)
    return health.severity_breakdown(health.all_checks(static, statistical))


@query(
    "audit_filter",
    over(
        "check_history",
        select=f"""
        SELECT {_CHECK_COLUMNS} FROM check_history
        WHERE regexp_matches(test_name, 'QUANT|status$', 'i')
            AND status = 'fail' AND severity IN ('critical', 'warning')
        """,
    ),
)
def audit_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = health.audit(
        check_history(spark, sf_dir), "QUANT|status$", ["fail"], ["critical", "warning"]
    )
    return _shown(found)


@query(
    "audit_choices",
    over("check_history", select="SELECT DISTINCT test_name FROM check_history"),
)
def audit_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.choices(check_history(spark, sf_dir), "test_name")


@query(
    "run_results_flat",
    over(
        "check_history",
        select=f"""
        SELECT run_id, {_RUN_AT}, test_name,
            CASE WHEN column_name <> '' THEN model_name ELSE '' END AS model_name, column_name,
            status, severity, failure_count,
            CASE WHEN failure_count > 0 THEN 'Got ' || failure_count || ' results' ELSE '' END
                AS message
        FROM check_history
        """,
    ),
)
def run_results_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check history as one JSON document per run, and read back from there.

    A document holds the checks of one run, so its size does not grow with the data.
    """
    documents = (
        result_documents(check_history(spark, sf_dir))
        .select(F.to_json(F.struct("metadata", "results")).alias("document"))
        .select(F.from_json("document", run_results.DOCUMENT).alias("d"))
        .select("d.*")
    )
    return _shown_with_message(run_results.flatten(documents))


def result_documents(results: DataFrame) -> DataFrame:
    """A check history as ``metadata`` and ``results`` of one document per run."""
    failures = F.col("failure_count")
    generic = F.col("column_name") != ""
    result = F.struct(
        F.concat(
            F.lit("test.shop."),
            F.col("test_name"),
            F.when(generic, F.concat(F.lit("."), F.substring(F.md5("test_name"), 1, 10)))
            .otherwise(F.lit("")),
        ).alias("unique_id"),
        "status",
        F.lit(0.1).alias("execution_time"),
        F.col("failure_count").alias("failures"),
        F.when(failures > 0, F.format_string("Got %d results", failures)).alias("message"),
    )
    metadata = F.struct(
        F.col("run_id").alias("invocation_id"),
        F.date_format("run_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("generated_at"),
    )
    return (
        results.groupBy("run_id", "run_at")
        .agg(F.collect_list(result).alias("results"))
        .select(metadata.alias("metadata"), "results")
    )


def _shown_with_message(results: DataFrame) -> DataFrame:
    return results.select(
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
    "freshness",
    """
    SELECT event_type, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_run_at,
        (epoch(TIMESTAMP '2024-02-01') - floor(epoch(max(ts)))) / 3600 AS hours_since
    FROM events GROUP BY event_type
    """,
)
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types as tables, each event as a load."""
    loads = star.table(spark, sf_dir, "events").select(
        "event_type", F.col("ts").cast("timestamp").alias("run_at")
    )
    now = F.lit("2024-02-01").cast("timestamp")
    return health.freshness(loads, "event_type", now)


@query(
    "history_without_rehearsals",
    """
    SELECT CASE WHEN event_type = 'click' THEN NULL ELSE event_type END AS message,
        count(*) AS row_count
    FROM events WHERE event_type <> 'error' GROUP BY 1
    """,
)
def history_without_rehearsals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as history rows: errors are rehearsals, clicks have no message."""
    kind = F.col("event_type")
    rows = star.table(spark, sf_dir, "events").select(
        F.when(kind == "error", "SIMULATED NORMAL RUN")
        .when(kind != "click", kind)
        .alias("message")
    )
    kept = history.without_rehearsals(rows)
    return kept.groupBy("message").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "row_count_check",
    over(
        "fact",
        select="""
        SELECT count(*) AS row_count, CAST(180519 AS BIGINT) AS expected_rows,
            count(*) = 180519 AS matches
        FROM fact
        """,
    ),
)
def row_count_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.row_count_check(star.fact(spark, sf_dir), 180_519)
