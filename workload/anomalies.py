"""Daily events as runs: metrics, rolling baselines, verdicts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import alerts, baseline, health
from plumbline.operators.latest import of_latest_run
from plumbline.session import materialize, shared_folder
from plumbline.sources import history
from workload import star
from workload.registry import query
from workload.sql import over

_TABLE = "events"
ROW_COUNT = baseline.row_count(_TABLE)
MEAN_VALUE = baseline.mean("avg_event_value", _TABLE, "value")
NULL_RATE = baseline.null_rate(_TABLE, "event_type")
METRICS = (ROW_COUNT, MEAN_VALUE, NULL_RATE)

_RESULT = (
    "run_id, strftime(run_at, '%Y-%m-%d %H:%M:%S') AS run_at, check_name, table_name, "
    "column_name, status, severity, observed_value, expected_value, z_score"
)


def daily_observations(spark: SparkSession, sf_dir: str, *metrics: baseline.Metric) -> DataFrame:
    """Metrics of each day's events. The type "error" stands for a missing one."""
    by_day = star.table(spark, sf_dir, "events").select(
        F.to_timestamp(F.date_trunc("day", F.col("ts").cast("timestamp"))).alias("run_at"),
        "value",
        F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"),
    )
    return baseline.observe(by_day, metrics or METRICS, by=["run_at"])


def anomaly_history(spark: SparkSession, sf_dir: str, *metrics: baseline.Metric) -> DataFrame:
    """Every day scored against the days before it, as the history would hold it."""
    observed = daily_observations(spark, sf_dir, *metrics)
    scored = baseline.scored(baseline.with_rolling_baseline(observed))
    return scored.withColumn(
        "run_id", F.concat(F.lit("run-"), F.date_format("run_at", "yyyy-MM-dd"))
    )


def _shown(history: DataFrame) -> DataFrame:
    numbers = ("observed_value", "expected_value", "z_score")
    return history.select(
        "run_id",
        "run_at",
        "check_name",
        "table_name",
        "column_name",
        "status",
        "severity",
        *[F.round(name, 6).alias(name) for name in numbers],
    )


def _one_check(metric: baseline.Metric) -> str:
    return over(
        "anomaly_history",
        select=f"SELECT {_RESULT} FROM anomaly_history WHERE check_name = '{metric.check_name}'",
    )


@query("row_count_anomaly", _one_check(ROW_COUNT))
def row_count_anomaly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(anomaly_history(spark, sf_dir, ROW_COUNT))


@query("metric_drift", _one_check(MEAN_VALUE))
def metric_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(anomaly_history(spark, sf_dir, MEAN_VALUE))


@query("null_rate_drift", _one_check(NULL_RATE))
def null_rate_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(anomaly_history(spark, sf_dir, NULL_RATE))


@query(
    "anomaly_status_counts",
    over(
        "anomaly_history",
        select="""
        SELECT count(*) FILTER (status = 'critical') AS critical_count,
            count(*) FILTER (status = 'warn') AS warn_count,
            count(*) FILTER (status = 'pass') AS pass_count
        FROM anomaly_history
        """,
    ),
)
def anomaly_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return baseline.status_counts(anomaly_history(spark, sf_dir))


@query(
    "anomaly_against_record",
    over(
        "anomaly_history",
        select=f"""
        SELECT {_RESULT} FROM anomaly_history
        WHERE run_at = (SELECT max(run_at) FROM anomaly_history)
        """,
    ),
)
def anomaly_against_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last day as this run, against the recorded days before it."""
    scored = materialize(anomaly_history(spark, sf_dir), "anomalies")
    today = of_latest_run(scored).select(
        "run_id", "run_at", "check_name", "table_name", "column_name", "kind", "observed_value"
    )
    latest = scored.select(F.max("run_at")).scalar()
    recorded = scored.where(F.col("run_at") < latest)
    return _shown(baseline.scored(baseline.with_recorded_baseline(today, recorded)))


@query(
    "anomaly_against_newest_days",
    over(
        "anomaly_history",
        select=f"""
        SELECT {_RESULT} FROM anomaly_history
        WHERE run_at = (SELECT max(run_at) FROM anomaly_history)
        """,
    ),
)
def anomaly_against_newest_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last day as this run, against a log in day partitions: days older than the baseline's
    are not opened."""
    scored = materialize(anomaly_history(spark, sf_dir), "anomalies")
    latest = scored.select(F.max("run_at")).scalar()
    log = f"{shared_folder(spark)}/anomaly-log-{uuid.uuid4().hex}"
    history.append_anomalies(scored.where(F.col("run_at") < latest), log, repeated=False)
    past = history.recent_anomalies(
        spark, log, [m.check_name for m in METRICS], baseline.WINDOW_RUNS, before=latest
    )
    today = scored.where(F.col("run_at") == latest).select(
        "run_id", "run_at", "check_name", "table_name", "column_name", "kind", "observed_value"
    )
    return _shown(baseline.scored(baseline.with_recorded_baseline(today, past)))


@query(
    "anomaly_latest",
    over(
        "anomaly_history",
        select=f"""
        SELECT {_RESULT} FROM anomaly_history WHERE status <> 'pass'
            AND run_at = (SELECT max(run_at) FROM anomaly_history WHERE status <> 'pass')
        """,
    ),
)
def anomaly_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-passing checks of the latest run; the history is taken up to the last complaint."""
    scored = anomaly_history(spark, sf_dir)
    return _shown(of_latest_run(alerts.non_passing_anomalies(scored)))


@query(
    "check_timeline",
    over(
        "anomaly_history",
        select="""
        SELECT strftime(run_at, '%Y-%m-%d %H:%M:%S') AS run_at, observed_value, expected_value,
            z_score, status, status <> 'pass' AS flagged
        FROM anomaly_history WHERE check_name = 'avg_event_value'
        """,
    ),
)
def check_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    timeline = health.check_timeline(anomaly_history(spark, sf_dir), MEAN_VALUE.check_name)
    return timeline.select(
        "run_at",
        *[F.round(n, 6).alias(n) for n in ("observed_value", "expected_value", "z_score")],
        "status",
        "flagged",
    )


@query(
    "recent_runs",
    over(
        "anomaly_history",
        select=f"""
        SELECT {_RESULT} FROM anomaly_history
        QUALIFY row_number() OVER (PARTITION BY check_name ORDER BY run_at DESC) <= 7
        """,
    ),
)
def recent_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(health.recent_runs(anomaly_history(spark, sf_dir), 7))
