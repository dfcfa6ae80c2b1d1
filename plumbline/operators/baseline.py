"""Observed metrics against their own past: rolling baselines, scores and verdicts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.naming import null_rate_check_name
from plumbline.functions.parsing import blank, named
from plumbline.functions.scoring import (
    CRITICAL_Z,
    MIN_HISTORY_RUNS,
    WINDOW_RUNS,
    anomaly_severity,
    anomaly_status,
    z_score,
)
from plumbline.operators.latest import top_per_key

ROW_COUNT = "row_count"
MEAN = "mean"
NULL_RATE = "null_rate"


@dataclass(frozen=True)
class Metric:
    """One number to watch: a table's row count, a column's mean or its share of blanks."""

    check_name: str
    kind: str
    table_name: str
    column_name: str = ""

    def value(self) -> Column:
        if self.kind == ROW_COUNT:
            return F.count(F.lit(1)).cast("double")
        column = named(self.column_name)
        if self.kind == MEAN:
            return F.avg(column.try_cast("double"))
        if self.kind == NULL_RATE:
            share = F.try_divide(F.count_if(blank(column)), F.count(F.lit(1)))
            return F.coalesce(share, F.lit(0.0))
        raise ValueError(f"unknown kind of metric: {self.kind}")


def row_count(table_name: str, check_name: str = "row_count_anomaly") -> Metric:
    return Metric(check_name, ROW_COUNT, table_name)


def mean(check_name: str, table_name: str, column_name: str) -> Metric:
    return Metric(check_name, MEAN, table_name, column_name)


def null_rate(table_name: str, column_name: str) -> Metric:
    return Metric(
        null_rate_check_name(table_name, column_name), NULL_RATE, table_name, column_name
    )


def observe(df: DataFrame, metrics: Sequence[Metric], by: Sequence[str] = ()) -> DataFrame:
    """Every metric of a table in one aggregate, one row each.

    ``by`` observes each run separately where the table holds the rows of several.
    """
    wide = df.groupBy(*by).agg(*[m.value().alias(f"m{i}") for i, m in enumerate(metrics)])
    rows = F.array(
        *[
            F.struct(
                F.lit(m.check_name).alias("check_name"),
                F.lit(m.table_name).alias("table_name"),
                F.lit(m.column_name).alias("column_name"),
                F.lit(m.kind).alias("kind"),
                F.col(f"m{i}").alias("observed_value"),
            )
            for i, m in enumerate(metrics)
        ]
    )
    return wide.select(*by, F.inline(rows))


def _baseline(value: Column) -> dict[str, Column]:
    return {
        "history_runs": F.count(F.lit(1)),
        "history_mean": F.avg(value),
        "history_stddev": F.stddev_samp(value),
    }


def with_rolling_baseline(observations: DataFrame, window_runs: int = WINDOW_RUNS) -> DataFrame:
    """Baseline of every run from the runs before it, for scoring a whole history at once.

    A window holds one check's history, which is one row per run and not per data row.
    """
    before = (
        Window.partitionBy("check_name")
        .orderBy(*[c for c in ("run_at", "run_id") if c in observations.columns])
        .rowsBetween(-window_runs, -1)
    )
    return observations.withColumns(
        {name: agg.over(before) for name, agg in _baseline(F.col("observed_value")).items()}
    )


def with_recorded_baseline(
    observations: DataFrame,
    history: DataFrame,
    window_runs: int = WINDOW_RUNS,
    *,
    exclude_anomalies: bool = False,
) -> DataFrame:
    """Baseline of this run's observations from the last recorded runs of the same checks."""
    past = history.filter(F.col("status") == "pass") if exclude_anomalies else history
    recent = top_per_key(
        past.select("check_name", "run_at", "observed_value"),
        ["check_name"],
        [F.col("run_at").desc(), F.col("observed_value")],
        window_runs,
    )
    baseline = recent.groupBy("check_name").agg(
        *[agg.alias(name) for name, agg in _baseline(F.col("observed_value")).items()]
    )
    # This run has one observation per metric, so the left side is the small one.
    return observations.join(baseline, "check_name", "left").fillna(0, ["history_runs"])


def scored(with_baseline: DataFrame, *, strict_null_rates: bool = False) -> DataFrame:
    """Expected value, z-score, verdict and message of each observation.

    With fewer than five earlier runs, or nothing observed, there is no score and no complaint.
    ``strict_null_rates`` drops the tolerance for null rates whose history is flat.
    """
    observed = F.col("observed_value")
    comparable = (F.col("history_runs") >= MIN_HISTORY_RUNS) & observed.isNotNull()
    nan = F.lit(float("nan"))
    history_mean = F.coalesce(F.col("history_mean"), nan)
    history_stddev = F.coalesce(F.col("history_stddev"), nan)
    z = z_score(observed, history_mean, history_stddev)
    if strict_null_rates:
        strict = z_score(observed, history_mean, history_stddev, strict=True)
        z = F.when(F.col("kind") == NULL_RATE, strict).otherwise(z)
    judged = with_baseline.withColumns(
        {
            "expected_value": F.when(comparable, history_mean),
            "z_score": F.when(comparable, z),
        }
    )
    score = F.col("z_score")
    return judged.withColumns(
        {
            "status": anomaly_status(score),
            "severity": anomaly_severity(score),
            "threshold": F.lit(CRITICAL_Z),
            "message": message(),
        }
    )


def _shown(value: Column) -> Column:
    """A number as its kind of metric is read: whole rows, a percentage, or four digits."""
    return (
        F.when(F.col("kind") == ROW_COUNT, F.format_number(value, 0))
        .when(F.col("kind") == NULL_RATE, F.format_string("%.2f%%", value * 100))
        .otherwise(F.format_string("%.4f", value))
    )


def message() -> Column:
    """What was seen, what was expected, and whether that is out of bounds."""
    observed, z = F.col("observed_value"), F.col("z_score")
    label = F.when(F.col("kind") == ROW_COUNT, "Row count").otherwise(
        F.when(
            F.col("kind") == NULL_RATE,
            F.concat(F.lit("Null rate for "), F.col("column_name")),
        ).otherwise(F.col("check_name"))
    )
    compared = F.concat(
        label,
        F.lit(": "),
        _shown(observed),
        F.lit(" | Window mean: "),
        _shown(F.col("expected_value")),
        F.lit(" | Stddev: "),
        F.coalesce(F.format_string("%.4f", F.col("history_stddev")), F.lit("n/a")),
        F.format_string(" | z=%.2f", z),
        F.when(
            anomaly_status(z) != "pass",
            F.format_string(
                " | ANOMALY: |z|=%.2f, critical above %.1f", F.abs(z), F.lit(CRITICAL_Z)
            ),
        ).otherwise(""),
    )
    return (
        F.when(observed.isNull(), "Nothing observed; the table may be empty.")
        .when(
            z.isNull(),
            F.concat(
                F.format_string(
                    "Only %d earlier runs, need %d. Observed: ",
                    F.col("history_runs"),
                    F.lit(MIN_HISTORY_RUNS),
                ),
                _shown(observed),
            ),
        )
        .otherwise(compared)
    )


def status_counts(results: DataFrame) -> DataFrame:
    """One row: critical, warned and passed checks."""
    return results.agg(
        *[
            F.count_if(F.col("status") == status).alias(f"{status}_count")
            for status in ("critical", "warn", "pass")
        ]
    )
