import datetime as dt
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from plumbline.functions.scoring import anomaly_severity, anomaly_status, storable
from plumbline.operators import baseline

START = dt.datetime(2024, 1, 1)
HISTORY = "check_name string, run_at timestamp, observed_value double, status string"
TODAY = (
    "check_name string, run_at timestamp, observed_value double, kind string, "
    "table_name string, column_name string"
)


@pytest.fixture
def score(spark):
    """Score one value against a recorded history."""

    def run(values, observed, kind=baseline.MEAN, statuses=None, strict=False, **kwargs):
        statuses = statuses or ["pass"] * len(values)
        rows = [
            ("m", START + dt.timedelta(days=i), v, s)
            for i, (v, s) in enumerate(zip(values, statuses))
        ]
        history = spark.createDataFrame(rows, HISTORY)
        today = spark.createDataFrame(
            [("m", START + dt.timedelta(days=999), observed, kind, "t", "c")], TODAY
        )
        with_baseline = baseline.with_recorded_baseline(today, history, **kwargs)
        return baseline.scored(with_baseline, strict_null_rates=strict).first()

    return run


def test_four_runs_are_too_few_and_five_are_enough(score):
    few = score([1.0, 2.0, 3.0, 4.0], 100.0)
    assert (few.status, few.severity, few.z_score, few.expected_value) == ("pass", "info", None, None)
    assert few.observed_value == 100.0 and few.message.startswith("Only 4 earlier runs, need 5")
    enough = score([1.0, 2.0, 3.0, 4.0, 5.0], 100.0)
    assert enough.status == "critical" and enough.expected_value == 3.0
    assert enough.z_score == pytest.approx(97 / math.sqrt(2.5))


def test_no_history_at_all(score):
    first = score([], 5.0)
    assert (first.status, first.z_score, first.history_runs) == ("pass", None, 0)


@pytest.mark.parametrize(
    "z, status, severity",
    [
        (2.0, "pass", "info"),
        (-2.0, "pass", "info"),
        (2.0001, "warn", "warning"),
        (-2.5, "warn", "warning"),
        (3.0, "warn", "warning"),
        (3.0001, "critical", "critical"),
        (-9999.0, "critical", "critical"),
        (float("inf"), "critical", "critical"),
        (float("nan"), "pass", "info"),
        (None, "pass", "info"),
    ],
)
def test_verdicts_at_the_edges(spark, z, status, severity):
    row = spark.createDataFrame([(z,)], "z double").select(
        anomaly_status(F.col("z")).alias("status"), anomaly_severity(F.col("z")).alias("severity")
    )
    assert tuple(row.first()) == (status, severity)


@pytest.mark.parametrize(
    "observed, z", [(100.0, 0.0), (100.09, 0.0), (100.2, 9999.0), (99.0, 9999.0)]
)
def test_flat_history_tolerates_a_thousandth(score, observed, z):
    result = score([100.0] * 6, observed)
    assert result.z_score == z
    assert result.status == ("pass" if z == 0 else "critical")


def test_flat_zero_history(score):
    assert score([0.0] * 6, 0.0).z_score == 0.0
    assert score([0.0] * 6, 0.5).status == "critical"


def test_strict_null_rates_want_equality(score):
    kind = baseline.NULL_RATE
    assert score([0.25] * 6, 0.25, kind, strict=True).z_score == 0.0
    assert score([0.25] * 6, 0.2501, kind, strict=True).z_score == float("inf")
    assert score([0.25] * 6, 0.2501, kind).z_score == 0.0


def test_nothing_observed_is_no_complaint(score):
    result = score([1.0, 2.0, 3.0, 4.0, 5.0], None)
    assert (result.status, result.z_score, result.expected_value) == ("pass", None, None)


def test_history_without_values_gives_no_verdict(score):
    result = score([None] * 6, 5.0)
    assert result.status == "pass" and math.isnan(result.z_score)


def test_only_the_last_thirty_runs_count(score):
    result = score([1000.0] * 20 + [float(i % 5) for i in range(30)], 2.0)
    assert result.history_runs == 30 and result.expected_value == 2.0


def test_anomalous_runs_stay_in_the_baseline_unless_asked(score):
    values = [10.0, 11.0, 9.0, 10.0, 11.0, 9.0, 500.0]
    statuses = ["pass"] * 6 + ["critical"]
    assert score(values, 30.0, statuses=statuses).status == "pass"
    assert score(values, 30.0, statuses=statuses, exclude_anomalies=True).status == "critical"


def test_a_lost_two_thirds_of_the_rows_is_critical(score):
    jitter = [180_519 + (i * 397 % 1001) - 500 for i in range(25)]
    result = score([float(v) for v in jitter], 60_000.0, baseline.ROW_COUNT)
    assert result.status == "critical" and result.z_score < -100
    assert result.message.startswith("Row count: 60,000 | Window mean: 180,")
    assert "ANOMALY" in result.message


def test_rolling_and_recorded_baselines_agree(spark):
    values = [math.sin(i) * 10 + i % 3 for i in range(45)]
    rows = [
        ("m", START + dt.timedelta(days=i), v, baseline.MEAN, "t", "c") for i, v in enumerate(values)
    ]
    whole = baseline.scored(baseline.with_rolling_baseline(spark.createDataFrame(rows, TODAY)))
    last = whole.orderBy(F.col("run_at").desc()).first()
    history = spark.createDataFrame([r[:3] + ("pass",) for r in rows[:-1]], HISTORY)
    today = spark.createDataFrame(rows[-1:], TODAY)
    point = baseline.scored(baseline.with_recorded_baseline(today, history)).first()
    assert last.z_score == pytest.approx(point.z_score)
    window = pd.Series(values[14:44])
    assert point.z_score == pytest.approx((values[-1] - window.mean()) / window.std())


def test_metrics_of_a_table_come_from_one_aggregate(spark):
    df = spark.createDataFrame(
        [("1", "a"), ("2", ""), ("x", None), (None, "b")], "`Days (real)` string, `Customer Email` string"
    )
    metrics = [
        baseline.row_count("t"),
        baseline.mean("avg_days", "t", "Days (real)"),
        baseline.null_rate("t", "Customer Email"),
    ]
    observed = baseline.observe(df, metrics)
    assert {r.check_name: r.observed_value for r in observed.collect()} == {
        "row_count_anomaly": 4.0,
        "avg_days": 1.5,
        "null_rate_drift__t__Customer_Email": 0.5,
    }
    assert observed._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1
    nothing = {r.check_name: r.observed_value for r in baseline.observe(df.limit(0), metrics).collect()}
    assert list(nothing.values()) == [0.0, None, 0.0]


def test_infinities_become_storable(spark):
    values = [1.5, float("inf"), float("-inf"), float("nan"), None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(storable(F.col("v"))).collect()] == [1.5, 9999.0, 9999.0, 9999.0, None]
