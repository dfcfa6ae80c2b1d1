"""z-scores, their verdicts, and the severity of a check status."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the statistical checks.
WINDOW_RUNS = 30
MIN_HISTORY_RUNS = 5
WARN_Z = 2.0
CRITICAL_Z = 3.0
FLAT_STDDEV = 1e-12
FLAT_RELATIVE_TOLERANCE = 1e-3
SMALLEST_MEAN = 1e-6
OFF_SCALE = 9999.0

# Severity of each status a check run can report.
STATUS_SEVERITY = {
    "pass": "info",
    "warn": "warning",
    "error": "critical",
    "skipped": "info",
    "fail": "critical",
}
UNKNOWN_STATUS_SEVERITY = "critical"

# Fixed value: checks whose failures are known upstream debt, never critical.
KNOWN_WARNINGS = ("assert_late_flag_consistency",)

# Severities, the most urgent first.
SEVERITIES = ("critical", "warning", "info")


def z_score(observed: Column, mean: Column, stddev: Column, *, strict: bool = False) -> Column:
    """Distance from the mean in sample standard deviations.

    A flat history has no scale: then 0 when the value is within 0.1 % of the mean, else
    ``OFF_SCALE``. ``strict`` asks for equality instead and gives infinity.
    """
    if strict:
        flat = stddev == 0
        on_flat = F.when(observed == mean, 0.0).otherwise(float("inf"))
    else:
        flat = F.abs(stddev) < FLAT_STDDEV
        off_by = F.abs(observed - mean) / F.greatest(F.abs(mean), F.lit(SMALLEST_MEAN))
        on_flat = F.when(off_by < FLAT_RELATIVE_TOLERANCE, 0.0).otherwise(OFF_SCALE)
    return F.when(flat, on_flat).otherwise(F.try_divide(observed - mean, stddev))


def verdict(z: Column, when_critical: str, when_warn: str, otherwise: str) -> Column:
    """Pick by size of z. A missing or NaN score is no evidence, so it is ``otherwise``."""
    size = F.abs(z)
    return (
        F.when(z.isNull() | F.isnan(z), otherwise)
        .when(size > CRITICAL_Z, when_critical)
        .when(size > WARN_Z, when_warn)
        .otherwise(otherwise)
    )


def anomaly_status(z: Column) -> Column:
    return verdict(z, "critical", "warn", "pass")


def anomaly_severity(z: Column) -> Column:
    return verdict(z, "critical", "warning", "info")


def storable(value: Column) -> Column:
    """Infinities and NaN become ``OFF_SCALE``; null stays null."""
    not_finite = F.isnan(value) | (F.abs(value) == float("inf"))
    return F.when(not_finite, OFF_SCALE).otherwise(value)


def status_severity(status: Column, check_name: Column) -> Column:
    """Severity of a check status, with the known warnings held below critical."""
    severity = F.lit(UNKNOWN_STATUS_SEVERITY)
    for text, level in STATUS_SEVERITY.items():
        severity = F.when(status == text, level).otherwise(severity)
    known = check_name.isin(*KNOWN_WARNINGS)
    return F.when(known & (severity == "critical"), "warning").otherwise(severity)
