"""Column profiles and contract drift of a delivered snapshot."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import drift, health, profile
from plumbline.sources.contracts import shipment_contract
from workload import star
from workload.registry import query
from workload.sql import over

_CONTRACT = shipment_contract()
_DETECTED_AT = dt.datetime(2024, 1, 31, 6, 0, tzinfo=dt.timezone.utc)

_RATES = ("boolean_rate", "integer_rate", "numeric_rate", "date_rate")


@query(
    "column_profile",
    over(
        "raw_profile",
        select="""
        SELECT column_name, row_count, null_count, boolean_rate, integer_rate, numeric_rate,
            date_rate, inferred_type, confidence
        FROM inferred
        """,
    ),
)
def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = profile.column_profile_of_parts(star.raw_parts(spark, sf_dir), _CONTRACT.column_names)
    found = profile.with_inferred_type(counted, F.lit(0.95))
    return found.select(
        "column_name", "row_count", "null_count", *_RATES, "inferred_type", "confidence"
    )


_CONTRACT_SQL = ", ".join(
    f"('{spec.name}', '{spec.type}', {str(spec.nullable).lower()})" for spec in _CONTRACT.columns
)

_EVENTS_SQL = f"""
, contract(column_name, expected_type, nullable) AS (VALUES {_CONTRACT_SQL}),
delivered AS (
    SELECT '[' || string_agg('''' || column_name || '''', ', ' ORDER BY column_name) || ']' AS names
    FROM profile
),
judged AS (
    SELECT *, row_count > null_count AND NOT (
        (inferred_type = expected_type)
        OR (inferred_type = 'integer' AND expected_type = 'numeric')
        OR (inferred_type = 'boolean' AND expected_type IN ('integer', 'numeric'))) AS wrong
    FROM inferred JOIN contract USING (column_name)
),
events AS (
    SELECT 1 AS check_order, column_name, 'MISSING_COLUMN' AS drift_type, 'BREAKING' AS severity,
        'Declared column ''' || column_name || ''' was not delivered. Delivered columns: '
            || names AS detail
    FROM contract, delivered WHERE column_name NOT IN (SELECT column_name FROM profile)
    UNION ALL
    SELECT 2, column_name, 'NEW_COLUMN', 'NON_BREAKING',
        'Column ''' || column_name || ''' was delivered but is not declared. '
            || 'Add it to the contract if it is to be tracked.'
    FROM profile WHERE column_name NOT IN (SELECT column_name FROM contract)
    UNION ALL
    SELECT 3, column_name, 'TYPE_MISMATCH', 'BREAKING',
        'Declared as ''' || expected_type || ''' but the values read as ''' || inferred_type
            || ''' (confidence ' || printf('%.1f%%', confidence * 100)
            || '). The content of the column has changed.'
    FROM judged WHERE wrong
    UNION ALL
    SELECT 4, column_name, 'NULL_VIOLATION', 'BREAKING',
        'Column ''' || column_name || ''' may not be null, but '
            || format('{{:,}}', null_count) || ' of ' || format('{{:,}}', row_count)
            || ' rows (' || printf('%.1f%%', null_count / row_count * 100) || ') are.'
    FROM judged WHERE NOT nullable AND null_count > 0
)
"""


def _faulty_profile(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    parts = [star.with_faults(part) for part in star.raw_parts(spark, sf_dir)]
    return profile.column_profile_of_parts(parts, columns)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    delivered = star.with_faults(star.raw(spark, sf_dir))
    found = _faulty_profile(
        spark, sf_dir, [c for c in _CONTRACT.column_names if c in delivered.columns]
    )
    return drift.drift_events(delivered, _CONTRACT, detected_at=_DETECTED_AT, profile=found)


@query(
    "schema_drift",
    over(
        "faulty_profile",
        select=f"""
        {_EVENTS_SQL}
        SELECT 'shipments' AS source_table, check_order, column_name, drift_type, severity, detail
        FROM events
        """,
    ),
)
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.in_check_order(_events(spark, sf_dir)).select(
        "source_table", "check_order", "column_name", "drift_type", "severity", "detail"
    )


@query(
    "drift_rollup",
    over(
        "faulty_profile",
        select=f"""
        {_EVENTS_SQL}
        SELECT count(*) FILTER (severity = 'BREAKING') AS breaking,
            count(*) FILTER (severity = 'NON_BREAKING') AS non_breaking,
            count(*) FILTER (severity = 'BREAKING') = 0 AS is_valid
        FROM events
        """,
    ),
)
def drift_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.severity_rollup(_events(spark, sf_dir))


@query(
    "drift_log",
    over(
        "faulty_profile",
        select=f"""
        {_EVENTS_SQL}
        SELECT '2024-01-31 06:00:00' AS detected_at, 'shipments' AS source_table, drift_type,
            severity, column_name, detail
        FROM events
        """,
    ),
)
def drift_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.drift_log(_events(spark, sf_dir))


@query(
    "null_violations",
    over(
        "faulty_profile",
        select=f"""
        {_EVENTS_SQL}
        SELECT column_name, row_count, null_count, null_count / row_count AS null_share
        FROM judged WHERE NOT nullable AND null_count > 0
        """,
    ),
)
def null_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls where the contract allows none, from the profile alone."""
    delivered = star.with_faults(star.raw(spark, sf_dir))
    required = [
        spec.name
        for spec in _CONTRACT.columns
        if not spec.nullable and spec.name in delivered.columns
    ]
    found = _faulty_profile(spark, sf_dir, required)
    return found.filter(F.col("null_count") > 0).select(
        "column_name",
        "row_count",
        "null_count",
        F.try_divide("null_count", "row_count").alias("null_share"),
    )


def _table_profile_sql(table: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{column}' AS column_name, count(*) AS row_count, "
        f"count(*) - count({column}) AS null_count, "
        f"{shown.format(f'min({column})')} AS min_value, "
        f"{shown.format(f'max({column})')} AS max_value FROM {table}"
        for column, shown in columns.items()
    )


_PLAIN = "CAST({} AS VARCHAR)"
_REAL = "CAST({} + 0.0 AS VARCHAR)"
_SECONDS = "strftime({}, '%Y-%m-%d %H:%M:%S')"


@query(
    "table_profile",
    _table_profile_sql(
        "lineitem",
        {
            "l_orderkey": _PLAIN,
            "l_partkey": _PLAIN,
            "l_suppkey": _PLAIN,
            "l_linenumber": _PLAIN,
            "l_quantity": _REAL,
            "l_extendedprice": _REAL,
            "l_discount": _REAL,
            "l_tax": _REAL,
            "l_returnflag": _PLAIN,
            "l_linestatus": _PLAIN,
            "l_shipdate": _SECONDS,
        },
    ),
)
def table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without the distinct counts, which are estimates."""
    found = profile.table_profile(star.table(spark, sf_dir, "lineitem"))
    return found.drop("distinct_count")


_PARTS = ("A", "N", "R")
_SKETCHED = {
    "l_orderkey": _PLAIN,
    "l_partkey": _PLAIN,
    "l_quantity": _REAL,
    "l_extendedprice": _REAL,
    "l_returnflag": _PLAIN,
    "l_shipdate": _SECONDS,
}


def _distinct_sql() -> str:
    parts = [(part, f"WHERE l_returnflag = '{part}'") for part in _PARTS] + [("all", "")]
    return " UNION ALL ".join(
        f"SELECT '{part}' AS delivery, '{column}' AS column_name, count(*) AS row_count, "
        f"count(*) - count({column}) AS null_count, count(DISTINCT {column}) AS exact_count, "
        f"true AS within_error, {shown.format(f'min({column})')} AS min_value, "
        f"{shown.format(f'max({column})')} AS max_value FROM lineitem {condition}"
        for part, condition in parts
        for column, shown in _SKETCHED.items()
    )


@query("distinct_counts_of_deliveries", _distinct_sql())
def distinct_counts_of_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines as three deliveries by return flag: the sketches of each, and these merged, against
    exact counts."""
    lines = star.table(spark, sf_dir, "lineitem").select(*_SKETCHED)
    flag = F.col("l_returnflag")
    kept = reduce(
        DataFrame.unionByName,
        [
            profile.column_sketches(lines.filter(flag == part)).withColumn("delivery", F.lit(part))
            for part in _PARTS
        ],
    )
    whole = profile.merged_sketches(kept).withColumn("delivery", F.lit("all"))
    found = profile.profile_of(kept.unionByName(whole))
    dealt = lines.select("*", F.explode(F.array(flag, F.lit("all"))).alias("delivery"))
    exact = dealt.groupBy("delivery").agg(*[F.countDistinct(c).alias(c) for c in _SKETCHED])
    exact = exact.unpivot("delivery", list(_SKETCHED), "column_name", "exact_count")
    off_by = F.abs(F.col("distinct_count") - F.col("exact_count"))
    return found.join(exact, ["delivery", "column_name"]).select(
        "delivery",
        "column_name",
        "row_count",
        "null_count",
        "exact_count",
        (off_by <= F.col("exact_count") * profile.DISTINCT_ERROR).alias("within_error"),
        "min_value",
        "max_value",
    )
