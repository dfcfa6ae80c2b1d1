"""Run a registered query on Spark and its SQL on DuckDB, and compare the rows."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def tables_of(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def normal(value):
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return 0.0 if value == 0 else float(f"{value:.10g}")
    if isinstance(value, bool):
        return value
    if isinstance(value, int):
        return float(value) if abs(value) < 2**53 else value
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(normal(row[i]) for i in order) for row in rows)


def differences(spark_df, connection, sql: str) -> str | None:
    """What differs, or None."""
    result = connection.execute(sql)
    sql_columns = [d[0] for d in result.description]
    sql_rows = result.fetchall()
    types = {d[0]: str(d[1]) for d in result.description}
    odd = {n: t for n, t in types.items() if t in ("HUGEINT", "DATE") or t.startswith("DECIMAL")}
    if odd:
        return f"types that other engines hand out differently: {odd}"
    spark_rows = spark_df.collect()
    if sorted(spark_df.columns) != sorted(sql_columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(sql_columns)}"
    if len(spark_rows) != len(sql_rows):
        return f"{len(spark_rows)} rows != {len(sql_rows)}"
    ours, theirs = rows_of(spark_df.columns, spark_rows), rows_of(sql_columns, sql_rows)
    if ours != theirs:
        names = sorted(sql_columns)
        return (
            f"{names}\n only Spark: {list((ours - theirs).items())[:3]}"
            f"\n only SQL: {list((theirs - ours).items())[:3]}"
        )
    return None
