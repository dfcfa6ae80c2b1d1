"""Where the queries and their SQL counterparts are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.parsing import named
from plumbline.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _portable(field: T.StructField) -> Column:
    """A value that both engines hand out alike: decimals as doubles, dates as text."""
    column = named(field.name)
    if isinstance(field.dataType, T.DecimalType):
        return column.cast("double").alias(field.name)
    if isinstance(field.dataType, T.DateType):
        return F.date_format(column, "yyyy-MM-dd").alias(field.name)
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(field.name)
    if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
        return column.cast("bigint").alias(field.name)
    return column


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with the SQL that has to give the same rows."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            result = build(configure(spark), sf_dir)
            return result.select(*[_portable(field) for field in result.schema])

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
