"""Data checks: the rows that fail one, and the failure counts of many.

Rules about single rows of a table are all counted in one aggregate, or while the table is written.
Rules about keys and values are counted per distinct key or value, from one scan of the table, so a
hot key shrinks before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.naming import kept_message
from plumbline.functions.parsing import named, quoted
from plumbline.functions.scoring import status_severity

NOT_NULL = "not_null"
UNIQUE = "unique"
ACCEPTED_VALUES = "accepted_values"
RELATIONSHIPS = "relationships"
ROW_RULE = "row_rule"


@dataclass(frozen=True)
class Check:
    """One check of one table.

    ``failing`` is an SQL predicate for a row rule; a row on which it is null does not fail.
    """

    name: str
    table: str
    kind: str
    column: str = ""
    failing: str = ""
    shows: tuple[str, ...] = ()
    values: tuple[str, ...] = ()
    parent_table: str = ""
    parent_column: str = ""
    warn_only: bool = False

    @property
    def counts_rows(self) -> bool:
        return self.kind in (NOT_NULL, ROW_RULE)

    def fails(self) -> Column:
        """Predicate of a check on single rows."""
        if self.kind == NOT_NULL:
            return named(self.column).isNull()
        if self.kind == ROW_RULE:
            return F.expr(self.failing)
        if self.kind == ACCEPTED_VALUES:
            return ~named(self.column).cast("string").isin(*self.values)
        raise ValueError(f"{self.name} is not about single rows")

    @property
    def sql(self) -> str:
        """The condition of the check, for the history."""
        column = quoted(self.column)
        return {
            NOT_NULL: f"{column} IS NULL",
            ROW_RULE: self.failing,
            ACCEPTED_VALUES: f"{column} NOT IN ({', '.join(map(repr, self.values))})",
            UNIQUE: f"count(*) > 1 by {column}",
            RELATIONSHIPS: f"{column} not in {self.parent_table}.{self.parent_column}",
        }[self.kind]


def not_null(table: str, column: str) -> Check:
    return Check(f"not_null_{table}_{column}", table, NOT_NULL, column)


def unique(table: str, column: str) -> Check:
    return Check(f"unique_{table}_{column}", table, UNIQUE, column)


def accepted_values(table: str, column: str, values: Sequence[object]) -> Check:
    texts = tuple(str(value) for value in values)
    return Check(f"accepted_values_{table}_{column}", table, ACCEPTED_VALUES, column, values=texts)


def relationships(table: str, column: str, parent_table: str, parent_column: str) -> Check:
    return Check(
        f"relationships_{table}_{column}",
        table,
        RELATIONSHIPS,
        column,
        parent_table=parent_table,
        parent_column=parent_column,
    )


def row_rule(
    name: str, table: str, failing: str, shows: Sequence[str], *, warn_only: bool = False
) -> Check:
    return Check(
        name, table, ROW_RULE, failing=failing, shows=tuple(shows), warn_only=warn_only
    )


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Keys of ``child`` that ``parent`` lacks, with their number of rows.

    The child shrinks to one row per key before it is joined, and so does the parent. An anti
    join would not keep to that, as the optimizer moves it below the count.
    """
    keys = child.filter(named(column).isNotNull()).groupBy(named(column).alias("key"))
    known = (
        parent.select(named(parent_column).alias("key")).distinct().withColumn("known", F.lit(True))
    )
    return (
        keys.agg(F.count(F.lit(1)).alias("row_count"))
        .join(known, "key", "left")
        .filter(F.col("known").isNull())
        .drop("known")
    )


def repeated_keys(df: DataFrame, column: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows; nulls are no keys."""
    return (
        df.filter(named(column).isNotNull())
        .groupBy(named(column).alias("key"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter(F.col("row_count") > 1)
    )


def unaccepted_values(df: DataFrame, check: Check) -> DataFrame:
    """Values outside the accepted ones, with their number of rows."""
    return (
        df.filter(check.fails())
        .groupBy(named(check.column).cast("string").alias("value"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def failing_rows(tables: Mapping[str, DataFrame], check: Check) -> DataFrame:
    """What a check complains about: rows, repeated keys, unaccepted values or orphan rows."""
    df = tables[check.table]
    if check.kind == UNIQUE:
        return repeated_keys(df, check.column)
    if check.kind == ACCEPTED_VALUES:
        return unaccepted_values(df, check)
    if check.kind == RELATIONSHIPS:
        parent = tables[check.parent_table]
        return df.filter(named(check.column).isNotNull()).join(
            parent.select(named(check.parent_column).alias(check.column)),
            check.column,
            "left_anti",
        )
    failed = df.filter(check.fails())
    return failed.select(*check.shows) if check.shows else failed


def row_failure_counts(
    df: DataFrame, checks: Sequence[Check], by: Sequence[str] = ()
) -> DataFrame:
    """Failing rows of each check on single rows: one aggregate for all of them.

    ``by`` counts separately for each value of those columns, such as the run a row came with.
    """
    counted = df.groupBy(*by).agg(*[F.count_if(c.fails()).alias(c.name) for c in checks])
    return counted.unpivot(
        [F.col(c) for c in by],
        [named(c.name) for c in checks],
        "check_name",
        "failure_count",
    )


def _counted_keys(df: DataFrame, keys: Mapping[str, Column]) -> DataFrame:
    """``check_name``, ``key`` (text) and ``row_count`` for every key of each check, without nulls.

    The keys are counted in their own types, as grouping sets of one scan: a hot key is one row of
    each task before the shuffle, and only what is left of them becomes text.
    """
    columns = [f"key_{i}" for i in range(len(keys))]
    flat = df.select(*[key.alias(name) for name, key in zip(columns, keys.values(), strict=True)])
    counted = flat.groupingSets([[name] for name in columns], *columns).agg(
        F.count(F.lit(1)).alias("row_count"), F.grouping_id().alias("set")
    )
    # The bit of a column is 0 in its own set.
    every = (1 << len(columns)) - 1
    own = [F.col("set") == (every ^ 1 << (len(columns) - 1 - i)) for i in range(len(columns))]
    name, key = F.lit(None).cast("string"), F.lit(None).cast("string")
    for is_set, column, check_name in zip(own, columns, keys, strict=True):
        name = F.when(is_set, check_name).otherwise(name)
        key = F.when(is_set, F.col(column).cast("string")).otherwise(key)
    found = counted.select(name.alias("check_name"), key.alias("key"), "row_count")
    return found.filter("key is not null")


def _key_counts(
    tables: Mapping[str, DataFrame], table: str, checks: Sequence[Check]
) -> DataFrame:
    """How often each key of each check occurs."""
    keys = {
        c.name: F.when(c.fails(), named(c.column)) if c.kind == ACCEPTED_VALUES else named(c.column)
        for c in checks
    }
    return _counted_keys(tables[table], keys)


def _known_keys(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """The keys that each relationship may have, in the form the child has them; a parent is
    scanned once for all that name it."""
    parts = []
    for parent in dict.fromkeys(c.parent_table for c in checks):
        keys = {
            c.name: named(c.parent_column).cast(tables[c.table].schema[c.column].dataType)
            for c in checks
            if c.parent_table == parent
        }
        parts.append(_counted_keys(tables[parent], keys).select("check_name", "key"))
    return reduce(DataFrame.unionByName, parts)


def failure_counts(
    tables: Mapping[str, DataFrame],
    checks: Sequence[Check],
    counted: Mapping[str, int] | None = None,
) -> DataFrame:
    """``check_name`` and ``failure_count`` of every check, in one DataFrame.

    A failure is a row, but for unique checks a repeated key and for accepted values a value.
    ``counted`` has the failures of checks on rows that are known, as from the write of a table; a
    table is scanned once for the others of that kind, once for those on keys and values, and once
    as the parent of others. Relationships compare a parent's keys in the type of the child.
    """
    every_check, counted = checks, counted or {}
    checks = [c for c in checks if c.name not in counted]
    parts, on_keys_of, related = [], [], []
    for table in dict.fromkeys(c.table for c in checks):
        own = [c for c in checks if c.table == table]
        on_rows = [c for c in own if c.counts_rows]
        on_keys = [c for c in own if not c.counts_rows]
        if on_rows:
            parts.append(row_failure_counts(tables[table], on_rows))
        if on_keys:
            on_keys_of.append(_key_counts(tables, table, on_keys))
            related += [c for c in on_keys if c.kind == RELATIONSHIPS]
    if on_keys_of:
        keys = reduce(DataFrame.unionByName, on_keys_of)
        known = F.lit(False)
        if related:
            parents = _known_keys(tables, related).withColumn("known", F.lit(True))
            keys = keys.join(parents, ["check_name", "key"], "left")
            known = F.coalesce("known", F.lit(False))
        name, rows = F.col("check_name"), F.col("row_count")
        kinds = {
            kind: name.isin([c.name for c in checks if c.kind == kind])
            for kind in (UNIQUE, ACCEPTED_VALUES, RELATIONSHIPS)
        }
        failures = (
            F.when(kinds[UNIQUE], (rows > 1).cast("bigint"))
            .when(kinds[ACCEPTED_VALUES], F.lit(1).cast("bigint"))
            .when(kinds[RELATIONSHIPS], F.when(known, F.lit(0)).otherwise(rows))
        )
        parts.append(keys.select("check_name", failures.alias("failure_count")))
    # Checks of tables without any key have no row so far.
    given = {c.name: counted.get(c.name, 0) for c in every_check if c.name in counted or not c.counts_rows}
    if given:
        rows = {
            "check_name": pa.array(list(given), pa.string()),
            "failure_count": pa.array(list(given.values()), pa.int64()),
        }
        spark = next(iter(tables.values())).sparkSession
        parts.append(spark.createDataFrame(pa.table(rows)))
    every = reduce(DataFrame.unionByName, parts)
    return every.groupBy("check_name").agg(F.sum("failure_count").alias("failure_count"))


def catalog_frame(spark: SparkSession, checks: Sequence[Check]) -> DataFrame:
    """The checks as rows, to join their counts with."""
    return spark.createDataFrame(
        pa.table(
            {
                "check_name": pa.array([c.name for c in checks], pa.string()),
                "model_name": pa.array([c.table for c in checks], pa.string()),
                "column_name": pa.array([c.column for c in checks], pa.string()),
                "warn_only": pa.array([c.warn_only for c in checks], pa.bool_()),
                "condition": pa.array([c.sql for c in checks], pa.string()),
            }
        )
    )


def as_results(
    counts: DataFrame, checks: Sequence[Check], *, run_id: Column, run_at: Column
) -> DataFrame:
    """Check history rows from failure counts, for the run that the two columns name."""
    catalog = F.broadcast(catalog_frame(counts.sparkSession, checks))
    failures = F.col("failure_count")
    status = F.when(failures == 0, "pass").when(F.col("warn_only"), "warn").otherwise("fail")
    message = F.when(
        failures > 0,
        F.format_string("Got %d results where 0 are expected: %s", failures, F.col("condition")),
    )
    return counts.join(catalog, "check_name").select(
        run_id.alias("run_id"),
        run_at.cast("timestamp").alias("run_at"),
        F.col("check_name").alias("test_name"),
        "model_name",
        "column_name",
        status.alias("status"),
        status_severity(status, F.col("check_name")).alias("severity"),
        "failure_count",
        F.lit(None).cast("double").alias("execution_time_s"),
        kept_message(message).alias("message"),
        F.lit(None).cast("string").alias("compiled_sql_path"),
    )
