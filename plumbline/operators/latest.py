"""One row per key, chosen by a stated order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Keep the first row of each key.

    ``order`` has to decide every tie, or the choice between equal rows is open. Spark keeps
    one row per key and task before the shuffle, so a key that holds a large share of the rows
    costs no task more than the others.
    """
    ranked = df.withColumn(
        _RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)


def top_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], rows: int
) -> DataFrame:
    """Keep the first ``rows`` rows of each key."""
    ranked = df.withColumn(
        _RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return ranked.filter(F.col(_RANK) <= rows).drop(_RANK)


def of_latest_run(history: DataFrame) -> DataFrame:
    """Rows of the run with the greatest ``run_at``; of runs at the same time, the one with the
    greatest ``run_id``.

    One scan: each task keeps the rows of its own latest run, and only these meet in one task.
    """
    newest = Window.orderBy(F.col("run_at").desc_nulls_last(), F.col("run_id").desc_nulls_last())
    return history.withColumn(_RANK, F.rank().over(newest)).filter(F.col(_RANK) == 1).drop(_RANK)
