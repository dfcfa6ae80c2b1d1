"""Bounded samples to fit models on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def least_hashes(found: int, limit: int) -> int:
    """A value that hashes up to which are left about twice as often as ``limit`` asks for, where
    some ``found`` occur. An estimate that is off by 5 % still leaves enough, practically always."""
    return (1 << 63) - 1 if found <= 4 * limit else -(1 << 63) + (limit << 65) // found


def least_hashed(rows: DataFrame, columns: Sequence[str], limit: int, seed: int = 0) -> DataFrame:
    """The ``limit`` rows of ``rows`` whose hash of ``columns`` is least, or all if there are fewer.

    Rows that agree in ``columns`` count once, nulls included; which of them stays is open where
    the others differ. ``limit`` bounds the result but not what all tasks hold, so a first pass
    estimates how many rows there are, and about twice as many as wanted go on, whatever the
    number of tasks.
    """
    hashed = rows.withColumn("__hash", F.xxhash64(*columns, F.lit(seed)))
    found = hashed.agg(F.approx_count_distinct("__hash")).first()[0]
    hashed = hashed.filter(F.col("__hash") <= least_hashes(found, limit))
    once = hashed.groupBy("__hash").agg(F.first(F.struct(*rows.columns)).alias("row"))
    return once.orderBy("__hash").limit(limit).select("row.*")
