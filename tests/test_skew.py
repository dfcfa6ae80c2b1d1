"""One key holds a third of the rows."""

import pytest
from pyspark.sql import functions as F

from plumbline.operators.latest import first_per_key

ROWS = 120_000
HOT = 0


@pytest.fixture
def small_thresholds(spark):
    """What counts as skew, scaled down to test data."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    }
    before = {key: spark.conf.get(key) for key in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_hot_order_is_split_although_the_window_reuses_the_join(spark, small_thresholds, tmp_path):
    line = F.col("id")
    # Spread over many files, as map outputs can only be split between them.
    spark.range(ROWS).select(
        F.when(line % 3 == 0, HOT).otherwise(line).alias("order_id"),
        (line % 40_000).alias("item_id"),
        F.sha2(line.cast("string"), 256).alias("text"),
        line.alias("line"),
    ).repartition(32).write.parquet(str(tmp_path / "lines"))
    lines = spark.read.parquet(str(tmp_path / "lines"))
    orders = spark.range(ROWS).select(line.alias("o_id"), (line % 7).alias("day"))
    joined = lines.join(orders, lines.order_id == orders.o_id, "left")
    kept = first_per_key(joined, ["order_id", "item_id"], ["day", "line"]).select(
        "order_id", "item_id", "line", "text", "day"
    )
    expected = spark.range(ROWS).select(
        F.when(line % 3 == 0, HOT).otherwise(line).alias("order_id"),
        (line % 40_000).alias("item_id"),
        line.alias("line"),
    )
    expected = expected.groupBy("order_id", "item_id").agg(F.min("line").alias("line"))
    rows = kept.select("order_id", "item_id", "line")
    assert rows.exceptAll(expected).isEmpty() and expected.exceptAll(rows).isEmpty()
    kept._jdf.queryExecution().toRdd().count()
    assert "skew=true" in kept._jdf.queryExecution().executedPlan().toString()
