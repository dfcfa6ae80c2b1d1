"""What keeps shuffles, deliveries and profiles small as the tables grow."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401
from plumbline.operators import profile
from plumbline.sources import snapshots
from workload import checking, registry, runs, star

SF_DIR = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")


@pytest.mark.parametrize("made", ["customer_email", "customer_street", "category_id", "department_id"])
def test_attributes_are_made_after_all_shuffles(spark, no_broadcast, made):
    staged = star.staging(spark, SF_DIR, customers=True, products=True)
    shuffled = _plan(staged).split("Exchange ", 1)[1]
    assert f"AS {made}#" not in shuffled


def test_lines_without_customer_or_part_have_no_attributes(spark, tmp_path):
    def store(name, rows):
        spark.createDataFrame(rows, star._SCHEMAS[name]).write.parquet(f"{tmp_path}/{name}.parquet")

    line = (2, 1.0, 10.0, 0.0, 0.02, "N", "O", None)
    store("lineitem", [(1, 1, 1, *line), (2, 8, 1, *line), (3, 1, 1, *line)])
    store("orders", [(1, 1, "O", 1.0, None, "1-URGENT"), (2, 9, "O", 1.0, None, "5-LOW")])
    store("customer", [(1, "Customer#1", 0, 1.0, "AUTO"), (1, "Customer#1", 0, 1.0, "AUTO")])
    store("part", [(1, "hot bolt", "Brand#7", "LARGE", 1, 2.0)])
    store("nation", [(0, "PERU", 5)])
    store("region", [(1, "ASIA")])
    found = star.staging(spark, str(tmp_path), customers=True, products=True)
    rows = found.select(
        "order_id", "customer_street", "customer_city", "market", "shipping_mode", "category_id", "product_name"
    ).collect()
    known = (1, "1 Main Street", "PERU", None, "Same Day", 576, "hot bolt")
    assert sorted(map(tuple, rows)) == [
        known,
        known,
        (2, None, None, None, "Standard Class", None, None),
        (3, None, None, None, None, 576, "hot bolt"),
    ]


@pytest.mark.parametrize("name", ["column_profile", "schema_drift"])
def test_profiled_lines_are_not_shuffled_with_order_and_part_together(spark, no_broadcast, name):
    lines = _plan(registry.QUERIES[name](spark, SF_DIR)).splitlines()
    assert any("p_name#" in line for line in lines) and any("o_orderstatus#" in line for line in lines)
    assert not any("p_name#" in line and "o_orderstatus#" in line for line in lines)


@pytest.mark.parametrize("repeated", [None, "orders", "customer", "part", "nation", "region"])
def test_the_parts_of_a_delivery_are_profiled_as_the_whole(spark, tmp_path, repeated):
    """Lines with unknown and null keys; rows that come twice, and so do the lines that meet them."""

    def store(name, rows):
        rows = rows + rows[:1] * (name == repeated)
        spark.createDataFrame(rows, star._SCHEMAS[name]).write.parquet(f"{tmp_path}/{name}.parquet")

    day = dt.datetime(2020, 1, 5)
    line = (1, 3.0, 10.5, 0.1, 0.04, "N", "O", day)
    keys = [(1, 1, 1), (1, 2, 2), (2, 1, 3), (3, 9, 7), (9, 1, 2), (None, None, 1), (4, None, None)]
    store("lineitem", [(order, part, 1, item, *line[1:]) for order, part, item in keys])
    customers = [1, 2, 9, None]
    store("orders", [(k + 1, c, "OFPO"[k], 1.0, day if k else None, "1-URGENT") for k, c in enumerate(customers)] + [(None, 1, "O", 1.0, day, "5-LOW")] * 2)
    store("customer", [(1, "Customer#1", 0, 1.0, "AUTO"), (2, "Customer#2", None, 1.0, None), (None, "x", 0, 1.0, "AUTO")])
    store("part", [(1, "hot bolt", "Brand#7", "LARGE", 1, 2.5), (2, None, "Brand#8", None, 1, None)])
    store("nation", [(0, "PERU", 1), (1, "CHAD", 1)])
    store("region", [(1, "ASIA")])
    whole = star.raw(spark, str(tmp_path)).drop("supplier_id")
    parts = star.raw_parts(spark, str(tmp_path))
    assert len(parts) == (1 if repeated else 3)
    assert sorted(c for part in parts for c in part.columns) == sorted(whole.columns)
    if repeated not in (None, "part"):
        return
    for change in (lambda df: df, star.with_faults):
        columns = [c for c in change(whole).columns if c != "Carrier Note"]
        expected = profile.column_profile(change(whole), columns).collect()
        found = profile.column_profile_of_parts([change(part) for part in parts], columns).collect()
        assert sorted(found) == sorted(expected) and len(found) == len(columns)


def test_a_build_is_dealt_out_to_as_many_tasks_as_the_session_has(spark):
    assert "REPARTITION_BY_NUM" not in _plan(registry.QUERIES["repeated_build"](spark, SF_DIR))


def test_lines_are_dealt_out_before_their_attributes_are_made(spark, no_broadcast):
    above = _plan(registry.QUERIES["repeated_build"](spark, SF_DIR)).split("REPARTITION_BY_COL", 1)
    assert "hashpartitioning(l_suppkey#" in above[0][-400:]
    dealt = star.staging(spark, SF_DIR, customers=True, products=True, dealt=True)
    assert "market#" not in _plan(dealt).split("REPARTITION_BY_COL", 1)[1]


def test_places_of_rows_cost_no_copy_of_the_row(spark, tmp_path):
    """Columns of ``_metadata`` are added to each row, which copies it."""
    (tmp_path / "a b.csv").write_text("a,b\n1,2\n3\n")
    text = snapshots.read_snapshot(spark, str(tmp_path), keep_malformed=True)
    placed = snapshots.with_place(text)
    assert "_metadata" not in _plan(placed) and "file_path" not in _plan(placed)
    stored = spark.createDataFrame(placed.toArrow())
    (found,) = snapshots.rejects(stored, 2).collect()
    expected = spark.read.text(str(tmp_path)).select("_metadata.file_path").first()[0]
    assert (found.file, found.record, found.text) == (expected, 2, "3")


def test_deliveries_are_compressed(spark, tmp_path):
    path = runs._deliver(spark.range(3).select(F.col("id").cast("string")), f"{tmp_path}/delivered")
    parts = [name for name in os.listdir(path) if name.startswith("part-")]
    assert parts and all(name.endswith(".csv.gz") for name in parts)


def test_loaded_deliveries_are_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(runs, "shared_folder", lambda spark: str(tmp_path))
    registry.QUERIES["csv_snapshot"](spark, SF_DIR).count()
    left = [name.split("-")[0] for name in os.listdir(tmp_path)]
    assert left == ["raw"]


def test_values_are_counted_without_a_copy_of_the_row_each(spark):
    texts = spark.createDataFrame([("1", None)], "a string, b string")
    assert not re.search(r"\bExpand\b", _plan(profile.column_counts(texts)))


def test_the_kind_of_odd_texts(spark):
    kinds = {
        "0": "BITS", " 1 ": "BITS", "\t1": "WHOLE", "12": "WHOLE", "1" * 19: "WHOLE", "900.00": "WHOLE",
        "1.5": "FRACTION", "-.5": "FRACTION", "900.10": "FRACTION", "1.5\n": "FRACTION", "1e-3": "FRACTION",
        "123456789012.00000000001": "WHOLE", "-inf": "FRACTION", "1e999": "TEXT", "1.5x": "TEXT",
        "2020-02-30": "TEXT", "2020/02/29": "DATE", "13/1/2020": "DATE", " 1/2/2020 3:04": "DATE",
        "13/13/2020": "TEXT", "1/2": "TEXT", "t/f": "TEXT", "2020-02-29T10:00Z": "DATE", "Yes": "BOOLEANS",
        "": "TEXT", "\x0b7": "WHOLE", "\xa07": "TEXT", "tool": "TEXT", "+": "TEXT", ".": "TEXT", "1.": "WHOLE",
    }
    rows = spark.createDataFrame([(text,) for text in kinds], "value string")
    found = dict(rows.select("value", profile.value_kind(F.col("value"))).collect())
    assert found == {text: getattr(profile, f"_{kind}") for text, kind in kinds.items()}


def test_whole_numbers_and_words_need_few_patterns(spark):
    kinds = {
        "901.00": "WHOLE", "-0.0": "WHOLE", "9" * 300 + ".0": "WHOLE", "9" * 309 + ".0": "TEXT", "1..0": "TEXT",
        "First Class": "TEXT", "F": "BOOLEANS", "no\t": "BOOLEANS", "Infinity ": "FRACTION", "Inform": "TEXT",
    }
    rows = spark.createDataFrame([(text,) for text in kinds], "value string")
    kind = profile.value_kind(F.col("value"))
    assert dict(rows.select("value", kind).collect()) == {text: getattr(profile, f"_{k}") for text, k in kinds.items()}
    # A word is told before the patterns of numbers, and a whole number before it is parsed.
    shown = rows.select(kind)._jdf.queryExecution().analyzed().toString()
    assert shown.index(profile._WORD) < shown.index(profile._DIGITS)
    assert shown.index(profile._PLAIN_WHOLE) < shown.index(profile._NUMBER)


def test_a_task_of_the_checks_reads_the_same_however_large_the_models_are(spark, tmp_path):
    settings = {
        "spark.sql.files.maxPartitionBytes": "128MB",
        "spark.sql.files.minPartitionNum": "1",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8",
    }
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        checking.star_tables(spark, SF_DIR)
        # Each file counts as 4 MB at least.
        spark.range(0, 24, 1, 24).write.parquet(f"{tmp_path}/files")
        read = spark.read.parquet(f"{tmp_path}/files").select(F.spark_partition_id())
        assert read.distinct().count() > 2
        assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") == "200"
    finally:
        for key in settings:
            spark.conf.unset(key)
