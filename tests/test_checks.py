import datetime as dt

import pytest
from pyspark.sql import functions as F

from plumbline.operators import checks
from plumbline.plans import check_catalog

RUN_AT = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
DAY = dt.datetime(2017, 1, 1)

_FACT = (
    "order_id long, order_item_id long, customer_id long, product_id long, sales double, "
    "is_late int, late_delivery_risk_flag long, delivery_status string, "
    "order_item_quantity long, order_date_id timestamp, ship_date_id timestamp, "
    "days_shipping_real long, days_shipping_scheduled long"
)
_GOOD = (1, 1, 1, 1, 1.0, 0, 0, "Shipping on time", 1, DAY, DAY, 1, 1)
_NAMES = [part.split()[0] for part in _FACT.split(", ")]


@pytest.fixture
def tables(spark):
    def build(*changes):
        rows = [tuple({**dict(zip(_NAMES, _GOOD)), **change}.values()) for change in changes]
        fact = spark.createDataFrame(rows or [_GOOD], _FACT)
        staged = fact.withColumnsRenamed({"order_date_id": "order_date", "ship_date_id": "ship_date"})
        return {
            check_catalog.FACT: fact,
            check_catalog.STAGING: staged,
            check_catalog.CUSTOMERS: spark.createDataFrame(
                [(1, "a@x")], "customer_id long, customer_email string"
            ),
            check_catalog.PRODUCTS: spark.createDataFrame(
                [(1, "shoe")], "product_id long, product_name string"
            ),
            check_catalog.DATES: spark.createDataFrame([(dt.date(2017, 1, 1),)], "date_id date"),
        }

    return build


def failed(tables):
    counts = checks.failure_counts(tables, check_catalog.ALL_CHECKS)
    return {r.check_name: r.failure_count for r in counts.collect() if r.failure_count}


def test_catalog_has_every_check():
    kinds = [check.kind for check in check_catalog.ALL_CHECKS]
    assert len(kinds) == 33 and len({c.name for c in check_catalog.ALL_CHECKS}) == 33
    assert {kind: kinds.count(kind) for kind in set(kinds)} == {
        checks.NOT_NULL: 20,
        checks.UNIQUE: 3,
        checks.ACCEPTED_VALUES: 4,
        checks.RELATIONSHIPS: 2,
        checks.ROW_RULE: 4,
    }


def test_clean_tables_pass_all_checks(tables):
    counts = checks.failure_counts(tables(), check_catalog.ALL_CHECKS)
    assert counts.count() == 33
    assert failed(tables()) == {}


@pytest.mark.parametrize(
    "changes, expected",
    [
        (
            [{"ship_date_id": dt.datetime(2016, 12, 31)}, {"ship_date_id": None}],
            {
                "assert_ship_date_after_order_date": 1,
                "not_null_stg_shipments_ship_date": 1,
            },
        ),
        (
            [{"order_item_quantity": 0}, {"order_item_quantity": -1}, {"order_item_quantity": None}],
            {"assert_no_negative_shipping_quantity": 2},
        ),
        (
            [{"delivery_status": "Lost"}, {"delivery_status": "Lost"}, {"delivery_status": None}],
            {
                "assert_valid_delivery_status": 2,
                "accepted_values_fact_shipments_delivery_status": 1,
                "accepted_values_stg_shipments_delivery_status": 1,
                "not_null_fact_shipments_delivery_status": 1,
                "not_null_stg_shipments_delivery_status": 1,
            },
        ),
        (
            [{"is_late": 1}, {"late_delivery_risk_flag": None}],
            {"assert_late_flag_consistency": 1},
        ),
        (
            [{"is_late": 2, "late_delivery_risk_flag": 2}],
            {
                "accepted_values_fact_shipments_is_late": 1,
                "accepted_values_stg_shipments_is_late": 1,
            },
        ),
        (
            [{"product_id": 9}, {"product_id": 9}, {"customer_id": 8}, {"customer_id": None}],
            {
                "relationships_fact_shipments_product_id": 2,
                "relationships_fact_shipments_customer_id": 1,
                "not_null_fact_shipments_customer_id": 1,
                "not_null_stg_shipments_customer_id": 1,
            },
        ),
    ],
)
def test_faults_are_counted(tables, changes, expected):
    assert failed(tables(*changes)) == expected


def test_repeated_and_missing_keys_of_dimensions(spark, tables):
    found = tables()
    found[check_catalog.PRODUCTS] = spark.createDataFrame(
        [(1, "a"), (1, "b"), (1, "c"), (2, "d"), (2, "e"), (None, None), (None, "f")],
        "product_id long, product_name string",
    )
    assert failed(found) == {
        "unique_dim_products_product_id": 2,
        "not_null_dim_products_product_id": 2,
        "not_null_dim_products_product_name": 1,
    }


def test_failing_rows_of_each_kind(tables):
    found = tables({"order_item_quantity": -2}, {"product_id": 9}, {"delivery_status": "Lost"})
    rows = checks.failing_rows(found, check_catalog.POSITIVE_QUANTITY).collect()
    assert [tuple(r) for r in rows] == [(1, 1, -2)]
    orphans = checks.relationships(check_catalog.FACT, "product_id", check_catalog.PRODUCTS, "product_id")
    assert [r.product_id for r in checks.failing_rows(found, orphans).collect()] == [9]
    status = check_catalog.FACT_CHECKS[-1]
    assert [tuple(r) for r in checks.failing_rows(found, status).collect()] == [("Lost", 1)]
    unique = checks.unique(check_catalog.FACT, "order_id")
    assert [tuple(r) for r in checks.failing_rows(found, unique).collect()] == [(1, 3)]


def test_statuses_and_severities(tables):
    found = tables({"is_late": 1, "order_item_quantity": 0})
    counts = checks.failure_counts(found, check_catalog.ALL_CHECKS)
    results = checks.as_results(
        counts, check_catalog.ALL_CHECKS, run_id=F.lit("r"), run_at=F.lit(RUN_AT)
    )
    by_name = {r.test_name: r for r in results.collect()}
    assert len(by_name) == 33
    late = by_name["assert_late_flag_consistency"]
    assert (late.status, late.severity, late.failure_count) == ("warn", "warning", 1)
    quantity = by_name["assert_no_negative_shipping_quantity"]
    assert (quantity.status, quantity.severity) == ("fail", "critical")
    assert "order_item_quantity <= 0" in quantity.message
    sound = by_name["unique_dim_dates_date_id"]
    assert (sound.status, sound.severity, sound.message) == ("pass", "info", "")


def test_counts_per_run_come_from_one_aggregate(spark):
    rows = [("a", 1), ("a", None), ("b", 3), ("b", -1), ("b", None)]
    df = spark.createDataFrame(rows, "run string, x int")
    rules = [checks.not_null("t", "x"), checks.row_rule("positive", "t", "x <= 0", ["x"])]
    counts = checks.row_failure_counts(df, rules, by=["run"])
    assert {(r.run, r.check_name): r.failure_count for r in counts.collect()} == {
        ("a", "not_null_t_x"): 1,
        ("a", "positive"): 0,
        ("b", "not_null_t_x"): 1,
        ("b", "positive"): 1,
    }
    assert counts._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1


def test_hot_foreign_key_is_counted_before_it_is_joined(spark):
    child = spark.range(9_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 50).alias("k")
    )
    parent = spark.range(50).select(F.col("id").alias("k"))
    orphans = checks.orphan_keys(child, "k", parent, "k")
    assert [tuple(r) for r in orphans.collect()] == [(-1, 3000)]
    plan = orphans._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftOuter") < plan.index("Aggregate")
