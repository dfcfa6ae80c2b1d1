import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import seed
from plumbline.plans import marts
from plumbline.plans.staging import staging
from plumbline.sources.contracts import shipment_contract


@pytest.fixture
def raw(spark):
    def build(rows):
        names = shipment_contract().column_names
        schema = ", ".join(f"`{name}` string" for name in names)
        return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema)

    return build


def test_staging_types_and_flags(raw):
    rows = seed.rows(3)
    rows[0] |= {"Days for shipping (real)": "10", "Days for shipment (scheduled)": "9"}
    rows[1] |= {"Days for shipping (real)": None, "Market": "  USCA ", "Sales": "12.345"}
    rows[2] |= {"Order Quantity": "x", "Order Item Quantity": "x"}
    staged = staging(raw(rows))
    assert len(staged.columns) == 48
    a, b, c = staged.orderBy("order_id").collect()
    # As numbers 10 is more than 9, as text it is not.
    assert (a.is_late, b.is_late, c.is_late) == (1, 0, 0)
    assert (b.days_shipping_real, b.market, str(b.sales)) == (None, "USCA", "12.35")
    assert c.order_item_quantity is None
    assert a.ship_date == dt.datetime(2016, 4, 13, 9, 30)
    assert dict(staged.dtypes)["latitude"] == "decimal(10,6)"


def test_days_late_is_floored_and_unknown_stays_unknown(raw):
    rows = seed.rows(3)
    rows[0] |= {"Days for shipping (real)": "6"}
    rows[1] |= {"Days for shipping (real)": None}
    items = marts.order_items(staging(raw(rows))).orderBy("order_id").collect()
    assert [i.days_late for i in items] == [2, None, 0]
    assert len(items[0]) == 30


def test_duplicates_keep_the_earliest_and_the_result_ignores_row_order(spark, raw):
    rows = []
    for i, row in enumerate(seed.rows(8)):
        later = row | {"order date (DateOrders)": "05/01/2017 12:00", "Sales": "1.00"}
        tied = row | {"Sales": f"{100 + i}.00", "Order City": "Albany"}
        rows += [later, row, tied]
    first = None
    for attempt in range(3):
        random.Random(attempt).shuffle(rows)
        shuffled = raw(rows).repartition(1 + 3 * attempt)
        items = marts.order_items(staging(shuffled)).orderBy("order_id").collect()
        assert len(items) == 8
        assert all(i.order_date == dt.datetime(2016, 4, 10, 9, 30) for i in items)
        first = first or items
        assert items == first


def test_fact_renames_the_dates(raw):
    fact = marts.fact_shipments(marts.order_items(staging(raw(seed.rows(2)))))
    assert tuple(fact.columns) == marts.FACT_COLUMNS and len(fact.columns) == 29
    assert fact.first().order_date_id == dt.datetime(2016, 4, 10, 9, 30)


def test_dimensions_take_the_latest_attributes(raw):
    old, new = seed.rows(1)[0], seed.rows(1)[0]
    new |= {
        "Order Id": "2",
        "order date (DateOrders)": "2/1/2017 0:00",
        "Customer City": "Boston",
        "Product Price": "99.99",
    }
    undated = old | {"Order Id": "3", "order date (DateOrders)": "unknown", "Customer City": "?"}
    staged = staging(raw([new, old, undated]))
    customer = marts.dim_customers(staged).collect()
    assert [c.customer_city for c in customer] == ["Boston"]
    assert str(marts.dim_products(staged).first().product_price) == "99.99"
    assert tuple(marts.dim_products(staged).columns) == marts.PRODUCT_COLUMNS


def test_a_hot_key_leaves_each_task_as_one_row(spark):
    """A key with a third of the rows shrinks before the shuffle."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("customer_id"),
        F.col("id").alias("order_date"),
    )
    latest = marts.latest_rows(rows.repartition(8), "customer_id", ["order_date"])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    partial, exchange = plan.find("row_number(), 1, Partial"), plan.rfind("Exchange hash")
    assert partial > exchange > 0  # children are printed below their parents
    assert latest.count() == 20_000
    assert latest.filter("customer_id = 7").first().order_date == 29_997
