"""The star schema: order items, the shipment fact and its dimensions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import calendar
from plumbline.operators.latest import first_per_key

# The columns of each model, and the span of the calendar.
ORDER_ITEM_COLUMNS = (
    "order_id",
    "order_item_id",
    "order_customer_id",
    "order_date",
    "ship_date",
    "order_status",
    "transaction_type",
    "delivery_status",
    "shipping_mode",
    "is_late",
    "late_delivery_risk_flag",
    "days_shipping_real",
    "days_shipping_scheduled",
    "days_late",
    "sales",
    "order_item_total",
    "order_profit",
    "benefit_per_order",
    "order_item_discount",
    "order_item_discount_rate",
    "order_item_product_price",
    "order_item_profit_ratio",
    "order_item_quantity",
    "customer_id",
    "product_id",
    "category_id",
    "department_id",
    "order_region",
    "order_country",
    "market",
)
FACT_COLUMNS = (
    "order_id",
    "order_item_id",
    "customer_id",
    "product_id",
    "category_id",
    "department_id",
    "order_date_id",
    "ship_date_id",
    "order_status",
    "transaction_type",
    "delivery_status",
    "shipping_mode",
    "order_region",
    "order_country",
    "market",
    "sales",
    "order_item_total",
    "order_profit",
    "benefit_per_order",
    "order_item_discount",
    "order_item_discount_rate",
    "order_item_product_price",
    "order_item_profit_ratio",
    "order_item_quantity",
    "days_shipping_real",
    "days_shipping_scheduled",
    "days_late",
    "is_late",
    "late_delivery_risk_flag",
)
CUSTOMER_COLUMNS = (
    "customer_id",
    "customer_first_name",
    "customer_last_name",
    "customer_email",
    "customer_segment",
    "customer_city",
    "customer_state",
    "customer_country",
    "customer_street",
    "customer_zipcode",
)
PRODUCT_COLUMNS = (
    "product_id",
    "product_name",
    "product_price",
    "product_status",
    "category_id",
    "category_name",
    "department_id",
    "department_name",
)
FIRST_DAY = dt.date(2015, 1, 1)
LAST_DAY = dt.date(2018, 12, 31)


def days_late(real_days: Column, scheduled_days: Column) -> Column:
    """Days beyond schedule, never below 0; null where either is unknown."""
    late = real_days - scheduled_days
    return F.when(late.isNotNull(), F.greatest(late, F.lit(0)))


def _others(staged: DataFrame, *used: str) -> list[str]:
    return [name for name in staged.columns if name not in used]


def order_items(staged: DataFrame, tiebreak: Sequence[Column | str] | None = None) -> DataFrame:
    """One row per (order, item): the earliest ordered.

    ``tiebreak`` decides between rows of the same date. Without one every other column of the
    result does, so that it never depends on the order in which the rows arrive.
    """
    key = ("order_id", "order_item_id")
    if tiebreak is None:
        staged = staged.select(*[name for name in ORDER_ITEM_COLUMNS if name != "days_late"])
        tiebreak = _others(staged, *key, "order_date")
    order = [F.col("order_date").asc_nulls_first(), *tiebreak]
    return item_columns(first_per_key(staged, key, order))


def item_columns(unique_items: DataFrame) -> DataFrame:
    """The order item columns of staging rows that are unique by (order, item) already."""
    late = days_late(F.col("days_shipping_real"), F.col("days_shipping_scheduled"))
    return unique_items.withColumn("days_late", late).select(*ORDER_ITEM_COLUMNS)


def fact_shipments(items: DataFrame) -> DataFrame:
    """Order items as the fact; its dates keep the time of day."""
    return items.withColumnsRenamed(
        {"order_date": "order_date_id", "ship_date": "ship_date_id"}
    ).select(*FACT_COLUMNS)


def latest_rows(
    staged: DataFrame, key: str, tiebreak: Sequence[Column | str] | None = None
) -> DataFrame:
    """The staging row with the latest order date of each key."""
    if tiebreak is None:
        tiebreak = _others(staged, key, "order_date")
    return first_per_key(staged, [key], [F.col("order_date").desc_nulls_last(), *tiebreak])


def dim_customers(
    staged: DataFrame, tiebreak: Sequence[Column | str] | None = None
) -> DataFrame:
    """Customers as last seen; earlier attributes are overwritten."""
    needed = staged if tiebreak else staged.select(*CUSTOMER_COLUMNS, "order_date")
    return latest_rows(needed, "customer_id", tiebreak).select(*CUSTOMER_COLUMNS)


def dim_products(staged: DataFrame, tiebreak: Sequence[Column | str] | None = None) -> DataFrame:
    """Products as last seen; earlier attributes are overwritten."""
    needed = staged if tiebreak else staged.select(*PRODUCT_COLUMNS, "order_date")
    return latest_rows(needed, "product_id", tiebreak).select(*PRODUCT_COLUMNS)


def calendar_of(span: DataFrame) -> DataFrame:
    """Date dimension from one row with the dates ``first_day`` and ``last_day``."""
    return span.select(
        F.explode(F.sequence("first_day", "last_day", F.expr("interval 1 day"))).alias("day")
    ).select(*calendar.attributes(F.col("day")))


def dim_dates(
    spark: SparkSession, first_day: dt.date = FIRST_DAY, last_day: dt.date = LAST_DAY
) -> DataFrame:
    """Date dimension of a stated span, one row per day."""
    span = pa.table({"first_day": [first_day], "last_day": [last_day]})
    return calendar_of(spark.createDataFrame(span))


def dim_dates_covering(df: DataFrame, column: str) -> DataFrame:
    """Date dimension from the first to the last day that a date column holds."""
    return calendar_of(
        df.agg(
            F.to_date(F.min(column)).alias("first_day"), F.to_date(F.max(column)).alias("last_day")
        )
    )
