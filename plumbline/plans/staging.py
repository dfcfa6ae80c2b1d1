"""Raw text columns to typed, renamed staging columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.parsing import decimal_number, named, stamp, whole_number

# Staging column, raw column, and how its text is read.
# whole = bigint, decimal(p,s), stamp = timestamp, text = trimmed.
_STAGING_COLUMNS = """
order_id | Order Id | whole
order_customer_id | Order Customer Id | whole
order_item_id | Order Item Id | whole
order_date | order date (DateOrders) | stamp
ship_date | shipping date (DateOrders) | stamp
days_shipping_real | Days for shipping (real) | whole
days_shipping_scheduled | Days for shipment (scheduled) | whole
delivery_status | Delivery Status | text
late_delivery_risk_flag | Late_delivery_risk | whole
shipping_mode | Shipping Mode | text
transaction_type | Type | text
order_status | Order Status | text
sales | Sales | decimal(12,2)
order_item_total | Order Item Total | decimal(12,2)
order_profit | Order Profit Per Order | decimal(12,2)
benefit_per_order | Benefit per order | decimal(12,2)
order_item_discount | Order Item Discount | decimal(12,2)
order_item_discount_rate | Order Item Discount Rate | decimal(8,4)
order_item_product_price | Order Item Product Price | decimal(12,2)
order_item_profit_ratio | Order Item Profit Ratio | decimal(8,4)
order_item_quantity | Order Item Quantity | whole
sales_per_customer | Sales per customer | decimal(12,2)
customer_id | Customer Id | whole
customer_first_name | Customer Fname | text
customer_last_name | Customer Lname | text
customer_email | Customer Email | text
customer_segment | Customer Segment | text
customer_city | Customer City | text
customer_state | Customer State | text
customer_country | Customer Country | text
customer_street | Customer Street | text
customer_zipcode | Customer Zipcode | decimal(10,0)
product_id | Product Card Id | whole
product_name | Product Name | text
product_price | Product Price | decimal(12,2)
product_status | Product Status | whole
category_id | Category Id | whole
category_name | Category Name | text
department_id | Department Id | whole
department_name | Department Name | text
market | Market | text
order_region | Order Region | text
order_country | Order Country | text
order_state | Order State | text
order_city | Order City | text
latitude | Latitude | decimal(10,6)
longitude | Longitude | decimal(10,6)
"""

STAGING_COLUMNS = tuple(
    tuple(part.strip() for part in line.split("|"))
    for line in _STAGING_COLUMNS.strip().splitlines()
)


def _read_as(raw_name: str, reading: str) -> Column:
    raw = named(raw_name)
    if reading == "whole":
        return whole_number(raw)
    if reading == "stamp":
        return stamp(raw)
    if reading == "text":
        return F.trim(raw)
    precision, scale = reading.removeprefix("decimal(").removesuffix(")").split(",")
    return decimal_number(raw, int(precision), int(scale))


def late_flag(real_days: Column, scheduled_days: Column) -> Column:
    """1 where shipping took longer than scheduled; 0 also where either is unknown."""
    return F.when(real_days > scheduled_days, 1).otherwise(0)


def staging(raw: DataFrame) -> DataFrame:
    """The raw table, typed and renamed; nothing is filtered, joined or aggregated.

    The late flag comes from the days and not from the delivered risk flag, so that the two
    can be held against each other later.
    """
    typed = raw.select(
        *[_read_as(raw_name, reading).alias(name) for name, raw_name, reading in STAGING_COLUMNS]
    )
    return typed.withColumn(
        "is_late", late_flag(F.col("days_shipping_real"), F.col("days_shipping_scheduled"))
    )
