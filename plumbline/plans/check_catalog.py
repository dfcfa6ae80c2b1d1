"""The checks of the shipment star schema."""

from __future__ import annotations

from plumbline.operators.checks import (
    Check,
    accepted_values,
    not_null,
    relationships,
    row_rule,
    unique,
)

# The delivery statuses and flags that may occur.
DELIVERY_STATUSES = (
    "Advance shipping",
    "Late delivery",
    "Shipping on time",
    "Shipping canceled",
)
FLAGS = (0, 1)

STAGING = "stg_shipments"
FACT = "fact_shipments"
CUSTOMERS = "dim_customers"
PRODUCTS = "dim_products"
DATES = "dim_dates"

_ITEM = ("order_id", "order_item_id")

SHIP_AFTER_ORDER = row_rule(
    "assert_ship_date_after_order_date",
    FACT,
    "ship_date_id < order_date_id",
    (*_ITEM, "order_date_id", "ship_date_id"),
)
POSITIVE_QUANTITY = row_rule(
    "assert_no_negative_shipping_quantity",
    FACT,
    "order_item_quantity <= 0",
    (*_ITEM, "order_item_quantity"),
)
KNOWN_DELIVERY_STATUS = row_rule(
    "assert_valid_delivery_status",
    FACT,
    f"delivery_status NOT IN ({', '.join(map(repr, DELIVERY_STATUSES))})",
    (*_ITEM, "delivery_status"),
)
# The delivered risk flag is also set for canceled orders, so disagreement is known debt.
LATE_FLAG_CONSISTENCY = row_rule(
    "assert_late_flag_consistency",
    FACT,
    "is_late <> late_delivery_risk_flag",
    (
        *_ITEM,
        "is_late",
        "late_delivery_risk_flag",
        "delivery_status",
        "days_shipping_real",
        "days_shipping_scheduled",
    ),
    warn_only=True,
)

ROW_RULES = (SHIP_AFTER_ORDER, POSITIVE_QUANTITY, KNOWN_DELIVERY_STATUS, LATE_FLAG_CONSISTENCY)

STAGING_CHECKS = (
    not_null(STAGING, "order_id"),
    not_null(STAGING, "order_item_id"),
    not_null(STAGING, "ship_date"),
    not_null(STAGING, "order_date"),
    not_null(STAGING, "delivery_status"),
    accepted_values(STAGING, "delivery_status", DELIVERY_STATUSES),
    not_null(STAGING, "is_late"),
    accepted_values(STAGING, "is_late", FLAGS),
    not_null(STAGING, "customer_id"),
    not_null(STAGING, "product_id"),
)

FACT_CHECKS = (
    not_null(FACT, "order_id"),
    not_null(FACT, "order_item_id"),
    not_null(FACT, "customer_id"),
    relationships(FACT, "customer_id", CUSTOMERS, "customer_id"),
    not_null(FACT, "product_id"),
    relationships(FACT, "product_id", PRODUCTS, "product_id"),
    not_null(FACT, "sales"),
    not_null(FACT, "is_late"),
    accepted_values(FACT, "is_late", FLAGS),
    not_null(FACT, "delivery_status"),
    accepted_values(FACT, "delivery_status", DELIVERY_STATUSES),
)

DIMENSION_CHECKS = (
    unique(CUSTOMERS, "customer_id"),
    not_null(CUSTOMERS, "customer_id"),
    not_null(CUSTOMERS, "customer_email"),
    unique(PRODUCTS, "product_id"),
    not_null(PRODUCTS, "product_id"),
    not_null(PRODUCTS, "product_name"),
    unique(DATES, "date_id"),
    not_null(DATES, "date_id"),
)

ALL_CHECKS: tuple[Check, ...] = (
    *STAGING_CHECKS,
    *FACT_CHECKS,
    *DIMENSION_CHECKS,
    *ROW_RULES,
)
