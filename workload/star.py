"""The order tables read as shipments.

A line keeps its row when its order, customer or part is unknown, so that the checks can see it.
Joins that a query does not need are left out; the columns they would fill are null then.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.parsing import named
from plumbline.operators.latest import first_per_key
from plumbline.plans import marts
from plumbline.plans.staging import STAGING_COLUMNS, late_flag

# Decide between lines with the same order, item and date: every column that can differ, so that
# only equal lines are left. Once as the lines name them and once as staging does.
_LINE_COLUMNS = (
    "l_partkey",
    "l_suppkey",
    "l_shipdate",
    "l_extendedprice",
    "l_quantity",
    "l_discount",
    "l_tax",
    "l_returnflag",
)
LINE_TIEBREAK = (
    "product_id",
    "supplier_id",
    "ship_date",
    "sales",
    "order_item_quantity",
    "order_item_discount_rate",
    "order_profit",
    "transaction_type",
)


# Schemas of the tables, so that no job has to look them up in the files.
_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


# Attributes that come with the customer and with the part, and their types.
_CUSTOMER_ATTRIBUTES = {
    "customer_first_name": ("substring_index(c_name, '#', 1)", "string"),
    "customer_last_name": ("c_name", "string"),
    "customer_email": ("lower(replace(c_name, '#', '.')) || '@mail.test'", "string"),
    "customer_segment": ("c_mktsegment", "string"),
    "customer_city": ("n_name", "string"),
    "customer_state": ("n_name", "string"),
    "customer_country": ("r_name", "string"),
    "customer_street": ("c_custkey || ' Main Street'", "string"),
    "customer_zipcode": ("10000 + c_custkey % 90000", "decimal(10,0)"),
    "market": ("r_name", "string"),
    "order_region": ("n_name", "string"),
    "order_country": ("n_name", "string"),
    "order_state": ("n_name", "string"),
    "order_city": ("n_name", "string"),
    "latitude": ("n_nationkey", "decimal(10,6)"),
    "longitude": ("-n_nationkey", "decimal(10,6)"),
}
_PRODUCT_ATTRIBUTES = {
    "order_item_product_price": ("p_retailprice", "decimal(12,2)"),
    "product_name": ("p_name", "string"),
    "product_price": ("p_retailprice", "decimal(12,2)"),
    "product_status": ("p_partkey * 0", "bigint"),
    "category_id": ("length(p_type) * 100 + ascii(p_type)", "bigint"),
    "category_name": ("p_type", "string"),
    "department_id": ("substring_index(p_brand, '#', -1)", "bigint"),
    "department_name": ("p_brand", "string"),
}


def _attributes(attributes: dict[str, tuple[str, str]]) -> dict[str, Column]:
    """From the columns of the tables; null where a line has no customer or part."""
    return {name: F.expr(text).cast(kind) for name, (text, kind) in attributes.items()}


def _absent(attributes: dict[str, tuple[str, str]]) -> dict[str, Column]:
    return {name: F.lit(None).cast(kind) for name, (_, kind) in attributes.items()}


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their nation, as far as the attributes are made from them."""
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    customers = table(spark, sf_dir, "customer").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    return customers.select("c_custkey", "c_name", "c_mktsegment", "n_nationkey", "n_name", "r_name")


def customer_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customers(spark, sf_dir).withColumns(_attributes(_CUSTOMER_ATTRIBUTES)).select(
        "c_custkey", *_CUSTOMER_ATTRIBUTES
    )


def product_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").withColumns(_attributes(_PRODUCT_ATTRIBUTES)).select(
        "p_partkey", *_PRODUCT_ATTRIBUTES
    )


# Staging columns that are made from the order, with or without columns of the line, and what the
# order gives them.
_WITH_ORDER = (
    "order_customer_id",
    "order_date",
    "days_shipping_real",
    "days_shipping_scheduled",
    "delivery_status",
    "late_delivery_risk_flag",
    "shipping_mode",
    "order_status",
    "customer_id",
)
_ORDER_KINDS = {
    "o_custkey": "bigint",
    "o_orderdate": "timestamp_ntz",
    "o_orderstatus": "string",
    "shipping_mode": "string",
    "days_shipping_scheduled": "bigint",
}


def _orders(spark: SparkSession, sf_dir: str, with_customers: bool) -> DataFrame:
    """Orders, with their customer where asked: joined before the lines are."""
    priority = F.col("o_orderpriority")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderdate",
        "o_orderstatus",
        F.when(priority == "1-URGENT", "Same Day")
        .when(priority == "2-HIGH", "First Class")
        .when(priority == "3-MEDIUM", "Second Class")
        .otherwise("Standard Class")
        .alias("shipping_mode"),
        F.when(priority == "1-URGENT", 0)
        .when(priority == "2-HIGH", 1)
        .when(priority == "3-MEDIUM", 2)
        .otherwise(4)
        .cast("bigint")
        .alias("days_shipping_scheduled"),
    )
    if not with_customers:
        return orders
    return orders.join(_customers(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"), "left")


def _decimal(value: Column, precision: int, scale: int) -> Column:
    return value.cast(f"decimal({precision},{scale})")


def staging(
    spark: SparkSession,
    sf_dir: str,
    *,
    orders: bool = True,
    customers: bool = False,
    products: bool = False,
    unique: bool = False,
    dealt: bool = False,
) -> DataFrame:
    """The staging columns, and ``supplier_id`` to tell lines apart.

    ``unique`` keeps one line per (order, item). Lines of an order share its date, so the columns
    of the line decide. ``dealt`` deals the lines out by supplier and price, in place of their order. Attributes are made after the joins, of which each would shuffle them with
    every line: the few columns that they are made from are much narrower.
    """
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"), "left"
    # The part adds less to a line than order and customer do, so it is joined first; but a line
    # that is dropped needs none.
    if products and not unique:
        lines = lines.join(*parts)
    if orders:
        lines = lines.join(
            _orders(spark, sf_dir, customers), F.col("l_orderkey") == F.col("o_orderkey"), "left"
        )
    else:
        lines = lines.withColumns({name: F.lit(None).cast(kind) for name, kind in _ORDER_KINDS.items()})
    if unique:
        # The join has left the lines of an order together: no shuffle of their own.
        lines = first_per_key(lines, ["l_orderkey", "l_linenumber"], _LINE_COLUMNS)
        if products:
            lines = lines.join(*parts)
    if dealt:
        lines = lines.repartition("l_suppkey", "l_extendedprice")
    attributes = {
        **(_attributes if customers else _absent)(_CUSTOMER_ATTRIBUTES),
        **(_attributes if products else _absent)(_PRODUCT_ATTRIBUTES),
    }

    gap = F.datediff("l_shipdate", "o_orderdate")
    priced = lines.withColumns(
        {
            "days_shipping_real": F.pmod(gap, F.lit(7)).cast("bigint"),
            "canceled": (F.col("o_orderstatus") == "P") & (F.col("l_returnflag") == "R"),
            "sales": _decimal(F.col("l_extendedprice"), 12, 2),
            "discount": _decimal(F.col("l_discount"), 8, 4),
            "margin": _decimal(F.col("l_tax"), 8, 4) - F.lit("0.02").cast("decimal(8,4)"),
        }
    )
    kept_share = F.lit(1).cast("decimal(8,4)") - F.col("discount")
    totaled = priced.withColumns(
        {
            "total": _decimal(F.col("sales") * kept_share, 12, 2),
            "profit": _decimal(F.col("sales") * kept_share * F.col("margin"), 12, 2),
        }
    )
    real, scheduled = F.col("days_shipping_real"), F.col("days_shipping_scheduled")
    late, canceled = real > scheduled, F.col("canceled")
    derived = attributes | {
        "order_id": F.col("l_orderkey"),
        "order_customer_id": F.col("o_custkey"),
        "order_item_id": F.col("l_linenumber").cast("bigint"),
        "order_date": F.col("o_orderdate").cast("timestamp"),
        "ship_date": F.col("l_shipdate").cast("timestamp"),
        "delivery_status": F.when(canceled, "Shipping canceled")
        .when(late, "Late delivery")
        .when(real == scheduled, "Shipping on time")
        .otherwise("Advance shipping"),
        "late_delivery_risk_flag": F.when(late | canceled, 1).otherwise(0).cast("bigint"),
        "transaction_type": F.when(F.col("l_returnflag") == "A", "DEBIT")
        .when(F.col("l_returnflag") == "N", "PAYMENT")
        .otherwise("TRANSFER"),
        "order_status": F.col("o_orderstatus"),
        "order_item_total": F.col("total"),
        "order_profit": F.col("profit"),
        "benefit_per_order": F.col("profit"),
        "order_item_discount": _decimal(F.col("sales") * F.col("discount"), 12, 2),
        "order_item_discount_rate": F.col("discount"),
        "order_item_profit_ratio": _decimal(kept_share * F.col("margin"), 8, 4),
        "order_item_quantity": F.col("l_quantity").cast("bigint"),
        "sales_per_customer": F.col("total"),
        "customer_id": F.col("o_custkey"),
        "product_id": F.col("l_partkey"),
    }
    return totaled.select(
        *[derived.get(name, F.col(name)).alias(name) for name, _, _ in STAGING_COLUMNS],
        late_flag(real, scheduled).alias("is_late"),
        F.col("l_suppkey").alias("supplier_id"),
    )


def fact(
    spark: SparkSession, sf_dir: str, *, customers: bool = False, products: bool = False
) -> DataFrame:
    items = staging(spark, sf_dir, customers=customers, products=products, unique=True)
    return marts.fact_shipments(marts.item_columns(items))


def newest(*rest: str) -> list[Column | str]:
    """Decides between lines of the same date when the newest is wanted."""
    return [F.col("order_id").desc(), F.col("order_item_id").desc(), *rest]


def latest_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's newest line, with the customer's attributes.

    The choice comes first, so that only one row per customer is joined.
    """
    lines = marts.latest_rows(
        staging(spark, sf_dir), "customer_id", newest("product_id", "supplier_id")
    )
    return lines.select("customer_id", "order_id", "order_date").join(
        customer_attributes(spark, sf_dir), F.col("customer_id") == F.col("c_custkey"), "left"
    )


def latest_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each product's newest line, with the product's attributes."""
    lines = marts.latest_rows(staging(spark, sf_dir), "product_id", newest("supplier_id"))
    return lines.select("product_id", "order_id", "order_date").join(
        product_attributes(spark, sf_dir), F.col("product_id") == F.col("p_partkey"), "left"
    )


def _as_raw(staged: DataFrame) -> DataFrame:
    texts = {
        raw_name: F.date_format(name, "MM/dd/yyyy HH:mm")
        if reading == "stamp"
        else F.col(name).cast("string")
        for name, raw_name, reading in STAGING_COLUMNS
    }
    # Columns that staging does not use.
    texts |= {
        "Order Zipcode": F.when(
            F.col("customer_id") % 7 == 0, F.col("customer_zipcode").cast("string")
        ),
        "Order Item Cardprod Id": F.col("product_id").cast("string"),
        "Customer Password": F.lit("XXXXXXXXX"),
        "Product Category Id": F.col("category_id").cast("string"),
        "Product Description": F.lit(None).cast("string"),
        "Product Image": F.concat(F.lit("http://images.test/"), F.col("product_id")),
    }
    return staged.select(*[text.alias(name) for name, text in texts.items()], "supplier_id")


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 53 columns of a delivered snapshot, as the text a CSV file would hold."""
    return _as_raw(staging(spark, sf_dir, customers=True, products=True))


def _keys_repeat(spark: SparkSession, sf_dir: str) -> bool:
    """Whether a line can meet several rows of a table that it is joined to."""
    joined_by = {
        "orders": "o_orderkey",
        "customer": "c_custkey",
        "nation": "n_nationkey",
        "region": "r_regionkey",
        "part": "p_partkey",
    }
    keys = [
        table(spark, sf_dir, name).select(F.lit(k).alias("table"), F.col(key).cast("bigint").alias("key"))
        for k, (name, key) in enumerate(joined_by.items())
    ]
    found = reduce(DataFrame.union, keys).filter("key is not null").groupBy("table", "key").count()
    return not found.filter("count > 1").isEmpty()


def raw_parts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The columns of ``raw`` dealt out to tables that have all its rows each, for work on single
    columns: what the line alone gives, what order and customer give, and what the part gives.

    A line is shuffled with what such a table needs, so never with order, customer and part
    together. Where keys repeat, one join decides how often a line comes in the columns of
    another; the only table is then ``raw``.
    """
    if _keys_repeat(spark, sf_dir):
        return [raw(spark, sf_dir).drop("supplier_id")]
    raw_names = {name: raw_name for name, raw_name, _ in STAGING_COLUMNS}
    of_orders = [raw_names[name] for name in (*_WITH_ORDER, *_CUSTOMER_ATTRIBUTES)] + ["Order Zipcode"]
    of_products = [raw_names[name] for name in _PRODUCT_ATTRIBUTES] + ["Product Category Id"]
    lines = _as_raw(staging(spark, sf_dir, orders=False)).drop("supplier_id", *of_orders, *of_products)
    with_orders = _as_raw(staging(spark, sf_dir, customers=True))
    with_products = _as_raw(staging(spark, sf_dir, orders=False, products=True))
    return [
        lines,
        with_orders.select(*map(named, of_orders)),
        with_products.select(*map(named, of_products)),
    ]


def with_faults(delivered: DataFrame) -> DataFrame:
    """A delivery with something wrong of every kind that a contract check looks for; of one of the
    ``raw_parts``, what is wrong in its columns."""
    item = named("Order Item Id")
    faults = {
        "Sales": F.when(item.isin("1", "2"), "pending").otherwise(F.col("Sales")),
        "Order Item Quantity": F.when(item == "3", "1.5").otherwise(named("Order Item Quantity")),
        "shipping date (DateOrders)": F.when(item != "7", named("shipping date (DateOrders)")),
        "Order Country": F.lit("2020-02-29"),
    }
    new = {"Carrier Note": F.lit("by road")} if "Order Item Id" in delivered.columns else {}
    return delivered.drop("Order Zipcode", "Order Region", "supplier_id").withColumns(
        new | {name: value for name, value in faults.items() if name in delivered.columns}
    )
