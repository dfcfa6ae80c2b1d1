"""The business reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.plans import marts, reports
from workload import star
from workload.registry import query
from workload.sql import over

_LATE = "count(*) FILTER (delivery_status = 'Late delivery')"
_LATE_RATE = f"round({_LATE} * 100.0 / count(*), 2)"
_SALES = "CAST(round(sum(sales), 2) AS DOUBLE)"
_PROFIT = "CAST(round(sum(order_profit), 2) AS DOUBLE)"


@query(
    "revenue_by_market",
    over(
        "fact",
        select=f"""
        SELECT market, {_SALES} AS total_revenue, {_PROFIT} AS net_profit,
            count(*) AS order_count
        FROM fact GROUP BY market ORDER BY total_revenue DESC
        """,
    ),
)
def revenue_by_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.revenue_by_market(star.fact(spark, sf_dir, customers=True))


@query(
    "late_rate_by_shipping",
    over(
        "fact",
        select=f"""
        SELECT shipping_mode, count(*) AS total_shipments, {_LATE} AS late_shipments,
            round(avg(days_shipping_real), 2) AS avg_real_days,
            round(avg(days_shipping_scheduled), 2) AS avg_scheduled_days,
            {_LATE_RATE} AS late_rate
        FROM fact GROUP BY shipping_mode
        """,
    ),
)
def late_rate_by_shipping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.late_rate_by_shipping(star.fact(spark, sf_dir))


@query(
    "late_rate_by_flag",
    over(
        "fact",
        select="""
        SELECT shipping_mode, count(*) AS total_orders, avg(is_late) * 100 AS late_rate_pct
        FROM fact GROUP BY shipping_mode
        """,
    ),
)
def late_rate_by_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.late_rate_by_flag(star.fact(spark, sf_dir))


@query(
    "overall_late_rate",
    over(
        "fact",
        select="""
        SELECT round(100.0 * sum(is_late) / count(*), 6) AS avg_late_rate FROM fact
        """,
    ),
)
def overall_late_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_mode = reports.late_rate_by_flag(star.fact(spark, sf_dir))
    overall = reports.overall_late_rate(by_mode, "late_rate_pct", "total_orders")
    return overall.select(F.round("avg_late_rate", 6).alias("avg_late_rate"))


@query(
    "order_status_counts",
    over(
        "fact",
        select="""
        SELECT order_status, count(*) AS total_orders
        FROM fact GROUP BY order_status ORDER BY total_orders DESC
        """,
    ),
)
def order_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.order_status_counts(star.fact(spark, sf_dir))


_BY_CATEGORY = f"""
    SELECT products.category_name, {_SALES.replace("sales", "fact.sales")} AS total_sales,
        {_PROFIT.replace("order_profit", "fact.order_profit")} AS net_profit
    FROM fact JOIN products ON fact.product_id = products.product_id
    GROUP BY products.category_name
"""


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.latest_products(spark, sf_dir).select(*marts.PRODUCT_COLUMNS)


@query(
    "top_categories",
    over(
        "fact",
        "products",
        select=f"{_BY_CATEGORY} ORDER BY total_sales DESC, category_name LIMIT 4",
    ),
)
def top_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four of the six categories, so that the limit of the report shows."""
    return reports.top_categories(star.fact(spark, sf_dir), _products(spark, sf_dir), limit=4)


@query(
    "category_margins",
    over(
        "fact",
        "products",
        select=f"""
        SELECT category_name, total_sales, net_profit / total_sales * 100 AS profit_margin_pct
        FROM ({_BY_CATEGORY}) ORDER BY total_sales DESC LIMIT 6
        """,
    ),
)
def category_margins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.category_margins(star.fact(spark, sf_dir), _products(spark, sf_dir))


@query(
    "category_display",
    over(
        "fact",
        "products",
        select=f"""
        SELECT category_name AS "Category", total_sales AS "Sales", net_profit AS "Profit",
            round(net_profit / total_sales * 100, 1) AS "Profit Margin (%)"
        FROM ({_BY_CATEGORY})
        """,
    ),
)
def category_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_category = reports.sales_by_category(star.fact(spark, sf_dir), _products(spark, sf_dir))
    return reports.for_display(by_category, "categories")


@query(
    "kpi_summary",
    over(
        "fact",
        select=f"""
        SELECT count(*) AS total_shipments, {_SALES} AS total_revenue, {_PROFIT} AS total_profit,
            {_LATE_RATE} AS late_rate
        FROM fact
        """,
    ),
)
def kpi_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.kpi_summary(star.fact(spark, sf_dir))


@query(
    "grand_totals",
    over(
        "fact",
        select=f"""
        SELECT {_SALES} AS total_sales, {_PROFIT} AS total_profit, count(*) AS total_orders
        FROM fact
        """,
    ),
)
def grand_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_market = reports.revenue_by_market(star.fact(spark, sf_dir, customers=True))
    return reports.grand_totals(by_market)


@query(
    "fact_by_calendar",
    over(
        "fact",
        "dates",
        select=f"""
        SELECT year(date_id) || '-Q' || quarter(date_id) AS year_quarter,
            CAST(CASE WHEN dayofweek(date_id) IN (0, 6) THEN 1 ELSE 0 END AS BIGINT) AS is_weekend,
            count(*) AS total_shipments, {_SALES} AS total_revenue,
            CAST(sum(is_late) AS BIGINT) AS late_shipments
        FROM fact JOIN dates ON CAST(order_date_id AS DATE) = date_id
        GROUP BY 1, 2
        """,
    ),
)
def fact_by_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = marts.dim_dates_covering(star.table(spark, sf_dir, "orders"), "o_orderdate")
    return reports.by_calendar(star.fact(spark, sf_dir), dates, "year_quarter", "is_weekend")
