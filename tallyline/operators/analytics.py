"""Analytics over the keyed sales table: the three views, the summary and
lookup queries, and the dashboard questions.

Money columns in the table are decimals; sums stay exact and are turned into
double once at the end, averages are sum / count in double.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _money_sum(c: str):
    return F.sum(F.col(c)).cast("double")


def _avg(c: str):
    return F.sum(F.col(c)).cast("double") / F.count(F.lit(1)).cast("double")


def daily_sales(sales: DataFrame) -> DataFrame:
    """View daily_sales_summary: newest date first."""
    return (
        sales.groupBy("order_date")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.sum("quantity").cast("long").alias("total_units"),
            _money_sum("total_amount").alias("total_revenue"),
            _avg("total_amount").alias("avg_order_value"),
            F.countDistinct("customer_id").alias("unique_customers"),
            F.countDistinct("country").alias("countries_served"),
        )
        .orderBy(F.col("order_date").desc())
    )


def product_performance(sales: DataFrame) -> DataFrame:
    """View product_performance: highest revenue first."""
    return (
        sales.groupBy("product_name")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.sum("quantity").cast("long").alias("total_units_sold"),
            _money_sum("total_amount").alias("total_revenue"),
            _avg("unit_price").alias("avg_unit_price"),
            (F.sum("quantity").cast("double") / F.count(F.lit(1)).cast("double")).alias("avg_quantity_per_order"),
        )
        .orderBy(F.col("total_revenue").desc(), F.col("product_name"))
    )


def country_analysis(sales: DataFrame) -> DataFrame:
    """View country_analysis: highest revenue first."""
    return (
        sales.groupBy("country")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            _money_sum("total_amount").alias("total_revenue"),
            _avg("total_amount").alias("avg_order_value"),
            F.countDistinct("customer_id").alias("unique_customers"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
        )
        .orderBy(F.col("total_revenue").desc(), F.col("country"))
    )


def summary_stats(sales: DataFrame) -> DataFrame:
    """One row; an empty table reads as zeros and null dates."""
    n = F.count(F.lit(1))
    return sales.agg(
        n.alias("total_orders"),
        F.coalesce(_money_sum("total_amount"), F.lit(0.0)).alias("total_revenue"),
        F.coalesce(F.sum("total_amount").cast("double") / n.cast("double"), F.lit(0.0)).alias("avg_order_value"),
        F.countDistinct("customer_id").alias("unique_customers"),
        F.countDistinct("country").alias("countries"),
        F.min("order_date").alias("first_order"),
        F.max("order_date").alias("last_order"),
    )


def row_count(sales: DataFrame) -> DataFrame:
    return sales.agg(F.count(F.lit(1)).alias("row_count"))


def date_range(sales: DataFrame) -> DataFrame:
    return sales.agg(F.min("order_date").alias("min_date"), F.max("order_date").alias("max_date"))


def orders_exist(sales: DataFrame, probe: DataFrame, key: str = "order_id") -> DataFrame:
    """For each probe id: does the table hold it? A left join on the table's
    keys, which are unique."""
    keys = sales.select(F.col(key).alias("_k"), F.lit(True).alias("_hit"))
    return (
        probe.select(key)
        .join(keys, F.col(key) == F.col("_k"), "left")
        .select(key, F.coalesce(F.col("_hit"), F.lit(False)).alias("order_exists"))
    )


def order_exists(sales: DataFrame, order_id: str) -> bool:
    """Point lookup; the caller prunes the scan (the keyed table adds the
    bucket filter)."""
    return len(sales.where(F.col("order_id") == F.lit(order_id)).select("order_id").limit(1).take(1)) > 0


def dashboard_totals(sales: DataFrame) -> DataFrame:
    return sales.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.coalesce(_money_sum("total_amount"), F.lit(0.0)).alias("total_revenue"),
        F.countDistinct("country").alias("countries"),
    )


def top_products(sales: DataFrame, k: int = 10) -> DataFrame:
    """Best sellers by revenue, ties by name; a top-k (TakeOrderedAndProject)."""
    return (
        sales.groupBy("product_name")
        .agg(
            _money_sum("total_amount").alias("total_revenue"),
            F.sum("quantity").cast("long").alias("total_units_sold"),
            F.count(F.lit(1)).alias("total_orders"),
        )
        .orderBy(F.col("total_revenue").desc(), F.col("product_name"))
        .limit(k)
    )


def aov_by_country(sales: DataFrame) -> DataFrame:
    return sales.groupBy("country").agg(_avg("total_amount").alias("avg_order_value"))


def daily_change(sales: DataFrame) -> DataFrame:
    """Daily revenue and its change from the previous day with sales.

    The window runs over the daily aggregate (one row per calendar day, a
    bounded set), not over sales rows.
    """
    daily = sales.groupBy("order_date").agg(F.sum("total_amount").alias("_rev"), F.count(F.lit(1)).alias("total_orders"))
    w = Window.orderBy("order_date")
    prev = F.lag("_rev").over(w)
    return daily.select(
        "order_date",
        "total_orders",
        F.col("_rev").cast("double").alias("total_revenue"),
        prev.cast("double").alias("prev_revenue"),
        (F.col("_rev") - prev).cast("double").alias("revenue_change"),
    )


def sample_rows(df: DataFrame, n: int = 5, order: str = "order_id") -> DataFrame:
    """First n rows by a stable order (so the sample repeats)."""
    return df.orderBy(F.col(order).asc_nulls_last()).limit(n)
