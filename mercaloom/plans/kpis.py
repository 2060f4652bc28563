"""Business figures on the star schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import ratio
from ..operators.skew import MIN_HOT_ROWS, Lookup, look_up

MONEY_SUM = "decimal(28,2)"

Star = Mapping[str, DataFrame]


def of_months(star: Star, *months: int) -> Star:
    """The star with the sales of some months of purchase (yyyyMM). A fact cut by month reads their files only."""
    fact = star["fact_sales"]
    month = F.col("purchase_month") if "purchase_month" in fact.columns else F.floor(F.col("purchase_date_key") / 100)
    return {**star, "fact_sales": fact.where(month.isin(*months))}


def revenue_by_month(star: Star) -> DataFrame:
    """Revenue, lines, orders and late share for every month of purchase (yyyyMM)."""
    fact = star["fact_sales"].withColumn("purchase_month", F.floor(F.col("purchase_date_key") / 100).cast("int"))
    # an order has one date, so its lines meet in one group; the orders of a month are counted after that
    per_order = fact.groupBy("purchase_month", "order_id").agg(
        F.sum("line_total").alias("value"),
        F.count(F.lit(1)).alias("lines"),
        F.max("is_late").alias("late"),
        F.max("is_delivered").alias("delivered"),
    )
    return per_order.groupBy("purchase_month").agg(
        F.sum("value").cast(MONEY_SUM).alias("revenue"),
        F.sum("lines").alias("sales_lines"),
        F.count(F.lit(1)).alias("orders"),
        F.round(ratio(F.sum("late"), F.sum("delivered")), 4).alias("late_rate"),
    )


def revenue_lines(star: Star) -> DataFrame:
    """Total revenue and number of sales lines."""
    return star["fact_sales"].agg(
        F.sum("line_total").cast(MONEY_SUM).alias("total_revenue"),
        F.count(F.lit(1)).alias("total_sales_lines"),
    )


def total_orders(orders: DataFrame) -> DataFrame:
    """Counted on the raw orders: the fact lacks orders without lines."""
    return orders.agg(F.count_distinct("order_id").alias("total_orders"))


def _lines_by(star: Star, dim: str, key: str, label: str) -> DataFrame:
    """Lines per label, counted per dimension key before the join."""
    per_key = star["fact_sales"].groupBy(key).agg(F.count(F.lit(1)).alias("lines"))
    return (
        per_key.join(star[dim].select(key, label), key)
        .groupBy(label)
        .agg(F.sum("lines").alias("sales_lines"))
        .orderBy(F.desc("sales_lines"), label)
    )


def top_category(star: Star, n: int = 1) -> DataFrame:
    """Categories with the most sales lines."""
    return _lines_by(star, "dim_product", "product_sk", "category_en").limit(n)


def top_state(star: Star, n: int = 1) -> DataFrame:
    """Customer states with the most sales lines."""
    return _lines_by(star, "dim_customer", "customer_sk", "customer_state").limit(n)


def delivery_time(star: Star) -> DataFrame:
    """Mean days from purchase to delivery, per line and per order."""
    per_order = (
        star["fact_sales"]
        .groupBy("order_id")
        .agg(
            F.sum("days_to_deliver").alias("days_sum"),
            F.count("days_to_deliver").alias("line_count"),
            F.max("days_to_deliver").alias("days"),
        )
    )
    return per_order.agg(
        ratio(F.sum("days_sum"), F.sum("line_count")).alias("avg_days_line"),
        F.avg("days").alias("avg_days_order"),
    )


def late_rate(star: Star) -> DataFrame:
    """Share of deliveries that came late, per line and per order."""
    per_order = (
        star["fact_sales"]
        .groupBy("order_id")
        .agg(
            F.sum("is_late").alias("late_lines"),
            F.sum("is_delivered").alias("delivered_lines"),
            F.max("is_late").alias("late"),
            F.max("is_delivered").alias("delivered"),
        )
    )
    return per_order.agg(
        ratio(F.sum("late_lines"), F.sum("delivered_lines")).alias("late_rate_line"),
        ratio(F.sum("late"), F.sum("delivered")).alias("late_rate_order"),
    )


def order_values(star: Star) -> DataFrame:
    """Mean value of a line and of an order."""
    per_order = (
        star["fact_sales"]
        .groupBy("order_id")
        .agg(F.sum("line_total").alias("value"), F.count(F.lit(1)).alias("lines"))
    )
    value = F.sum("value")
    return per_order.agg(
        ratio(value, F.sum("lines")).alias("avg_line_value"),
        ratio(value, F.count(F.lit(1))).alias("avg_order_value"),
    )


def revenue_by_category_state(star: Star, min_hot_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """Revenue, lines and late share for every category and customer state.

    Each line looks up its category and its state; few groups remain, so the sums are almost
    complete before the last shuffle.
    """
    fact = star["fact_sales"].select(
        "product_sk", "customer_sk", "line_total", "is_late", "is_delivered"
    )
    lines = look_up(
        fact,
        Lookup("product_sk", star["dim_product"].select("product_sk", "category_en")),
        Lookup("customer_sk", star["dim_customer"].select("customer_sk", "customer_state")),
        min_rows=min_hot_rows,
    )
    return lines.groupBy("category_en", "customer_state").agg(
        F.sum("line_total").cast(MONEY_SUM).alias("revenue"),
        F.count(F.lit(1)).alias("sales_lines"),
        F.round(ratio(F.sum("is_late"), F.sum("is_delivered")), 4).alias("late_rate"),
    )


def kpi_frames(star: Star, orders: DataFrame) -> dict[str, DataFrame]:
    """All figures by name, for a report or for saving."""
    return {
        "kpi_revenue_lines": revenue_lines(star),
        "kpi_orders": total_orders(orders),
        "kpi_top_category": top_category(star),
        "kpi_top_state": top_state(star),
        "kpi_delivery": delivery_time(star),
        "kpi_late_rate": late_rate(star),
        "kpi_values": order_values(star),
        "revenue_by_category_state": revenue_by_category_state(star),
        "revenue_by_month": revenue_by_month(star),
    }
