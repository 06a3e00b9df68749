"""Enriched orders and revenue facts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shoplens.functions import money, money_mean, money_sum, percent

# fixed values: output columns
PRODUCT_COLUMNS = (
    "product_name", "category", "sub_category", "unit_price", "cost_price", "gross_margin_pct",
    "price_tier",
)
DAILY_KEYS = (
    "revenue_date", "order_month", "order_week", "category", "sub_category", "price_tier",
    "country", "customer_segment",
)
MONTHLY_KEYS = ("order_month", "category")


def with_dimensions(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Orders with the columns of their customer and product and the profit made.

    Unmatched orders keep NULL there. Customers come first: they are the side that has to be
    shuffled at scale, and orders are still narrow then. No broadcast is forced, as a catalogue
    grows with the shop; Spark broadcasts either side while it is below the threshold. Beyond
    that AQE cuts up the partition of a hot customer, a best seller or the orders without product,
    which a left join allows on the order side.
    """
    catalogue = products.select("product_id", *PRODUCT_COLUMNS)
    profit = F.col("net_amount") - F.col("cost_price") * F.col("quantity")
    return (
        orders.join(customers, "customer_id", "left")
        .join(catalogue, "product_id", "left")
        .withColumn("order_profit", money(profit))
    )


def order_enriched(orders: DataFrame, products: DataFrame, customer_360: DataFrame) -> DataFrame:
    """Orders with product and customer columns, profit and the customer's churn risk."""
    customers = customer_360.select("customer_id", "country", "customer_segment", "churn_risk")
    return with_dimensions(orders, customers, products).select(
        "order_id", "order_date", "order_month", "order_week", "order_day_of_week", "status",
        "is_completed", "gross_amount", "net_amount", "discount_amount", "shipping_cost",
        "total_amount", "quantity", *PRODUCT_COLUMNS, "order_profit", "country",
        "customer_segment", "churn_risk",
    )


def revenue_summary(enriched: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Order counts of all orders and money of the completed ones, per group of ``keys``.

    Money is NULL, not zero, in a group without completed orders.
    """

    def completed(name: str) -> Column:
        return F.when(F.col("is_completed"), F.col(name))

    net, profit = money_sum(completed("net_amount")), money_sum(completed("order_profit"))
    return enriched.groupBy(*keys).agg(
        F.count("*").alias("total_orders"),
        F.count_if("is_completed").alias("completed_orders"),
        money_sum(completed("gross_amount")).alias("gross_revenue"),
        net.alias("net_revenue"),
        money_sum(completed("discount_amount")).alias("total_discounts"),
        money_sum(completed("shipping_cost")).alias("shipping_revenue"),
        profit.alias("total_profit"),
        F.sum(completed("quantity")).alias("units_sold"),
        money_mean(completed("net_amount")).alias("avg_order_value"),
        percent(profit, net).alias("profit_margin_pct"),
    )


def revenue_daily(enriched: DataFrame) -> DataFrame:
    dated = enriched.withColumn("revenue_date", F.col("order_date").cast("date"))
    return revenue_summary(dated, DAILY_KEYS)


def revenue_monthly(enriched: DataFrame) -> DataFrame:
    return revenue_summary(enriched, MONTHLY_KEYS)


def orders_since(orders: DataFrame, month: dt.date) -> DataFrame:
    """Orders of a month and later; the bound on the order's own time reaches the scan."""
    start = F.lit(dt.datetime(month.year, month.month, 1)).cast("timestamp_ntz")
    return orders.filter((F.col("order_month") >= F.lit(month)) & (F.col("order_date") >= start))


def dashboard_month_category(mart: DataFrame, since: dt.date) -> DataFrame:
    """Net revenue by month and category from a month on.

    On the stored mart the filter picks partitions, and two columns are read. On a mart that is
    computed, orders are best filtered by ``orders_since`` first.
    """
    recent = mart.filter(F.col("order_month") >= F.lit(since))
    return recent.groupBy(*MONTHLY_KEYS).agg(F.sum("net_revenue").alias("net_revenue"))
