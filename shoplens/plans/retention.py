"""Monthly cohorts of customers and how many of them come back.

A customer's activity is the set of months with a completed order. It is deduplicated first, so
the scan is read once and even a customer with a third of all orders shrinks to one row per month
before customers are grouped. No order is joined back to its cohort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from shoplens.functions import month_start, month_boundaries
from shoplens.plans.customers import completed_orders


def customer_cohorts(orders: DataFrame) -> DataFrame:
    """The month of each customer's first completed order."""
    first = month_start(F.min("order_date")).cast("timestamp_ntz")
    return completed_orders(orders).groupBy("customer_id").agg(first.alias("cohort_month"))


def cohort_sizes(cohorts: DataFrame) -> DataFrame:
    return cohorts.groupBy("cohort_month").agg(
        F.count_distinct("customer_id").alias("cohort_size")
    )


def cohort_retention(orders: DataFrame) -> DataFrame:
    """Customers of each cohort active so many months later, and their share, in order."""
    month = month_start(F.col("order_date"))
    active = completed_orders(orders).select("customer_id", month.alias("month")).distinct()
    cohort = F.min("month").over(Window.partitionBy("customer_id"))
    # months are distinct per customer, so counting rows counts customers
    grid = (
        active.select("month", cohort.alias("cohort"))
        .groupBy("cohort", month_boundaries(F.col("cohort"), F.col("month")).alias("later"))
        .agg(F.count("*").alias("active_customers"))
    )
    return retention_grid(grid)


def retention_grid(grid: DataFrame) -> DataFrame:
    """Sizes and shares for ``cohort, later, active_customers``, in order."""
    # every member is active in the first month, which therefore counts the cohort
    members = F.max(F.when(F.col("later") == 0, F.col("active_customers")))
    size = members.over(Window.partitionBy("cohort"))
    return (
        grid.filter(F.col("cohort").isNotNull()).withColumn("cohort_size", size)
        .select(
            F.col("cohort").cast("timestamp_ntz").alias("cohort_month"),
            F.col("later").alias("months_since_cohort"),
            "active_customers",
            "cohort_size",
            F.round(F.col("active_customers") * 100 / F.col("cohort_size"), 1)
            .alias("retention_rate"),
        )
        .orderBy("cohort_month", F.asc_nulls_last("months_since_cohort"))
    )
