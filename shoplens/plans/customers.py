"""Customer marts: order and session totals, and the 360 view with RFM scores and churn risk."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from shoplens.functions import (
    as_of_date,
    day_boundaries,
    first_match,
    money_mean,
    money_sum,
    percent,
    safe_divide,
)
from shoplens.plans.staging import COMPLETED

# fixed values: bounds of the scores 5 to 2 (below or beyond all of them the score is 1)
RECENCY_DAYS = (30, 60, 90, 180)
FREQUENCY_ORDERS = (20, 10, 5, 2)
MONETARY_REVENUE = (2000, 1000, 500, 200)
CHURN_DAYS = ((180, "High Risk"), (90, "Medium Risk"))
LOWEST_CHURN = "Low Risk"
NEVER_ORDERED_DAYS = 9999


def score(conditions: list[Column]) -> Column:
    """5 where the first condition holds, 4 for the second, and so on; 1 where none does."""
    return first_match(zip(conditions, (5, 4, 3, 2), strict=True), 1)


def recency_score(days: Column) -> Column:
    return score([days <= bound for bound in RECENCY_DAYS])


def frequency_score(orders: Column) -> Column:
    return score([orders >= bound for bound in FREQUENCY_ORDERS])


def monetary_score(revenue: Column) -> Column:
    return score([revenue >= bound for bound in MONETARY_REVENUE])


def churn_risk(days: Column) -> Column:
    return first_match([(days > bound, risk) for bound, risk in CHURN_DAYS], LOWEST_CHURN)


def completed_orders(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("status") == COMPLETED)


def customer_orders(orders: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Totals of each customer's completed orders.

    Counting distinct months shuffles twice, first by customer and month. A customer who holds a
    large share of all orders is thereby down to a row per month before it is one group.
    """
    first, last = F.min("order_date"), F.max("order_date")
    return completed_orders(orders).groupBy("customer_id").agg(
        F.count("*").alias("total_orders"),
        money_sum(F.col("gross_amount")).alias("total_gross_revenue"),
        money_sum(F.col("net_amount")).alias("total_net_revenue"),
        money_sum(F.col("discount_amount")).alias("total_discounts"),
        money_mean(F.col("net_amount")).alias("avg_order_value"),
        first.alias("first_order_date"),
        last.alias("last_order_date"),
        day_boundaries(last, as_of_date(as_of)).alias("days_since_last_order"),
        day_boundaries(first, last).alias("customer_lifespan_days"),
        F.count_distinct("order_month").alias("active_months"),
    )


def customer_sessions(sessions: DataFrame) -> DataFrame:
    """Totals of each customer's sessions; unknown customers form one group."""
    converting = F.count_if("converted")
    return sessions.groupBy("customer_id").agg(
        F.count("*").alias("total_sessions"),
        converting.alias("converting_sessions"),
        F.avg("time_on_site").alias("avg_time_on_site_secs"),
        F.avg("pages_visited").alias("avg_pages_per_session"),
        percent(converting, F.count("*")).alias("session_conversion_rate"),
    )


def customer_360(
    customers: DataFrame,
    orders: DataFrame,
    sessions: DataFrame,
    as_of: dt.date | None = None,
) -> DataFrame:
    """One row per customer. Both sides are totalled before they are joined on the same key."""
    return customer_view(customers, customer_orders(orders, as_of), customer_sessions(sessions))


def customer_view(
    customers: DataFrame, order_totals: DataFrame, session_totals: DataFrame
) -> DataFrame:
    """The 360 view from the totals of ``customer_orders`` and ``customer_sessions``."""

    def known(name: str, default: int = 0) -> Column:
        return F.coalesce(name, F.lit(default))

    joined = customers.join(order_totals, "customer_id", "left").join(
        session_totals, "customer_id", "left"
    )
    revenue = known("total_net_revenue")
    days_idle = known("days_since_last_order", NEVER_ORDERED_DAYS)
    per_day = safe_divide(revenue.cast("double"), F.col("days_since_signup"))
    return joined.select(
        "customer_id",
        "full_name",
        "email",
        "country",
        "signup_date",
        "days_since_signup",
        "customer_segment",
        known("total_orders").alias("total_orders"),
        known("total_gross_revenue").alias("total_gross_revenue"),
        revenue.alias("total_net_revenue"),
        known("total_discounts").alias("total_discounts"),
        known("avg_order_value").alias("avg_order_value"),
        "first_order_date",
        "last_order_date",
        days_idle.alias("days_since_last_order"),
        known("customer_lifespan_days").alias("customer_lifespan_days"),
        known("active_months").alias("active_months"),
        known("total_sessions").alias("total_sessions"),
        known("avg_time_on_site_secs").alias("avg_time_on_site_secs"),
        known("avg_pages_per_session").alias("avg_pages_per_session"),
        known("session_conversion_rate").alias("session_conversion_rate"),
        F.round(per_day * 365, 2).alias("annualized_revenue"),
        recency_score(days_idle).alias("recency_score"),
        frequency_score(known("total_orders")).alias("frequency_score"),
        monetary_score(revenue).alias("monetary_score"),
        churn_risk(days_idle).alias("churn_risk"),
    )


def customer_lookup(mart: DataFrame, customer_id: str, segment: str) -> DataFrame:
    """One customer. On the stored mart both equalities prune files and row groups."""
    matches = (F.col("customer_id") == customer_id) & (F.col("customer_segment") == segment)
    return mart.filter(matches)
