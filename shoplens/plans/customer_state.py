"""The totals behind customer 360, kept current batch by batch.

What is stored per customer are sums, counts, bounds and the set of active months, which can be
added up. Means, days and scores are derived from them when the view is read, for whatever day.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from shoplens.functions import as_of_date, day_boundaries, money_sum, percent
from shoplens.functions.money import TOTAL
from shoplens.operators.partials import MOST_BATCHES, Partials
from shoplens.plans.customers import completed_orders, customer_view

ORDER_SUMS = ("total_gross_revenue", "total_net_revenue", "total_discounts")
ORDER_STATE = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("total_orders", T.LongType()),
        *(T.StructField(name, TOTAL) for name in ORDER_SUMS),
        T.StructField("orders_with_net", T.LongType()),
        T.StructField("first_order_date", T.TimestampNTZType()),
        T.StructField("last_order_date", T.TimestampNTZType()),
        T.StructField("months", T.ArrayType(T.DateType())),
    ]
)
SESSION_COUNTS = (
    "total_sessions", "converting_sessions", "seconds", "timed_sessions", "pages", "paged_sessions"
)
SESSION_STATE = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        *(T.StructField(name, T.LongType()) for name in SESSION_COUNTS),
    ]
)


def order_state(orders: DataFrame) -> DataFrame:
    """What a batch of orders adds to each customer."""
    return completed_orders(orders).groupBy("customer_id").agg(
        F.count("*").alias("total_orders"),
        money_sum(F.col("gross_amount")).alias("total_gross_revenue"),
        money_sum(F.col("net_amount")).alias("total_net_revenue"),
        money_sum(F.col("discount_amount")).alias("total_discounts"),
        F.count("net_amount").alias("orders_with_net"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.collect_set("order_month").alias("months"),
    )


def merged_order_state(rows: DataFrame) -> DataFrame:
    """A customer has as many rows as there are batches, and as many months as the calendar."""
    months = F.array_distinct(F.flatten(F.collect_list("months")))
    return rows.groupBy("customer_id").agg(
        F.sum("total_orders").alias("total_orders"),
        *(F.sum(c).cast(TOTAL).alias(c) for c in ORDER_SUMS),
        F.sum("orders_with_net").alias("orders_with_net"),
        F.min("first_order_date").alias("first_order_date"),
        F.max("last_order_date").alias("last_order_date"),
        months.alias("months"),
    )


def session_state(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy("customer_id").agg(
        F.count("*").alias("total_sessions"),
        F.count_if("converted").alias("converting_sessions"),
        F.sum("time_on_site").alias("seconds"),
        F.count("time_on_site").alias("timed_sessions"),
        F.sum("pages_visited").alias("pages"),
        F.count("pages_visited").alias("paged_sessions"),
    )


def merged_session_state(rows: DataFrame) -> DataFrame:
    return rows.groupBy("customer_id").agg(*(F.sum(c).alias(c) for c in SESSION_COUNTS))


def order_totals(state: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """The columns of ``customer_orders``."""
    first, last = F.col("first_order_date"), F.col("last_order_date")
    net = F.col("total_net_revenue").cast("double")
    return state.select(
        "customer_id", "total_orders", *ORDER_SUMS,
        (net / F.nullif("orders_with_net", F.lit(0))).alias("avg_order_value"),
        "first_order_date", "last_order_date",
        day_boundaries(last, as_of_date(as_of)).alias("days_since_last_order"),
        day_boundaries(first, last).alias("customer_lifespan_days"),
        F.size("months").cast("bigint").alias("active_months"),
    )


def session_totals(state: DataFrame) -> DataFrame:
    """The columns of ``customer_sessions``."""

    def mean(total: str, count: str) -> Column:
        return F.col(total).cast("double") / F.nullif(count, F.lit(0))

    return state.select(
        "customer_id", "total_sessions", "converting_sessions",
        mean("seconds", "timed_sessions").alias("avg_time_on_site_secs"),
        mean("pages", "paged_sessions").alias("avg_pages_per_session"),
        percent(F.col("converting_sessions"), F.col("total_sessions"))
        .alias("session_conversion_rate"),
    )


class CustomerState:
    """Stored totals of customers below ``root``.

    Orders and sessions are put in once each, orders when their status is final: an order that is
    completed and returned later would have to be taken back, which minima do not allow.
    """

    def __init__(self, spark: SparkSession, root: str, most: int = MOST_BATCHES) -> None:
        root = root.rstrip("/")
        self.orders = Partials(spark, f"{root}/orders", ORDER_STATE, merged_order_state, most)
        self.sessions = Partials(
            spark, f"{root}/sessions", SESSION_STATE, merged_session_state, most
        )

    def add(self, batch: str, orders: DataFrame, sessions: DataFrame) -> None:
        """Adds staged orders and sessions; a batch of a known name is not added again."""
        self.orders.add(batch, order_state(orders))
        self.sessions.add(batch, session_state(sessions))

    def customer_360(self, customers: DataFrame, as_of: dt.date | None = None) -> DataFrame:
        """The view for a day, without reading an order or a session."""
        return customer_view(
            customers, order_totals(self.orders.read(), as_of), session_totals(self.sessions.read())
        )
