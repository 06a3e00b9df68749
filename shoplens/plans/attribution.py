"""Channel engagement and the credit channels get for customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shoplens.functions import decimal_mean, exact_mean, money_mean, money_sum, percent

# fixed values: output columns
CREDIT_KEYS = ("first_touch_channel", "first_touch_channel_group")


def channel_daily(sessions: DataFrame) -> DataFrame:
    """Sessions, visitors, conversions and bounces per day and channel."""
    sessions_seen = F.count("*")
    converted, bounced = F.count_if("converted"), F.count_if("is_bounce")
    return sessions.groupBy("session_date", "channel", "channel_group").agg(
        sessions_seen.alias("total_sessions"),
        F.count_distinct("customer_id").alias("unique_visitors"),
        converted.alias("conversions"),
        bounced.alias("bounces"),
        exact_mean(F.col("time_on_site_mins"), 1).alias("avg_time_on_site_mins"),
        F.avg("pages_visited").alias("avg_pages_per_session"),
        percent(converted, sessions_seen).alias("conversion_rate_pct"),
        percent(bounced, sessions_seen).alias("bounce_rate_pct"),
    )


def channel_touches(sessions: DataFrame) -> DataFrame:
    """Every channel a customer ever used, with the first day."""
    return sessions.groupBy(
        "customer_id",
        F.col("channel").alias("first_touch_channel"),
        F.col("channel_group").alias("first_touch_channel_group"),
    ).agg(F.min("session_date").alias("first_session_date"))


def first_touches(sessions: DataFrame) -> DataFrame:
    """The channel of each known customer's first session.

    Days are the finest grain of a session, so the lower session id decides within the first day.
    """
    earliest = F.min_by(
        F.struct("channel", "channel_group", "session_date"),
        F.struct("session_date", "session_id"),
    )
    known = sessions.filter(F.col("customer_id").isNotNull())
    return (
        known.groupBy("customer_id")
        .agg(earliest.alias("first"))
        .select(
            "customer_id",
            F.col("first.channel").alias("first_touch_channel"),
            F.col("first.channel_group").alias("first_touch_channel_group"),
            F.col("first.session_date").alias("first_session_date"),
        )
    )


def channel_credit(touches: DataFrame, customer_360: DataFrame) -> DataFrame:
    """Customers and their lifetime value per credited channel.

    The join leaves the touches partitioned by customer, so counting distinct customers needs no
    shuffle of its own; only one row per channel and partition moves afterwards.
    """
    value = customer_360.select(
        "customer_id", "total_orders", "total_net_revenue", "avg_order_value"
    )
    revenue = F.col("total_net_revenue")
    return (
        touches.join(value, "customer_id", "left")
        .groupBy(*CREDIT_KEYS)
        .agg(
            F.count_distinct("customer_id").alias("acquired_customers"),
            money_mean(revenue).alias("avg_customer_ltv"),
            F.avg("total_orders").alias("avg_orders_per_customer"),
            decimal_mean(F.col("avg_order_value")).alias("avg_order_value"),
            money_sum(revenue).alias("total_attributed_revenue"),
        )
    )


def channel_attribution_any_touch(sessions: DataFrame, customer_360: DataFrame) -> DataFrame:
    """Full credit for a customer to every channel the customer used."""
    return channel_credit(channel_touches(sessions), customer_360)


def channel_attribution_first_touch(sessions: DataFrame, customer_360: DataFrame) -> DataFrame:
    """Credit for a customer to the channel of the first session only."""
    return channel_credit(first_touches(sessions), customer_360)
