"""Cleaned orders, customers, products and sessions.

Each function is a filter and one projection: no shuffle, and both fold into the scan of whatever
reads them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from shoplens.functions import (
    as_of_date,
    clean,
    day_boundaries,
    day_of_week,
    first_match,
    money,
    month_boundaries,
    month_start,
    percent,
    title_case,
    true_or_false,
    week_start,
)

# fixed values: upper price bounds of the tiers, and channels of each group
PRICE_TIERS = ((25, "Budget"), (75, "Mid-Range"), (150, "Premium"))
TOP_PRICE_TIER = "Luxury"
CHANNEL_GROUPS = {
    "Organic": ("organic_search", "direct"),
    "Paid": ("paid_search", "social"),
    "Owned": ("email",),
}
OTHER_CHANNEL_GROUP = "Referral"
COMPLETED = "completed"
BOUNCE_PAGES, BOUNCE_SECONDS = 1, 10


def price_tier(price: Column) -> Column:
    return first_match([(price < bound, tier) for bound, tier in PRICE_TIERS], TOP_PRICE_TIER)


def channel_group(channel: Column) -> Column:
    """The group of a cleaned channel name; unknown and missing channels count as referrals."""
    groups = [(channel.isin(*names), group) for group, names in CHANNEL_GROUPS.items()]
    return first_match(groups, OTHER_CHANNEL_GROUP)


def stg_orders(raw_orders: DataFrame) -> DataFrame:
    """Orders with an id, a customer and a positive amount."""
    status = clean(F.col("status"))
    placed = F.col("order_date")
    amount, discount, shipping = F.col("amount"), F.col("discount"), F.col("shipping_cost")
    usable = F.col("order_id").isNotNull() & F.col("customer_id").isNotNull() & (amount > 0)
    return raw_orders.filter(usable).select(
        "order_id",
        "customer_id",
        "product_id",
        placed.cast("timestamp_ntz").alias("order_date"),
        month_start(placed).alias("order_month"),
        week_start(placed).alias("order_week"),
        day_of_week(placed).alias("order_day_of_week"),
        status.alias("status"),
        true_or_false(status == COMPLETED).alias("is_completed"),
        money(amount).alias("gross_amount"),
        money(discount).alias("discount_amount"),
        money(shipping).alias("shipping_cost"),
        money(amount - discount).alias("net_amount"),
        money(amount - discount + shipping).alias("total_amount"),
        "quantity",
    )


def stg_customers(raw_customers: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Customers with an id and an email. Tenure is counted up to ``as_of``."""
    today = as_of_date(as_of)
    signup = F.col("signup_date").cast("date")
    first, last = title_case(F.col("first_name")), title_case(F.col("last_name"))
    usable = F.col("customer_id").isNotNull() & F.col("email").isNotNull()
    return raw_customers.filter(usable).select(
        "customer_id",
        first.alias("first_name"),
        last.alias("last_name"),
        F.concat(first, F.lit(" "), last).alias("full_name"),
        clean(F.col("email")).alias("email"),
        title_case(F.col("country")).alias("country"),
        signup.alias("signup_date"),
        day_boundaries(signup, today).alias("days_since_signup"),
        month_boundaries(signup, today).alias("months_since_signup"),
        title_case(F.col("segment")).alias("customer_segment"),
    )


def stg_products(raw_products: DataFrame) -> DataFrame:
    """Products with an id and a positive price, their margin and price tier."""
    price, cost = F.col("unit_price"), F.col("cost_price")
    return raw_products.filter(F.col("product_id").isNotNull() & (price > 0)).select(
        "product_id",
        F.trim("product_name").alias("product_name"),
        title_case(F.col("category")).alias("category"),
        title_case(F.col("sub_category")).alias("sub_category"),
        money(price).alias("unit_price"),
        money(cost).alias("cost_price"),
        money(price - cost).alias("gross_margin_amount"),
        percent(price - cost, price).alias("gross_margin_pct"),
        price_tier(price).alias("price_tier"),
    )


def stg_sessions(raw_sessions: DataFrame) -> DataFrame:
    """Sessions with an id. The customer may be unknown."""
    channel = clean(F.col("channel"))
    pages, seconds = F.col("pages_visited"), F.col("time_on_site")
    bounced = (pages == BOUNCE_PAGES) & (seconds < BOUNCE_SECONDS)
    return raw_sessions.filter(F.col("session_id").isNotNull()).select(
        "session_id",
        "customer_id",
        F.col("session_date").cast("date").alias("session_date"),
        channel.alias("channel"),
        channel_group(channel).alias("channel_group"),
        "pages_visited",
        "time_on_site",
        F.round(seconds / 60, 1).alias("time_on_site_mins"),
        true_or_false(bounced).alias("is_bounce"),
        F.col("converted").cast("boolean").alias("converted"),
    )
