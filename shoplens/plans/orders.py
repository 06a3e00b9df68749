"""Enriched orders as a table that is kept current by high-water mark."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shoplens.functions import percent
from shoplens.operators.layout import MART_LOADED_AT, Layout, with_run_time
from shoplens.operators.upsert import upsert_table
from shoplens.plans.revenue import PRODUCT_COLUMNS, with_dimensions
from shoplens.sources import read_table
from shoplens.sources.storage import partition_texts

BY_MONTH = Layout(partition_by=("order_month",), cluster_by=("order_date",))
# for readers that ask for a stretch of time, a customer or a price, each alone
ORDERS_BY_ANY = Layout(interleave_by=("order_date", "customer_id", "net_amount"))
ORDERS_LAYOUT = Layout(partition_by=("order_month",), cluster_by=("category",))


def orders_enriched(orders: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with product and customer columns, profit and margin."""
    buyers = customers.select("customer_id", "country", "customer_segment")
    net = F.col("net_amount")
    margin = percent(net - F.col("cost_price") * F.col("quantity"), net)
    return with_dimensions(orders, buyers, products).select(
        "order_id", "customer_id", "order_date", "order_month", "order_week", "status",
        "is_completed", "gross_amount", "net_amount", "discount_amount", "shipping_cost",
        "total_amount", "quantity", *PRODUCT_COLUMNS, "order_profit",
        margin.alias("order_profit_margin_pct"), "country", "customer_segment",
    )


def high_water_mark(target: DataFrame, last_month: dt.date | None = None) -> DataFrame:
    """The latest order date of the table, as one row.

    It lies in the last month, so only that partition's dates are read. Who knows the month, from
    the table's folders, saves a look into all files.
    """
    if last_month is None:
        last_month = target.agg(F.max("order_month")).scalar()
    return target.filter(F.col("order_month") == F.lit(last_month)).agg(
        F.max("order_date").alias("mark")
    )


def orders_after(orders: DataFrame, mark: Column | dt.datetime) -> DataFrame:
    """Orders strictly later than the mark. The comparison reaches the scan of the raw orders."""
    return orders.filter(F.col("order_date") > mark)


def orders_increment(orders: DataFrame, target: DataFrame) -> DataFrame:
    """Orders later than everything in the table; none where the table is empty."""
    return orders_after(orders, high_water_mark(target).scalar())


def update_orders(
    spark: SparkSession,
    path: str,
    orders: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    *,
    full_refresh: bool = False,
    lookback: dt.timedelta | None = None,
    statuses: Sequence[str] | None = None,
    run_ts: dt.datetime | None = None,
) -> None:
    """Bring the table up to date: everything at first, later only what is new.

    By default an order is new when it is later than the latest one stored, so orders that arrive
    late, tie with the mark or change afterwards are missed. ``lookback`` reads a stretch before
    the mark once more, which the key makes safe. ``statuses`` restricts what is stored; a stored
    order that is read again and has left the list goes.
    """
    target = None if full_refresh else read_table(spark, path)
    left = None
    if target is not None:
        months = [m for m in partition_texts(spark, path, "order_month") if m]
        last = dt.date.fromisoformat(max(months)) if months else None
        mark = high_water_mark(target, last).first()["mark"] if last else None
        if mark is not None:
            orders = orders_after(orders, mark - lookback if lookback else mark)
            products, customers = _met_by(orders, products, customers)
    if statuses is not None:
        wanted = F.coalesce(F.col("status").isin(*statuses), F.lit(False))
        left, orders = orders.filter(~wanted), orders.filter(wanted)
    batch = with_run_time(orders_enriched(orders, products, customers), run_ts, MART_LOADED_AT)
    upsert_table(spark, path, target, batch, "order_id", ORDERS_LAYOUT, removed=left)


def _met_by(orders: DataFrame, *dimensions: DataFrame) -> list[DataFrame]:
    """Dimensions reduced to the keys of a few orders.

    Only these keys travel; a left join of the orders alone would shuffle the whole dimension.
    """
    keys = ("product_id", "customer_id")
    return [
        rows.join(orders.select(key), key, "left_semi")
        for key, rows in zip(keys, dimensions, strict=True)
    ]
