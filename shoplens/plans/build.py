"""Building the warehouse: raw tables, staging views and stored marts."""

from __future__ import annotations

import datetime as dt
import warnings
from collections.abc import Callable, Collection
from dataclasses import dataclass
from functools import cached_property
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession

from shoplens.operators.layout import Layout, with_run_time
from shoplens.operators.quality import report
from shoplens.plans import attribution, checks, customers, revenue, staging
from shoplens.plans.orders import update_orders
from shoplens.session import skew_risks
from shoplens.sources import read_table

CUSTOMER_LAYOUT = Layout(
    cluster_by=("customer_segment", "churn_risk"), locate_by=("customer_id",)
)
REVENUE_LAYOUT = Layout(partition_by=("order_month",), cluster_by=("category",))


class RawTables(Protocol):
    orders: DataFrame
    customers: DataFrame
    products: DataFrame
    sessions: DataFrame


@dataclass(frozen=True)
class StoredRaw:
    """Raw tables of a warehouse folder."""

    spark: SparkSession
    root: str

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(table_path(self.root, "raw", name))

    orders = cached_property(lambda self: self._table("raw_orders"))
    customers = cached_property(lambda self: self._table("raw_customers"))
    products = cached_property(lambda self: self._table("raw_products"))
    sessions = cached_property(lambda self: self._table("raw_sessions"))


def table_path(root: str, layer: str, name: str) -> str:
    """Where a table of the layer ``raw``, ``staging`` or ``marts`` is stored."""
    return f"{root.rstrip('/')}/{layer}/{name}"


@dataclass(frozen=True)
class Models:
    """All models over one set of raw tables, unmaterialised.

    Each is a lazy plan. What a model does not use of another one is pruned: the channel marts,
    for instance, read customer 360 without its sessions.
    """

    raw: RawTables
    as_of: dt.date | None = None

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.raw.orders)

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.raw.customers, self.as_of)

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.raw.products)

    @cached_property
    def stg_sessions(self) -> DataFrame:
        return staging.stg_sessions(self.raw.sessions)

    @cached_property
    def mart_customer_360(self) -> DataFrame:
        return customers.customer_360(
            self.stg_customers, self.stg_orders, self.stg_sessions, self.as_of
        )

    @cached_property
    def order_enriched(self) -> DataFrame:
        return revenue.order_enriched(self.stg_orders, self.stg_products, self.mart_customer_360)

    @cached_property
    def mart_revenue(self) -> DataFrame:
        return revenue.revenue_daily(self.order_enriched)

    @cached_property
    def mart_channel_attribution(self) -> DataFrame:
        return attribution.channel_attribution_any_touch(
            self.stg_sessions, self.mart_customer_360
        )

    @cached_property
    def mart_channel_first_touch(self) -> DataFrame:
        return attribution.channel_attribution_first_touch(
            self.stg_sessions, self.mart_customer_360
        )


STAGING = ("stg_orders", "stg_customers", "stg_products", "stg_sessions")
MARTS = (
    "mart_customer_360", "mart_revenue", "mart_channel_attribution", "mart_channel_first_touch",
    "mart_orders_incremental",
)


def register_views(models: Models, run_ts: dt.datetime | None = None) -> None:
    """Staging as temporary views, computed anew whenever they are read."""
    for name in STAGING:
        with_run_time(getattr(models, name), run_ts).createOrReplaceTempView(name)


def build_all(
    spark: SparkSession,
    raw: RawTables,
    root: str,
    as_of: dt.date | None = None,
    run_ts: dt.datetime | None = None,
    full_refresh: bool = False,
    lookback: dt.timedelta | None = None,
    select: Collection[str] = MARTS,
    check_keys: bool = False,
) -> dict[str, DataFrame]:
    """Write the selected marts below ``root`` and return every model there is by name.

    All models become temporary views as well: staging is computed whenever it is read, marts are
    read from their files; those neither selected nor stored before are left out. Marts that depend
    on customer 360 read the stored table where there is one, and compute it where there is none. A
    product or customer that occurs twice would double its orders; ``check_keys`` looks for that
    first and raises. DataFrames read from a mart before it was replaced must be read anew.
    """
    for risk in skew_risks(spark):
        warnings.warn(f"hot keys will not be cut up: {risk}", stacklevel=2)
    models = Models(raw, as_of)
    register_views(models, run_ts)
    built = {name: getattr(models, name) for name in STAGING}

    if check_keys:
        found = report(checks.JOIN_KEYS, built).collect()
        repeated = [f"{r['model']}.{r['column_name']}" for r in found if r["failures"]]
        if repeated:
            raise ValueError(f"not unique: {', '.join(repeated)}")

    def stored(name: str) -> None:
        table = read_table(spark, table_path(root, "marts", name))
        if table is not None:
            built[name] = table
            table.createOrReplaceTempView(name)

    def store(name: str, plan: Callable[[], DataFrame], layout: Layout = Layout()) -> None:
        if name in select:
            path = table_path(root, "marts", name)
            layout.replace(with_run_time(plan(), run_ts), path)
        stored(name)

    store("mart_customer_360", lambda: models.mart_customer_360, CUSTOMER_LAYOUT)
    customer_360 = built.get("mart_customer_360", models.mart_customer_360)
    sessions = models.stg_sessions
    store(
        "mart_revenue",
        lambda: revenue.revenue_daily(
            revenue.order_enriched(models.stg_orders, models.stg_products, customer_360)
        ),
        REVENUE_LAYOUT,
    )
    store(
        "mart_channel_attribution",
        lambda: attribution.channel_attribution_any_touch(sessions, customer_360),
    )
    store(
        "mart_channel_first_touch",
        lambda: attribution.channel_attribution_first_touch(sessions, customer_360),
    )
    if "mart_orders_incremental" in select:
        update_orders(
            spark, table_path(root, "marts", "mart_orders_incremental"), models.stg_orders,
            models.stg_products, models.stg_customers,
            full_refresh=full_refresh, lookback=lookback, run_ts=run_ts,
        )
    stored("mart_orders_incremental")
    return built


def read_all(
    spark: SparkSession, raw: RawTables, root: str, as_of: dt.date | None = None
) -> dict[str, DataFrame]:
    """Every model there is by name, with the marts as they are stored."""
    return build_all(spark, raw, root, as_of, select=())


def check_all(tables: dict[str, DataFrame]) -> DataFrame:
    """Failures of the declared checks, and of the keys nothing declares, over the tables given."""
    found = [
        c for c in [*checks.DECLARED, *checks.KEYS_OF_OTHERS]
        if c.table in tables and getattr(c, "parent", c.table) in tables
    ]
    return report(found, tables)
