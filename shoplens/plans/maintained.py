"""Daily revenue kept current by recomputing only the months that changed.

Beside the mart lie digests of what it was made from: one for each month of orders, one for each
product and customer. An update compares them with those of the present tables. Months whose orders
differ, and months with an order of a product or customer that differs, are computed again and
replace their partitions; all others keep their files.

An update reads the present orders up to three times: for the digests of months, for orders of changed
products and customers, where there are any, and for the months to compute. Digests and changed keys
are computed once and stored, as several steps read them.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shoplens.operators.layout import Layout
from shoplens.operators.upsert import any_of
from shoplens.plans.revenue import PRODUCT_COLUMNS, revenue_daily, with_dimensions
from shoplens.session import scratch_path
from shoplens.sources import read_table
from shoplens.sources.storage import delete_folder, delete_partition, replace_table
from shoplens.sources.table_schema import TableSchema, store_schema

MONTH = "order_month"
LAYOUT = Layout(partition_by=(MONTH,), cluster_by=("category",))
ORDER_COLUMNS = (
    "customer_id", "product_id", "order_date", "order_week", "is_completed", "gross_amount",
    "net_amount", "discount_amount", "shipping_cost", "quantity",
)
CUSTOMER_COLUMNS = ("country", "customer_segment")
KEYS = {"products": "product_id", "customers": "customer_id"}
# folders of digests inside the mart's own, which its readers do not see
DIGESTS = "_made_from_"


def _hash(columns: tuple[str, ...], seed: int) -> Column:
    # a hash of a row skips NULL, so each column says whether it is
    return F.xxhash64(F.lit(seed), *columns, F.array(*(F.col(c).isNull() for c in columns)))


def _digest(columns: tuple[str, ...]) -> list[Column]:
    """Two 64-bit hashes of each row added up, the number of rows: the same in any order."""
    sums = [
        F.sum(_hash(columns, seed).cast("decimal(38,0)")).alias(f"digest_{seed}") for seed in (1, 2)
    ]
    return [F.count("*").alias("n"), *sums]


def month_digests(orders: DataFrame) -> DataFrame:
    """One row per month, from one scan without a join."""
    return orders.groupBy(MONTH).agg(*_digest(ORDER_COLUMNS))


def key_digests(rows: DataFrame, key: str, columns: tuple[str, ...]) -> DataFrame:
    """One row per key, with what revenue uses of it."""
    return rows.filter(F.col(key).isNotNull()).groupBy(key).agg(*_digest(columns))


@contextmanager
def _stored_once(spark: SparkSession, **frames: DataFrame) -> Iterator[dict[str, DataFrame]]:
    """Frames that are computed and read from their files from then on, until the block ends."""
    folder = scratch_path(spark, "once")
    try:
        for name, df in frames.items():
            df.write.parquet(f"{folder}/{name}")
        yield {
            name: spark.read.schema(df.schema).parquet(f"{folder}/{name}")
            for name, df in frames.items()
        }
    finally:
        delete_folder(spark, folder)


def _differing(now: DataFrame, before: DataFrame, key: str) -> DataFrame:
    """Keys that came, went or changed."""
    columns = [c for c in now.columns if c != key]
    own = now.select(F.struct(F.col(key)).alias("k"), F.struct(*columns).alias("now"))
    old = before.select(F.struct(F.col(key)).alias("k"), F.struct(*columns).alias("before"))
    both = own.join(old, own["k"].eqNullSafe(old["k"]), "full")
    differs = ~F.col("now").eqNullSafe(F.col("before"))
    return both.filter(differs).select(F.coalesce(own["k"], old["k"])[key].alias(key))


def _none_of(months: set) -> Column:
    """Whether an order is of none of the months; one without a month may be."""
    return ~F.coalesce(any_of(MONTH, months), F.lit(False))


def _months(rows: DataFrame) -> set:
    return {r[0] for r in rows.select(MONTH).distinct().collect()}


class MaintainedRevenue:
    """The mart ``mart_revenue`` at ``path``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def update(
        self, orders: DataFrame, products: DataFrame, customers: DataFrame,
        changed_orders: DataFrame | None = None,
    ) -> list:
        """Brings the mart up to date with the staged tables and returns the months computed.

        Without ``changed_orders``, the present orders are scanned for months that differ. Where a
        feed of the changes is at hand, both the old and the new version of each changed order given
        as ``changed_orders``, only its months are taken, and of the others only those that a changed
        product or customer needs. Digests are stored after the mart: an update that was cut off
        is done again.
        """
        bought = ("product_id", *PRODUCT_COLUMNS)
        made_from = {
            "products": key_digests(products.select(*bought), "product_id", PRODUCT_COLUMNS),
            "customers": key_digests(customers, "customer_id", CUSTOMER_COLUMNS),
        }
        stored = {name: self._stored(name) for name in ("months", *made_from)}
        first = read_table(self.spark, self.path) is None or None in stored.values()
        if first:
            mart = self._revenue(orders, products, customers)
            LAYOUT.replace(mart, self.path)
            # a mart that loses all its months keeps its columns
            store_schema(self.spark, self.path, TableSchema(mart.schema))
            self._keep(made_from | {"months": month_digests(orders)})
            return sorted(_months(self._stored("months")), key=str)

        if changed_orders is None:
            touched = set()
            made_from["months"] = month_digests(orders)
        else:
            touched = _months(changed_orders)
            of_others = stored["months"].filter(_none_of(touched))
            own = month_digests(orders.filter(any_of(MONTH, touched)))
            made_from["months"] = of_others.unionByName(own)
        with _stored_once(self.spark, **made_from) as now:
            if changed_orders is None:
                touched = _months(_differing(now["months"], stored["months"], MONTH))
            changed = {
                name: _differing(now[name], stored[name], key) for name, key in KEYS.items()
            }
            with _stored_once(self.spark, **changed) as keys:
                keys = {name: rows for name, rows in keys.items() if not rows.isEmpty()}
                months = touched | self._months_of(orders, keys, touched)
            if months:
                affected = orders.filter(any_of(MONTH, months))
                LAYOUT.replace_partitions(
                    self._revenue(affected, products, customers), self.path
                )
                for month in touched - _months(now["months"]):
                    delete_partition(self.spark, self.path, MONTH, month)
            if months or keys:
                self._keep(now)
        return sorted(months, key=str)

    @staticmethod
    def _months_of(orders: DataFrame, keys: dict[str, DataFrame], known: set) -> set:
        """Months with an order of a changed product or customer, but for those ``known`` to differ.

        Where no key changed, no order is searched.
        """
        others = orders.filter(_none_of(known))
        parts = [
            others.join(rows, KEYS[name], "left_semi").select(MONTH) for name, rows in keys.items()
        ]
        return _months(reduce(DataFrame.unionAll, parts)) if parts else set()

    def read(self) -> DataFrame | None:
        return read_table(self.spark, self.path)

    @staticmethod
    def _revenue(orders: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
        buyers = customers.select("customer_id", *CUSTOMER_COLUMNS)
        return revenue_daily(with_dimensions(orders, buyers, products))

    def _folder(self, name: str) -> str:
        return f"{self.path}/{DIGESTS}{name}"

    def _stored(self, name: str) -> DataFrame | None:
        return read_table(self.spark, self._folder(name))

    def _keep(self, made_from: dict[str, DataFrame]) -> None:
        for name, rows in made_from.items():
            replace_table(self.spark, self._folder(name), rows.write.parquet)
