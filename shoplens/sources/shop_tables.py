"""The raw tables derived from the star-schema test tables.

``orders``, ``lineitem``, ``customer``, ``nation``, ``part`` and ``events`` become orders,
customers, products and sessions. Odd case, stray spaces, missing ids, emails, statuses and
channels, amounts and prices of zero and less, negative discounts and fractions of a cent are put in
on purpose, so that staging has something to clean and the checks something to find.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shoplens.functions import MONEY

# fixed values: the stored columns that are used, so that no job has to read them off the files
SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
}


def _unless_nth(key: Column, n: int, value: Column) -> Column:
    """NULL for every key that ``n`` divides."""
    return F.when(key % n != 0, value)


@dataclass(frozen=True)
class ShopTables:
    """Raw tables below one folder of Parquet files."""

    spark: SparkSession
    folder: str

    def read(self, table: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[table]).parquet(f"{self.folder}/{table}.parquet")

    @cached_property
    def orders(self) -> DataFrame:
        key = F.col("o_orderkey")
        lines = (
            self.read("lineitem")
            .groupBy(F.col("l_orderkey").alias("o_orderkey"))
            .agg(F.min("l_partkey").alias("part"), F.count("*").alias("lines"))
        )
        status = (
            F.when(F.col("o_orderstatus") == "F", " Completed")
            .when(F.col("o_orderstatus") == "O", "PENDING")
            .when(key % 2 == 0, "returned ")
            .otherwise("Cancelled")
        )
        price = F.col("o_totalprice").cast(MONEY) * F.lit(Decimal("0.001"))
        price = F.when(key % 7 == 0, F.round(price, 4)).otherwise(F.round(price, 2))
        sign = F.when(key % 83 == 0, 0).when(key % 73 == 0, -1).otherwise(1)
        discount = F.when(key % 79 == 0, -(key % 5) - 1).otherwise(key % 5)
        return (
            self.read("orders")
            .join(lines, "o_orderkey", "left")
            .select(
                _unless_nth(key, 97, key.cast("string")).alias("order_id"),
                _unless_nth(key, 101, F.col("o_custkey").cast("string")).alias("customer_id"),
                F.col("o_orderdate").cast("timestamp_ntz").alias("order_date"),
                _unless_nth(key, 89, status).alias("status"),
                (price * sign).cast("decimal(18,4)").alias("amount"),
                discount.cast(MONEY).alias("discount"),
                ((key % 3) * F.lit(Decimal("2.5"))).cast(MONEY).alias("shipping_cost"),
                F.col("part").cast("string").alias("product_id"),
                F.coalesce("lines", F.lit(1)).cast("int").alias("quantity"),
            )
        )

    @cached_property
    def customers(self) -> DataFrame:
        first_order = (
            self.read("orders")
            .groupBy(F.col("o_custkey").alias("c_custkey"))
            .agg(F.min("o_orderdate").cast("date").alias("signup_date"))
        )
        nations = self.read("nation").select(
            F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country")
        )
        market, key = F.col("c_mktsegment"), F.col("c_custkey")
        email = F.concat(F.lit(" "), F.upper("c_name"), F.lit("@Example.COM"))
        segment = (
            F.when(market == "AUTOMOBILE", "VIP")
            .when(market == "BUILDING", "regular")
            .when(market == "FURNITURE", " new")
            .when(market == "HOUSEHOLD", "at-risk")
            .otherwise("churned")
        )
        return (
            self.read("customer")
            .join(nations, "c_nationkey")
            .join(first_order, "c_custkey", "left")
            .select(
                _unless_nth(key, 97, key.cast("string")).alias("customer_id"),
                F.lit(" customer").alias("first_name"),
                F.substr("c_name", F.lit(10)).alias("last_name"),
                _unless_nth(key, 53, email).alias("email"),
                "country",
                "signup_date",
                _unless_nth(key, 59, segment).alias("segment"),
            )
        )

    @cached_property
    def products(self) -> DataFrame:
        price = (F.col("p_retailprice").cast("decimal(9,2)") - 895) * 2
        share = (F.col("p_size") + 50) * F.lit(Decimal("0.008"))
        key = F.col("p_partkey")
        sign = F.when(key % 61 == 0, 0).when(key % 67 == 0, -1).otherwise(1)
        return self.read("part").select(
            _unless_nth(key, 71, key.cast("string")).alias("product_id"),
            F.concat(F.lit("  "), "p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("sub_category"),
            (price * sign).cast(MONEY).alias("unit_price"),
            F.round(price * share, 2).cast(MONEY).alias("cost_price"),
        )

    @cached_property
    def sessions(self) -> DataFrame:
        user, event = F.col("user_id"), F.col("event_id")
        slot = (user + event % (user % 3 + 1)) % 6
        channel = (
            F.when(slot == 0, "organic_search")
            .when(slot == 1, " Direct")
            .when(slot == 2, "paid_search")
            .when(slot == 3, "SOCIAL")
            .when(slot == 4, "email")
            .otherwise("referral")
        )
        value = F.col("value")
        return self.read("events").select(
            _unless_nth(event, 97, event.cast("string")).alias("session_id"),
            _unless_nth(event, 103, user.cast("string")).alias("customer_id"),
            F.col("ts").cast("date").alias("session_date"),
            _unless_nth(event, 73, channel).alias("channel"),
            (F.floor(value).cast("int") % 5 + 1).alias("pages_visited"),
            F.floor(value * 3).cast("int").alias("time_on_site"),
            (F.col("event_type") == "purchase").alias("converted"),
        )
