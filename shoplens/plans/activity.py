"""Cohort retention from one set of months per customer, kept as bits.

A batch of orders is reduced to its customers' months and added; old orders are not read again. Sets
of the same customer meet by bitwise or.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from shoplens.operators.partials import MOST_BATCHES, Partials
from shoplens.plans.customers import completed_orders
from shoplens.plans.retention import retention_grid

# months in a word; the sign stays out
WORD_MONTHS = 60
FIRST_YEAR = 1970
ACTIVITY = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("word", T.IntegerType()),
        T.StructField("months", T.LongType()),
    ]
)


def activity(orders: DataFrame) -> DataFrame:
    """``customer_id, word, months``: bits of the months with a completed order.

    Bit ``b`` of word ``w`` is month ``60 w + b``, counted from January 1970. Orders without a date
    have a NULL word.
    """
    date = F.col("order_date")
    number = (F.year(date) - FIRST_YEAR) * 12 + F.month(date) - 1
    bit = F.pmod(number, F.lit(WORD_MONTHS))
    months = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    return (
        completed_orders(orders)
        .groupBy("customer_id", ((number - bit) / WORD_MONTHS).cast("int").alias("word"))
        .agg(F.bit_or(months).alias("months"))
    )


def merged_activity(rows: DataFrame) -> DataFrame:
    """Customers are shuffled whole, so that their first month needs no shuffle of its own."""
    return rows.repartition("customer_id").groupBy("customer_id", "word").agg(
        F.bit_or("months").alias("months")
    )


def _month(number: Column) -> Column:
    return F.make_date(
        F.floor(number / 12).cast("int") + FIRST_YEAR, F.pmod(number, F.lit(12)) + 1, F.lit(1)
    )


def retention_of(state: DataFrame) -> DataFrame:
    """The columns and rows of ``cohort_retention``.

    A customer's lowest bit is the cohort. For each cohort and word, each bit is shifted down and
    counted; only these counts are shuffled.
    """
    months = F.col("months")
    # bits below the lowest one
    lowest = F.bit_count(months.bitwiseAND(-months) - 1)
    first = F.min(F.col("word") * WORD_MONTHS + lowest).over(Window.partitionBy("customer_id"))
    counts = [
        F.count_if(F.shiftright(months, b).bitwiseAND(F.lit(1)) == 1) for b in range(WORD_MONTHS)
    ]
    counted = (
        state.withColumn("cohort", first).groupBy("cohort", "word")
        .agg(F.array(*counts).alias("active"), F.count("*").alias("undated"))
    )
    dated = (
        counted.filter("word is not null")
        .select("cohort", "word", F.posexplode("active").alias("bit", "active_customers"))
        .filter("active_customers > 0")
        .select(
            "cohort", (F.col("word") * WORD_MONTHS + F.col("bit") - F.col("cohort")).alias("later"),
            "active_customers",
        )
    )
    undated = counted.filter("word is null and cohort is not null").select(
        "cohort", F.lit(None).cast("int").alias("later"), F.col("undated").alias("active_customers")
    )
    return retention_grid(dated.unionByName(undated).withColumn("cohort", _month(F.col("cohort"))))


class CustomerActivity(Partials):
    """The stored months of customers."""

    def __init__(self, spark: SparkSession, path: str, most: int = MOST_BATCHES) -> None:
        super().__init__(spark, path, ACTIVITY, merged_activity, most)

    def add_orders(self, batch: str, orders: DataFrame) -> None:
        """Adds staged orders; a month that was added before changes nothing."""
        self.add(batch, activity(orders))

    def retention(self) -> DataFrame:
        return retention_of(self.read())
