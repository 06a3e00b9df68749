"""Different visitors of a channel in any period, from what is stored for each day.

Counts of different visitors cannot be added up, sets can. Customers have consecutive numbers; those
seen on a day in a channel are bits, in blocks of 32,768 numbers. Blocks of a week or month meet by
bitwise or, and their bits are counted. All counts are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shoplens.operators.numbering import Numbers
from shoplens.operators.partials import MOST_BATCHES, Partials

# fixed values: periods, by which days are added up
PERIODS = ("day", "week", "month")
DAY_KEYS = ("session_date", "channel", "channel_group")
VISITORS = T.StructType(
    [
        T.StructField("session_date", T.DateType()),
        T.StructField("channel", T.StringType()),
        T.StructField("channel_group", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("visitors", T.BinaryType()),
    ]
)


def visitor_sets(sessions: DataFrame, numbers: DataFrame) -> DataFrame:
    """The customers of each day and channel as blocks of bits; unknown ones are an empty block."""
    number = F.col("number")
    return (
        sessions.join(numbers, "customer_id", "left")
        .groupBy(*DAY_KEYS, F.bitmap_bucket_number(number).alias("block"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("visitors"))
    )


def merged_sets(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*DAY_KEYS, "block").agg(F.bitmap_or_agg("visitors").alias("visitors"))


def visitors_of(sets: DataFrame, period: str) -> DataFrame:
    """``period_start, channel, channel_group, unique_visitors``."""
    if period not in PERIODS:
        raise ValueError(f"{period} is none of {', '.join(PERIODS)}")
    start = F.date_trunc(period, F.col("session_date").cast("timestamp_ntz")).cast("date")
    keys = (start.alias("period_start"), "channel", "channel_group")
    blocks = sets.groupBy(*keys, "block").agg(F.bitmap_or_agg("visitors").alias("visitors"))
    return blocks.groupBy("period_start", "channel", "channel_group").agg(
        F.sum(F.bitmap_count("visitors")).alias("unique_visitors")
    )


class ChannelVisitors:
    """The stored days of channels below ``root``, and the numbers of their customers."""

    def __init__(self, spark: SparkSession, root: str, most: int = MOST_BATCHES) -> None:
        root = root.rstrip("/")
        self.numbers = Numbers(spark, f"{root}/customers", "customer_id")
        self.days = Partials(spark, f"{root}/days", VISITORS, merged_sets, most)

    def add(self, batch: str, sessions: DataFrame) -> None:
        """Adds staged sessions. A day may come in several batches, and a session more than once."""
        self.numbers.add(sessions)
        self.days.add(batch, visitor_sets(sessions, self.numbers.read()))

    def unique(self, period: str) -> DataFrame:
        return visitors_of(self.days.read(), period)
