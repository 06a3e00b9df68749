"""Writing tables so that the filters of their readers skip files and row groups."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from shoplens.session import scratch_path
from shoplens.sources.storage import delete_folder, replace_table

# fixed values: columns with the time of the run
UPDATED_AT = "dbt_updated_at"
MART_LOADED_AT = "dbt_loaded_at"
PLACE = "_place"
# ranges of each column of an interleaved layout, as a power of two
RANGE_BITS = 5


@dataclass(frozen=True)
class Layout:
    """How the rows of a table lie in its files.

    Without ``locate_by``, rows are hashed by ``partition_by`` alone, so that a small partition is
    one file, and sorted by ``cluster_by``, so that readers skip row groups and pages. AQE cuts a
    partition beyond the advisory size into several tasks, such as a month with a third of all
    rows. The plan below is evaluated once.

    With ``locate_by``, a nearly unique key that readers look up, rows are partitioned by ranges
    of ``cluster_by`` that end in this key. Every file is narrow in all of them.

    With ``interleave_by``, two or three columns that readers filter one at a time, rows lie along
    a curve through the ranges of all of them, so that each alone skips most files and row groups,
    where a sort by one after the other would serve the first only. It goes with neither of the
    others.
    """

    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    locate_by: tuple[str, ...] = ()
    interleave_by: tuple[str, ...] = ()

    def arrange(self, df: DataFrame) -> DataFrame:
        if self.interleave_by:
            place = interleaved(df, self.interleave_by)
            order = [*self.partition_by, PLACE, *self.interleave_by]
            placed = df.withColumn(PLACE, place).repartitionByRange(*self.partition_by, PLACE)
            return placed.sortWithinPartitions(*order).drop(PLACE)
        order = [*self.partition_by, *self.cluster_by, *self.locate_by]
        if self.locate_by:
            return df.repartitionByRange(*order).sortWithinPartitions(*order)
        if not order:
            return df
        return df.hint("rebalance", *self.partition_by).sortWithinPartitions(*order)

    def replace(
        self, df: DataFrame, path: str, check: Callable[[DataFrame], None] | None = None
    ) -> None:
        """Put ``df`` in the place of the table once it is written and has passed ``check``.

        To range rows, Spark samples them first; the plan is therefore stored and evaluated once.
        """
        spark, staged = df.sparkSession, None
        if self.locate_by or self.interleave_by:
            staged = scratch_path(spark, "ranged")
            df.write.parquet(staged)
            df = spark.read.schema(df.schema).parquet(staged)
        try:
            writer = self.arrange(df).write.partitionBy(*self.partition_by)
            checked = check and (lambda fresh: check(spark.read.schema(df.schema).parquet(fresh)))
            replace_table(spark, path, writer.parquet, checked)
        finally:
            if staged:
                delete_folder(spark, staged)

    def replace_partitions(self, df: DataFrame, path: str) -> None:
        """Overwrite those partitions of the table that ``df`` has rows for."""
        writer = self.arrange(df).write.mode("overwrite").partitionBy(*self.partition_by)
        writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def interleaved(df: DataFrame, columns: Sequence[str], bits: int = RANGE_BITS) -> Column:
    """Where a row lies on a curve through the ranges of ``columns``: their numbers, bit by bit.

    Each column is cut into ``2 ** bits`` ranges of about equal numbers of rows, as Spark samples
    them for a sort; NULL lies in the first one. The driver sees the lower ends of the ranges.
    """
    ranks = [_range_number(c, _lower_ends(df, c, 1 << bits)) for c in columns]
    place = F.lit(0).cast("long")
    for bit in range(bits):
        for k, rank in enumerate(ranks):
            own = F.shiftright(rank, bit).bitwiseAND(F.lit(1))
            place = place + F.shiftleft(own.cast("long"), bit * len(ranks) + k)
    return place


def _lower_ends(df: DataFrame, column: str, ranges: int) -> list:
    values = df.select(column).filter(F.col(column).isNotNull())
    ranged = values.repartitionByRange(ranges, column)
    ends = ranged.groupBy(F.spark_partition_id().alias("range")).agg(F.min(column).alias("low"))
    return sorted(r["low"] for r in ends.collect())


def _range_number(column: str, ends: list) -> Column:
    # the lowest end bounds nothing
    if len(ends) < 2:
        return F.lit(0)
    bounds = F.array(*(F.lit(end) for end in ends[1:]))
    below = F.size(F.filter(bounds, lambda end: end <= F.col(column)))
    return F.when(F.col(column).isNull(), 0).otherwise(below)


def with_run_time(
    df: DataFrame, run_ts: dt.datetime | None = None, name: str = UPDATED_AT
) -> DataFrame:
    """Adds the time of the run. Transforms leave it out, so that their results are repeatable."""
    return df.withColumn(name, F.current_timestamp() if run_ts is None else F.lit(run_ts))
