"""Consecutive numbers for keys, without sorting them in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shoplens.session import scratch_path
from shoplens.sources.readers import read_table

# the place of a row within its task, in the low bits of its number
PLACE_BITS = 33


def numbered(rows: DataFrame, name: str, after: int = 0) -> DataFrame:
    """``rows`` with the numbers ``after + 1`` and on in a column ``name``.

    Each task numbers its own rows, which are stored, and starts where those before it end; what
    meets in one task are their counts.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "numbered")
    rows.withColumn(name, F.monotonically_increasing_id()).write.parquet(path)
    stored = spark.read.parquet(path)
    task, place = F.shiftright(name, PLACE_BITS), F.col(name).bitwiseAND((1 << PLACE_BITS) - 1)
    sizes = stored.groupBy(task.alias("_task")).agg(F.count("*").alias("_rows"))
    before = F.sum("_rows").over(
        Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = sizes.select("_task", F.coalesce(before, F.lit(0)).alias("_before"))
    found = stored.withColumn("_task", task).join(starts, "_task")
    return found.withColumn(name, F.col("_before") + place + after + 1).drop("_task", "_before")


class Numbers:
    """A stored table of keys and their numbers, from 1 without gaps. A number never changes."""

    def __init__(self, spark: SparkSession, path: str, key: str, name: str = "number") -> None:
        self.spark, self.path, self.key, self.name = spark, path.rstrip("/"), key, name

    def read(self) -> DataFrame:
        stored = read_table(self.spark, self.path)
        if stored is None:
            return self.spark.createDataFrame([], f"{self.key} string, {self.name} bigint")
        return stored

    def add(self, rows: DataFrame) -> None:
        """Numbers the keys of ``rows`` that have none yet; NULL gets none."""
        known = self.read()
        fresh = rows.select(self.key).filter(F.col(self.key).isNotNull()).distinct().join(
            known.select(self.key), self.key, "left_anti"
        )
        after = known.agg(F.coalesce(F.max(self.name), F.lit(0))).first()[0]
        numbered(fresh, self.name, after).select(self.key, self.name).write.mode("append").parquet(
            self.path
        )
