"""The incremental order table fed by a file stream.

A second way to find what is new, besides the high-water mark: the stream's checkpoint remembers
the files it has seen. Late orders and changed ones are therefore picked up as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType, TimestampNTZType

from shoplens.functions import row_text
from shoplens.operators import layout
from shoplens.operators.upsert import upsert_table
from shoplens.plans.orders import ORDERS_LAYOUT, orders_enriched
from shoplens.plans.staging import stg_orders
from shoplens.sources import LOADED_AT, RAW_SCHEMAS, read_table


# what orders the versions of an order in the table: the time of the load, then a digest, so that
# versions of one load are told apart alike in whatever batches they arrive
VERSION = (LOADED_AT, "_version")


def latest_versions(raw_orders: DataFrame) -> DataFrame:
    """The version of each order that was loaded last, with the columns ``VERSION``.

    A missing load time is the earliest. Of versions loaded at the same time, that with the greatest
    MD5 digest of its columns is taken, in which NULL differs from every value.
    """
    columns = [c for c in raw_orders.columns if c != LOADED_AT]
    digest = F.md5(row_text(*columns))
    versions = raw_orders.withColumn("_version", digest)
    latest = F.max_by(F.struct(*versions.columns), F.struct(*VERSION))
    return versions.groupBy("order_id").agg(latest.alias("version")).select("version.*")


def follow_orders(
    spark: SparkSession,
    raw_path: str,
    table_path: str,
    checkpoint: str,
    products: DataFrame,
    customers: DataFrame,
) -> StreamingQuery:
    """Put all order files that have arrived into the table, then stop.

    A batch repeated after a failure changes nothing, as rows are put in by key. Files may arrive
    in any order and without load times: an older version never replaces a newer one. An order whose
    latest version staging refuses, for want of a customer or a positive amount, leaves the table.
    """
    schema = StructType([*RAW_SCHEMAS["raw_orders"].fields]).add(LOADED_AT, TimestampNTZType())

    def put(batch: DataFrame, _: int) -> None:
        latest = latest_versions(batch)
        staged = stg_orders(latest)
        enriched = orders_enriched(staged, products, customers)
        versioned = enriched.join(latest.select("order_id", *VERSION), "order_id")
        rows = layout.with_run_time(versioned, name=layout.MART_LOADED_AT)
        target = read_table(spark, table_path)
        refused = latest.join(staged.select("order_id"), "order_id", "left_anti")
        if target is not None:
            # only a version that is not older takes the stored order away
            stored = target.select("order_id", F.struct(*VERSION).alias("stored"))
            newest = refused.select("order_id", F.struct(*VERSION).alias("own"))
            refused = newest.join(stored, "order_id").filter("not (stored > own)")
        upsert_table(
            spark, table_path, target, rows, "order_id", ORDERS_LAYOUT,
            removed=refused.select("order_id"), newer=VERSION,
        )

    arriving = spark.readStream.schema(schema).parquet(raw_path)
    return (
        arriving.writeStream.foreachBatch(put)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
