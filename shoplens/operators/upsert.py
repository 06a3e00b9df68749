"""Keeping a stored table current by key.

Plain Parquet tables have no merge statement. The partitions a batch touches are rewritten from
their surviving rows and the batch; all others keep their files, and are not opened either: a key
table says where the batch's keys may lie. Columns that a batch adds or drops change the schema
kept beside the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from shoplens.operators.layout import Layout
from shoplens.operators.locator import KeyLocator
from shoplens.session import scratch_path
from shoplens.sources.storage import delete_folder, delete_partition
from shoplens.sources.table_schema import TableSchema, store_schema, stored_schema


class DuplicateKeys(ValueError):
    """A batch names a key more than once, so the row to keep is not defined."""


def upsert(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """``target`` with the rows of ``batch`` put in, replacing those of the same key."""
    kept = target.join(batch.select(key), key, "left_anti")
    return kept.unionByName(batch)


def align(df: DataFrame, like: DataFrame) -> DataFrame:
    """``df`` with the columns of ``like``: missing ones are NULL, surplus ones go."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in like.schema
        ]
    )


def upsert_table(
    spark: SparkSession,
    path: str,
    target: DataFrame | None,
    batch: DataFrame,
    key: str,
    layout: Layout,
    *,
    removed: DataFrame | None = None,
    newer: Sequence[str] = (),
) -> None:
    """Put ``batch`` into ``target``, the table at ``path``.

    Where nothing is stored yet, the batch becomes the table. Stored rows whose key is in
    ``removed`` go. With ``newer``, columns that order the versions of a row (NULL comes first), a
    row gives way only to one that is not older.

    Only partitions that may hold a key of the batch are opened, whichever month a row moves from.
    Columns that the batch adds are NULL in older rows, those it lacks are dropped; neither touches
    the files of other partitions. A column of another type, or one that had been dropped before,
    has every partition rewritten.

    The batch is written to the shared scratch folder first: it is used several times, its size
    is then known to the planner, and a lost executor repeats a scan instead of the whole plan.
    Rewritten partitions replace the old ones when the job commits, one rename each. Partitions
    that lost all their rows go last, so a run cut off there leaves a row twice, which the check
    of the key shows, and never none.
    """
    if target is None:
        layout.replace(
            batch, path, lambda rows: _refuse_repeats(_summary(rows, key).collect(), key, path)
        )
        store_schema(spark, path, TableSchema(batch.schema))
        (partition,) = layout.partition_by
        stored = spark.read.schema(batch.schema).parquet(path)
        KeyLocator.of(stored, path, key, batch.schema[partition])
        return
    staged: list[str] = []

    def stage(df: DataFrame) -> DataFrame:
        staged.append(scratch_path(spark, "batch"))
        df.write.parquet(staged[-1])
        return spark.read.schema(df.schema).parquet(staged[-1])

    try:
        batch = stage(batch)
        gone = None if removed is None else stage(removed.select(key).distinct())
        (partition,) = layout.partition_by
        target = _as_partitioned(spark, path, target, batch.schema[partition])
        keys = batch.select(key) if gone is None else batch.select(key).unionAll(gone)
        locator = KeyLocator.of(target, path, key, batch.schema[partition])
        # other partitions have no row that the batch concerns
        near = target.filter(any_of(partition, locator.places(keys)))
        known = [c for c in newer if c in target.columns]
        if known:
            batch = stage(_not_older(batch, near, key, known))
            keys = batch.select(key) if gone is None else batch.select(key).unionAll(gone)
        _put(spark, path, target, near, batch, keys, key, layout, locator)
    finally:
        for folder in staged:
            delete_folder(spark, folder)


def _summary(batch: DataFrame, key: str, partition: str | None = None) -> DataFrame:
    """The partitions of a batch, each with the most rows that one of its keys has."""
    place = F.first(partition) if partition else F.lit(None)
    keys = batch.groupBy(key).agg(F.count("*").alias("n"), place.alias("place"))
    return keys.groupBy("place").agg(F.max("n").alias("n"))


def _refuse_repeats(summary: list[Row], key: str, path: str) -> None:
    if any(r["n"] > 1 for r in summary):
        raise DuplicateKeys(f"{key} is not unique in the batch for {path}")


def _not_older(batch: DataFrame, target: DataFrame, key: str, newer: Sequence[str]) -> DataFrame:
    stored = target.select(key, F.struct(*newer).alias("stored_version"))
    older = (
        batch.select(key, F.struct(*newer).alias("own_version")).join(stored, key)
        .filter(F.col("stored_version") > F.col("own_version"))
    )
    return batch.join(older.select(key), key, "left_anti")


def _put(
    spark: SparkSession, path: str, target: DataFrame, near: DataFrame, batch: DataFrame,
    keys: DataFrame, key: str, layout: Layout, locator: KeyLocator,
) -> None:
    (partition,) = layout.partition_by
    # one query for all that is to be known
    places = _summary(batch, key, partition).withColumn("gains", F.lit(True)).unionByName(
        _partitions_holding(near, keys, key, partition).select(
            "place", F.lit(1).cast("bigint").alias("n"), F.lit(False).alias("gains")
        )
    ).collect()
    _refuse_repeats(places, key, path)
    gaining = {r["place"] for r in places if r["gains"]}
    holding = {r["place"] for r in places if not r["gains"]}
    emptied = holding - gaining
    if emptied:
        left = target.filter(any_of(partition, emptied))
        emptied -= _values(left.join(keys, key, "left_anti"), partition)

    before = stored_schema(spark, path) or TableSchema(target.schema)
    now = before.after(batch.schema)
    locator.add(batch)
    if now is not None:
        target = target.filter(any_of(partition, gaining | holding))
    # otherwise old files cannot be read as the new columns, and every partition is rewritten
    if now is None or gaining or holding:
        merged = align(target, batch).join(keys, key, "left_anti").unionByName(batch)
        layout.replace_partitions(merged, path)
        for value in emptied:
            delete_partition(spark, path, partition, value)
    if now is None or now.dropped != before.dropped or _types(batch) != _types(target):
        store_schema(spark, path, now or TableSchema(batch.schema))


def _as_partitioned(
    spark: SparkSession, path: str, target: DataFrame, partition: StructField
) -> DataFrame:
    """The table with the partition column of that type.

    Folder names carry no types: read without a schema, the text ``007`` becomes a number.
    """
    if target.schema[partition.name].dataType == partition.dataType:
        return target
    fields = [partition if f.name == partition.name else f for f in target.schema]
    return spark.read.schema(StructType(fields)).parquet(path)


def _partitions_holding(
    target: DataFrame, keys: DataFrame, key: str, partition: str
) -> DataFrame:
    """Partitions (``place``) with rows of these keys.

    Keys travel as 64-bit hashes: a collision only rewrites a partition in vain.
    """
    hashed = F.xxhash64(key).alias("hashed")
    found = target.select(hashed, partition).join(keys.select(hashed), "hashed", "left_semi")
    return found.select(F.col(partition).alias("place")).distinct()


def _values(df: DataFrame, column: str) -> set:
    """Distinct partition values, of which a table has few."""
    return {r[0] for r in df.select(column).distinct().collect()}


def _types(df: DataFrame) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in df.schema}


def any_of(name: str, values: set) -> Column:
    """Whether a column has one of a few values, NULL among them if it is listed."""
    chosen = F.col(name).isin([v for v in values if v is not None])
    return chosen | F.col(name).isNull() if None in values else chosen
