"""Stored tables by name in the session's catalog, for other sessions too."""

from __future__ import annotations

from pyspark.sql import SparkSession

from shoplens.plans.build import table_path
from shoplens.sources.storage import folder_names
from shoplens.sources.table_schema import stored_schema

LAYERS = ("raw", "marts")
MOVED = (".new-", ".old-")


def publish(spark: SparkSession, root: str) -> list[str]:
    """Schemas ``raw`` and ``marts`` with an external table for each one stored below ``root``.

    Publishing again picks up new columns and partitions; dropping a published table leaves its
    files. Returns the names.
    """
    names = []
    for layer in LAYERS:
        spark.sql(f"create schema if not exists {layer}")
        folder = table_path(root, layer, "").rstrip("/")
        for name in sorted(folder_names(spark, folder)):
            if any(part in name for part in MOVED):
                continue
            table, path = f"{layer}.{name}", table_path(root, layer, name)
            spark.sql(f"drop table if exists {table}")
            _create(spark, table, path)
            if any(c.isPartition for c in spark.catalog.listColumns(table)):
                spark.catalog.recoverPartitions(table)
            names.append(table)
    return names


def _create(spark: SparkSession, table: str, path: str) -> None:
    kept = stored_schema(spark, path)
    if kept is None:
        spark.catalog.createTable(table, path=path, source="parquet")
        return
    # folders of partitions are named after their column
    names = {name.partition("=")[0] for name in folder_names(spark, path) if "=" in name}
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.columns)
    parts = ", ".join(f"`{name}`" for name in sorted(names))
    by = f"partitioned by ({parts}) " if parts else ""
    spark.sql(f"create table {table} ({columns}) using parquet {by}location '{path}'")
