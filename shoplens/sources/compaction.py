"""Making few files of the many that appending leaves behind.

An append adds files for the range of days it covers. Where a month has gathered many small ones,
these are written anew as few; large files and other months are left alone. Readers of the table
may see rows twice for the moment in which the new files are there and the old ones go, and none is
ever missing: a journal in the table's folder names what has to go, so that a run that was cut off
is finished by the next one.
"""

from __future__ import annotations

import json
import math
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from shoplens.sources.storage import (
    delete_file, delete_folder, file_names, folder_names, move_folder, read_text, write_text,
)

TARGET_BYTES = 128 << 20
MOST_SMALL = 8
JOURNAL = "_compaction.json"


def file_statistics(spark: SparkSession, path: str, column: str) -> DataFrame:
    """``file, bytes, low, high``: the range of a column in each file; one column is read."""
    rows = spark.read.parquet(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"),
        F.col(column).alias("value"),
    )
    return rows.groupBy("file", "bytes").agg(
        F.min("value").alias("low"), F.max("value").alias("high")
    )


def compact(
    spark: SparkSession,
    path: str,
    column: str,
    target_bytes: int = TARGET_BYTES,
    most_small: int = MOST_SMALL,
) -> int:
    """Rewrites the small files of months that have more than ``most_small`` of them.

    A file belongs to the month of its lowest ``column`` (those with NULL alone to none of them),
    and is small below half of ``target_bytes``. The rows of chosen files are ranged and sorted by
    the column again. Returns how many files were replaced. What the driver sees are names of files.
    """
    path = path.rstrip("/")
    _finish(spark, path)
    small = file_statistics(spark, path, column).filter(F.col("bytes") * 2 < target_bytes)
    months = small.groupBy(F.trunc("low", "month").alias("month")).agg(
        F.collect_list("file").alias("files"), F.sum("bytes").alias("bytes")
    )
    chosen = months.filter(F.size("files") > most_small).collect()
    old = [file for month in chosen for file in month["files"]]
    if not old:
        return 0
    # a month gets a whole number of files, and all of them together one job
    parts = sum(math.ceil(month["bytes"] / target_bytes) for month in chosen)
    rows = spark.read.parquet(*old)
    fresh = f"{path}/.compact-{uuid.uuid4().hex}"
    rows.repartitionByRange(parts, column).sortWithinPartitions(column).write.parquet(fresh)
    stored = spark.read.schema(rows.schema).parquet(fresh)
    if stored.count() != rows.count():
        delete_folder(spark, fresh)
        raise RuntimeError(f"{path} changed while it was compacted")
    journal = {"fresh": fresh.rpartition("/")[2], "old": [f.rpartition("/")[2] for f in old]}
    write_text(spark, f"{path}/{JOURNAL}", json.dumps(journal), by_way_of=f"{path}/{JOURNAL}.part")
    _finish(spark, path)
    return len(old)


def _finish(spark: SparkSession, path: str) -> None:
    """Moves the new files in and deletes the old ones, as far as that has not been done."""
    if JOURNAL not in file_names(spark, path):
        return
    journal = json.loads(read_text(spark, f"{path}/{JOURNAL}"))
    fresh = f"{path}/{journal['fresh']}"
    if journal["fresh"] in folder_names(spark, path):
        for name in file_names(spark, fresh):
            if name.endswith(".parquet"):
                move_folder(spark, f"{fresh}/{name}", f"{path}/{name}")
    for name in journal["old"]:
        delete_file(spark, f"{path}/{name}")
    delete_folder(spark, fresh)
    delete_file(spark, f"{path}/{JOURNAL}")
