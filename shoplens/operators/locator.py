"""Which partitions of a stored table may hold given keys, without reading its key column.

Parquet tables have no index. Beside the table lies a small one of 64-bit key hashes and the
partition values they occur in, dealt over buckets by hash. A batch reads only the buckets of its
own keys. Entries are added before the rows they stand for and are never taken back: a partition
that no longer has a key is looked at in vain, but none that has it is passed over.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from shoplens.sources.storage import count_files, delete_folder, folder_names, replace_table

PREFIX = "_keys_"
KEYS_PER_BUCKET = 4_000_000
MOST_BUCKETS = 4096
# files of a bucket, beyond which they are written anew as one
MOST_FILES = 32


def _buckets_for(keys: int) -> int:
    return min(max(math.ceil(keys / KEYS_PER_BUCKET), 1), MOST_BUCKETS)


class KeyLocator:
    """The key table of the partitioned table at ``path``."""

    def __init__(self, spark: SparkSession, path: str, key: str, partition: StructField) -> None:
        self.spark, self.key, self.partition = spark, key, partition
        self.root = path.rstrip("/")
        self.schema = StructType(
            [
                StructField("hashed", LongType()),
                StructField("place", partition.dataType),
                StructField("bucket", IntegerType()),
            ]
        )

    @classmethod
    def of(cls, target: DataFrame, path: str, key: str, partition: StructField) -> KeyLocator:
        """That of a stored table, which is read whole only where there is none yet."""
        found = cls(target.sparkSession, path, key, partition)
        if found._buckets() is None:
            n = found.spark.read.schema(target.schema).parquet(path).count()
            buckets = _buckets_for(n)
            found._write(found._entries(target, buckets).distinct(), buckets)
        return found

    def _buckets(self) -> int | None:
        own = f"{PREFIX}{self.key}_"
        names = [n for n in folder_names(self.spark, self.root) if n.startswith(own)]
        counts = [int(n.removeprefix(own)) for n in names if n.removeprefix(own).isdigit()]
        # where a run was cut off, the one with more buckets is the newer one
        return max(counts, default=None)

    def _folder(self, buckets: int) -> str:
        return f"{self.root}/{PREFIX}{self.key}_{buckets}"

    def _entries(self, rows: DataFrame, buckets: int) -> DataFrame:
        hashed = F.xxhash64(self.key)
        return rows.select(
            hashed.alias("hashed"),
            F.col(self.partition.name).alias("place"),
            F.pmod(hashed, F.lit(buckets)).cast("int").alias("bucket"),
        )

    def _write(self, entries: DataFrame, buckets: int) -> None:
        # a task for each bucket; within its file, equal partition values lie side by side
        dealt = entries.repartition("bucket").sortWithinPartitions("bucket", "place", "hashed")
        replace_table(
            self.spark, self._folder(buckets), dealt.write.partitionBy("bucket").parquet
        )

    def _table(self, buckets: int, chosen: list[int] | None = None) -> DataFrame:
        table = self.spark.read.schema(self.schema).parquet(self._folder(buckets))
        return table if chosen is None else table.filter(F.col("bucket").isin(chosen))

    def _for(self, entries: DataFrame, buckets: int) -> DataFrame:
        """The entries in the buckets of others, of which the folders of the rest are not listed."""
        if buckets == 1:
            return self._table(buckets)
        chosen = [r[0] for r in entries.select("bucket").distinct().collect()]
        return self._table(buckets, chosen)

    def places(self, keys: DataFrame) -> set:
        """The partition values that rows with these keys may have, and perhaps a few others."""
        buckets = self._buckets()
        hashed = F.xxhash64(self.key)
        own = keys.select(
            hashed.alias("hashed"), F.pmod(hashed, F.lit(buckets)).cast("int").alias("bucket")
        )
        found = self._for(own, buckets).join(own.select("hashed"), "hashed", "left_semi")
        return {r[0] for r in found.select("place").distinct().collect()}

    def add(self, batch: DataFrame) -> None:
        """Enters rows that are about to be stored.

        What is known already is entered again: to look it up would cost more, and entries that
        repeat go when the files of a bucket are made one.
        """
        buckets = self._buckets()
        entries = self._entries(batch, buckets)
        if buckets > 1:
            entries = entries.repartition("bucket")
        else:
            entries = entries.coalesce(1)
        entries.write.mode("append").partitionBy("bucket").parquet(self._folder(buckets))
        if count_files(self.spark, self._folder(buckets)) > MOST_FILES * buckets:
            self._rewrite(buckets)

    def _rewrite(self, buckets: int) -> None:
        """Makes the files of each bucket one, with more buckets if there are many more keys."""
        entries = self._table(buckets).select("hashed", "place").distinct()
        now = max(_buckets_for(entries.count()), buckets)
        bucket = F.pmod("hashed", F.lit(now)).cast("int").alias("bucket")
        self._write(entries.select("hashed", "place", bucket), now)
        if now != buckets:
            delete_folder(self.spark, self._folder(buckets))
