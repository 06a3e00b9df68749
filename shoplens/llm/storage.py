"""Intermediate tables in the shared folder, which outlive the executors that wrote them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shoplens.session import scratch_path
from shoplens.sources.storage import delete_folder


class Scratch:
    """Stored tables of one run, each deleted when it is replaced or dropped."""

    def __init__(self, spark) -> None:
        self.spark = spark
        self.paths: dict[str, str] = {}

    def store(self, df: DataFrame, label: str) -> DataFrame:
        """``df`` written once and read back; an older table of this label goes afterwards."""
        path = scratch_path(self.spark, label)
        df.write.parquet(path)
        self.drop(label)
        self.paths[label] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *labels: str) -> None:
        for label in labels:
            if label in self.paths:
                delete_folder(self.spark, self.paths.pop(label))
