"""Tables of rows that add up: appended batch by batch, added up when they are read.

A batch costs what the batch holds, not what is stored. Each lies in a folder of its own name, so a
batch that is put in again after a failure replaces itself. When there are many, they are added up
into one folder; the names of those are kept, and a batch of such a name is not put in again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from shoplens.sources.storage import (
    delete_folder, file_names, folder_names, move_folder, read_text, replace_table, write_text,
)

PREFIX = "batch="
SUM = f"{PREFIX}_sum"
NAMES = "_summed.json"
MOST_BATCHES = 16


@dataclass(frozen=True)
class Partials:
    """The table at ``path`` of rows that ``merge`` adds up, into rows of the same ``schema``."""

    spark: SparkSession
    path: str
    schema: StructType
    merge: Callable[[DataFrame], DataFrame]
    most: int = MOST_BATCHES

    def add(self, batch: str, rows: DataFrame) -> None:
        """Puts in the rows of a batch, in place of what an earlier attempt at it left."""
        if batch in self._summed():
            return
        fresh = f"{self.path}/.fresh-{uuid.uuid4().hex}"
        own = f"{self.path}/{PREFIX}{quote(batch, safe='')}"
        try:
            rows.select(*self.schema.names).write.parquet(fresh)
            delete_folder(self.spark, own)
            move_folder(self.spark, fresh, own)
        finally:
            delete_folder(self.spark, fresh)
        if len(self._folders()) > self.most:
            self.sum_up()

    def read(self) -> DataFrame:
        """What all batches add up to; no rows where there are none."""
        folders = self._folders()
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        stored = self.spark.read.schema(self.schema).parquet(
            *(f"{self.path}/{name}" for name in folders)
        )
        return self.merge(stored)

    def sum_up(self) -> None:
        """Makes one folder of all batches; a reader sees either all of them or their sum."""
        own = {unquote(n.removeprefix(PREFIX)) for n in self._folders() if n != SUM}
        names = sorted(self._summed() | own)
        rows = self.read().select(*self.schema.names)

        def write(folder: str) -> None:
            rows.write.parquet(f"{folder}/{SUM}")
            write_text(
                self.spark, f"{folder}/{NAMES}", json.dumps(names),
                by_way_of=f"{folder}/{NAMES}.part",
            )

        replace_table(self.spark, self.path, write)

    def _folders(self) -> list[str]:
        return [n for n in folder_names(self.spark, self.path) if n.startswith(PREFIX)]

    def _summed(self) -> set[str]:
        if NAMES not in file_names(self.spark, self.path):
            return set()
        return set(json.loads(read_text(self.spark, f"{self.path}/{NAMES}")))
