"""The columns of a stored table, kept beside its files.

Files of different ages may have different columns. Reading them with the table's own schema aligns
them: what a file lacks is NULL, what the table has dropped is not read. A change of columns is
thereby one small file and leaves the data alone. Each change adds a file of the next number, moved
in when it is complete; the highest number counts.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from shoplens.sources.storage import file_names, read_text, write_text

NAME = re.compile(r"_columns-(\d+)\.json")


@dataclass(frozen=True)
class TableSchema:
    """The columns of a table, and former ones that some of its files may still hold."""

    columns: StructType
    dropped: frozenset[str] = frozenset()

    def after(self, columns: StructType) -> TableSchema | None:
        """The schema once the table has these columns, or None if that takes other files.

        A column of another type does, and one that had been dropped before: its old values would
        come back.
        """
        before, now = ({f.name: f.dataType for f in c} for c in (self.columns, columns))
        if any(now[name] != kind for name, kind in before.items() if name in now):
            return None
        if self.dropped & now.keys():
            return None
        return TableSchema(columns, self.dropped | (before.keys() - now.keys()))


def stored_schema(spark: SparkSession, path: str) -> TableSchema | None:
    """The schema kept beside a table; None where there is none."""
    numbers = _numbers(spark, path)
    if not numbers:
        return None
    text = read_text(spark, f"{path.rstrip('/')}/_columns-{max(numbers)}.json")
    held = json.loads(text)
    return TableSchema(StructType.fromJson(held["columns"]), frozenset(held["dropped"]))


def store_schema(spark: SparkSession, path: str, schema: TableSchema) -> None:
    """Keeps ``schema`` from now on. Of two writers at once, the second one fails."""
    folder = path.rstrip("/")
    number = max(_numbers(spark, path), default=0) + 1
    held = {"columns": schema.columns.jsonValue(), "dropped": sorted(schema.dropped)}
    write_text(
        spark, f"{folder}/_columns-{number}.json", json.dumps(held),
        by_way_of=f"{folder}/_columns-{uuid.uuid4().hex}.part",
    )


def _numbers(spark: SparkSession, path: str) -> list[int]:
    found = (NAME.fullmatch(name) for name in file_names(spark, path))
    return [int(m[1]) for m in found if m]
