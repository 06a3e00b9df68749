"""Folders of tables on whatever file system a path names."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import SparkSession


def _folder(spark: SparkSession, path: str):
    """A folder and its file system."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_folder(spark: SparkSession, path: str) -> None:
    folder, files = _folder(spark, path)
    files.delete(folder, True)


def delete_file(spark: SparkSession, path: str) -> None:
    """Deletes a file if it is there."""
    file, files = _folder(spark, path)
    files.delete(file, False)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders inside one; none if it does not exist."""
    folder, files = _folder(spark, path)
    if not files.exists(folder):
        return []
    return [s.getPath().getName() for s in files.listStatus(folder) if s.isDirectory()]


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files right in a folder; none if it does not exist."""
    folder, files = _folder(spark, path)
    if not files.exists(folder):
        return []
    return [s.getPath().getName() for s in files.listStatus(folder) if s.isFile()]


def count_files(spark: SparkSession, path: str) -> int:
    """How many files there are anywhere below a folder."""
    folder, files = _folder(spark, path)
    return files.getContentSummary(folder).getFileCount()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    file, files = _folder(spark, path)
    stream = files.open(file)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, by_way_of: str) -> None:
    """A small file, moved to ``path``, where nothing may lie yet, once it is written."""
    file, files = _folder(spark, by_way_of)
    stream = files.create(file, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    _rename(spark, by_way_of, path)


def replace_table(
    spark: SparkSession,
    path: str,
    write: Callable[[str], None],
    check: Callable[[str], None] | None = None,
) -> None:
    """Puts what ``write`` writes in the place of the table at ``path``.

    The new table is written to a folder beside the old one and checked there; what fails before leaves the old
    table as it was. Then the old one is moved aside, the new one moved in and the old one deleted:
    two renames, which no reader of a table that is opened later can fall between but for their
    moment.
    """
    path = path.rstrip("/")
    fresh, old = f"{path}.new-{uuid.uuid4().hex}", f"{path}.old-{uuid.uuid4().hex}"
    try:
        write(fresh)
        if check:
            check(fresh)
        folder, files = _folder(spark, path)
        if files.exists(folder):
            _rename(spark, path, old)
        try:
            _rename(spark, fresh, path)
        except OSError:
            if files.exists(_folder(spark, old)[0]):
                _rename(spark, old, path)
            raise
    finally:
        delete_folder(spark, fresh)
    delete_folder(spark, old)


def move_folder(spark: SparkSession, path: str, to: str) -> None:
    """Moves a folder or file to where nothing lies."""
    _rename(spark, path, to)


def _rename(spark: SparkSession, path: str, to: str) -> None:
    folder, files = _folder(spark, path)
    if not files.rename(folder, _folder(spark, to)[0]):
        raise OSError(f"{path} could not be moved to {to}")


NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def partition_texts(spark: SparkSession, path: str, column: str) -> list[str | None]:
    """The values of a partition column as folder names give them, without opening a file."""
    start = f"{column}="
    names = [n.removeprefix(start) for n in folder_names(spark, path) if n.startswith(start)]
    return [None if n == NULL_PARTITION else unquote(n) for n in names]


def delete_partition(spark: SparkSession, path: str, column: str, value: object) -> None:
    """Deletes the folder of one partition value."""
    text = None if value is None else str(value)
    for name in folder_names(spark, path):
        own, _, rest = name.partition("=")
        if own == column and (None if rest == NULL_PARTITION else unquote(rest)) == text:
            delete_folder(spark, f"{path.rstrip('/')}/{name}")
