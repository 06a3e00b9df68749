"""Loading CSV files of which some lines cannot be read.

Good lines are loaded. Bad ones are kept beside them with their file and what is wrong, and too many
of them refuse the load.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shoplens.session import scratch_path
from shoplens.sources.readers import load_raw
from shoplens.sources.schemas import LOADED_AT, RAW_SCHEMAS
from shoplens.sources.storage import delete_folder

LINE, FILE, REASON = "_line", "_file", "_reason"
FIELDS = "wrong number of fields"
MOST_BAD = 0.01


class TooManyBadLines(ValueError):
    """More lines of a load are bad than its bound allows."""


def read_lines(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The columns of a raw table with ``_line``, ``_file`` and ``_reason``, which a good line lacks.

    A line is bad if it has another number of fields than the header, a text that is not of its
    column's type, or one that is longer than its column. A header with other names raises.
    """
    schema = RAW_SCHEMAS[table]
    parsed = (
        spark.read.schema(StructType([*schema.fields, StructField(LINE, StringType())]))
        .options(
            header=True, mode="PERMISSIVE", enforceSchema=False, columnNameOfCorruptRecord=LINE
        )
        .csv(path)
        .withColumn(FILE, F.col("_metadata.file_path"))
    )
    texts = StructType([StructField(f.name, StringType()) for f in schema])
    # read once more as texts, bad lines tell which column is at fault
    as_text = F.from_csv(LINE, texts.simpleString().removeprefix("struct<").removesuffix(">")
                         .replace(":", " "))
    reason: Column = F.when(F.col(LINE).isNotNull(), _reason(schema, as_text))
    too_long = F.coalesce(*_too_long(schema))
    row = F.to_csv(F.struct(*schema.names))
    bad_line = F.coalesce(F.col(LINE), F.when(too_long.isNotNull(), row))
    return parsed.select(
        *schema.names, FILE, F.coalesce(reason, too_long).alias(REASON), bad_line.alias(LINE)
    )


def _reason(schema: StructType, as_text: Column) -> Column:
    faults = []
    for field in schema:
        text = F.nullif(as_text[field.name], F.lit(""))
        kind = field.dataType.simpleString()
        if kind != "string":
            wrong = text.isNotNull() & text.try_cast(field.dataType).isNull()
            faults.append(F.when(wrong, F.lit(f"{field.name} is not of type {kind}")))
    return F.coalesce(*faults, F.lit(FIELDS))


def _too_long(schema: StructType) -> list[Column]:
    limits = {f.name: f.metadata["max_length"] for f in schema if f.metadata.get("max_length")}
    return [
        F.when(F.length(name) > limit, F.lit(f"{name} is longer than {limit}"))
        for name, limit in limits.items()
    ]


def load_csv(
    spark: SparkSession,
    csv: str,
    table: str,
    path: str,
    rejected: str,
    *,
    most_bad: float = MOST_BAD,
    run_ts: dt.datetime | None = None,
    append: bool = False,
) -> tuple[int, int]:
    """Loads the good lines as ``load_raw`` does and adds the bad ones to the table ``rejected``.

    That has the columns ``_line, _file, _reason`` and the load time. The bad lines are kept in any
    case; if their share is above ``most_bad``, the load is refused and the raw table stays as it
    was. Returns the numbers of good and bad lines. Files are read once: the lines are stored in the
    scratch folder before they are told apart, as a reader that is asked for some columns only
    would not see what is wrong with others.
    """
    staged = scratch_path(spark, "lines")
    lines = read_lines(spark, csv, table)
    lines.write.parquet(staged)
    try:
        stored = spark.read.schema(lines.schema).parquet(staged)
        is_bad = F.col(REASON).isNotNull()
        n, bad = stored.agg(F.count("*"), F.count_if(is_bad)).first()
        if bad:
            loaded_at = F.localtimestamp() if run_ts is None else F.lit(run_ts)
            stored.filter(is_bad).select(
                LINE, FILE, REASON, loaded_at.cast("timestamp_ntz").alias(LOADED_AT)
            ).write.mode("append").parquet(rejected)
        if bad > most_bad * n:
            raise TooManyBadLines(f"{bad} of {n} lines of {csv} are bad; see {rejected}")
        load_raw(stored.filter(~is_bad), table, path, run_ts, append)
    finally:
        delete_folder(spark, staged)
    return n - bad, bad
