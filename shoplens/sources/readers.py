"""Reading raw data and stored tables."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from shoplens.sources.schemas import LOADED_AT, RAW_SCHEMAS
from shoplens.sources.storage import replace_table
from shoplens.sources.table_schema import stored_schema

# raw rows lie in ranges of these columns, by which readers look for what is new
ARRIVAL_ORDER = {"raw_orders": "order_date"}


def read_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A raw table from CSV files with a header. Malformed lines and wrong headers raise."""
    return (
        spark.read.schema(RAW_SCHEMAS[table])
        .options(header=True, mode="FAILFAST", enforceSchema=False)
        .csv(path)
    )


def read_parquet(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A raw table from Parquet files of any numeric types, with the declared types."""
    stored = spark.read.parquet(path)
    columns = [F.col(f.name).cast(f.dataType) for f in RAW_SCHEMAS[table]]
    return stored.select(*columns, *[c for c in stored.columns if c == LOADED_AT])


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """A stored table, or None where nothing has been written yet.

    Its columns are those kept beside it; without these, those of its files.
    """
    kept = stored_schema(spark, path)
    if kept:
        return spark.read.schema(kept.columns).parquet(path)
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def load_raw(
    df: DataFrame, table: str, path: str, run_ts: dt.datetime | None = None, append: bool = False
) -> None:
    """Create, replace or extend a raw table: declared columns, checked lengths and a load time.

    A load that is refused leaves the table as it was.
    """
    schema: StructType = RAW_SCHEMAS[table]
    columns = []
    for field in schema:
        c = F.col(field.name).cast(field.dataType)
        limit = field.metadata.get("max_length")
        if limit:
            message = F.lit(f"{table}.{field.name} is longer than {limit}")
            c = F.when(F.length(c) > limit, F.raise_error(message)).otherwise(c)
        columns.append(c.alias(field.name))
    loaded_at = F.localtimestamp() if run_ts is None else F.lit(run_ts).cast("timestamp_ntz")
    rows = df.select(*columns, loaded_at.alias(LOADED_AT))
    if table in ARRIVAL_ORDER:
        order = ARRIVAL_ORDER[table]
        rows = rows.repartitionByRange(order).sortWithinPartitions(order)
    if append:
        rows.write.mode("append").parquet(path)
    else:
        replace_table(df.sparkSession, path, rows.write.parquet)
