"""Raw table schemas, readers and loaders."""

from shoplens.sources.readers import load_raw, read_csv, read_parquet, read_table
from shoplens.sources.schemas import LOADED_AT, RAW_SCHEMAS

__all__ = ["LOADED_AT", "RAW_SCHEMAS", "load_raw", "read_csv", "read_parquet", "read_table"]
