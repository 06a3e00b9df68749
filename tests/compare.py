"""Comparing a Spark result with a DuckDB result as multisets of rows."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = Path(folder) / f"{table}.parquet"
        con.execute(f"create view {table} as select * from read_parquet('{path}')")
    return con


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, list]:
    """Number of expected rows and what either side has more of."""
    types = {r[0]: r[1] for r in con.execute(f"describe {sql}").fetchall()}
    assert sorted(types) == sorted(df.columns), (sorted(types), sorted(df.columns))
    simple = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
              "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
    wrong = {n: (t, types[n]) for n, t in df.dtypes if simple.get(t) != types[n]}
    assert not wrong, wrong
    names = sorted(types)
    quoted = ", ".join(f'"{n}"' for n in names)
    expected = Counter(con.execute(f"select {quoted} from ({sql})").fetchall())
    actual = Counter(tuple(r) for r in df.select(*names).collect())
    extra = [("spark", names, r) for r in list((actual - expected).elements())[:3]]
    extra += [("sql", names, r) for r in list((expected - actual).elements())[:3]]
    return sum(expected.values()), extra
