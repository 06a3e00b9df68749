import random
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from shoplens.operators.layout import Layout


@pytest.fixture
def rows(spark):
    rng = random.Random(3)
    # a third of the rows have one value of ``b``
    values = [
        (rng.randrange(10**6), "hot" if k % 3 == 0 else f"b{rng.randrange(2000):04}", rng.random(),
         None if k % 50 == 0 else k)
        for k in range(40_000)
    ]
    return spark.createDataFrame(values, "a int, b string, c double, d int").repartition(5)


def groups(path):
    """The statistics of all row groups."""
    for file in Path(path).glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for k in range(meta.num_row_groups):
            group = meta.row_group(k)
            yield {
                group.column(c).path_in_schema: group.column(c).statistics
                for c in range(group.num_columns)
            }


def share_read(path, column, low, high):
    """The part of the row groups that a range of a column cannot skip."""
    met = [s[column].min <= high and s[column].max >= low for s in groups(path)]
    assert len(met) > 20
    return sum(met) / len(met)


def write(spark, rows, layout, path):
    # many small files in place of many row groups
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        layout.replace(rows, path)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


LOOKUPS = [("a", 400_000, 410_000), ("b", "b1200", "b1220"), ("c", 0.6, 0.61)]


def test_each_column_alone_skips_most_row_groups(spark, rows, tmp_path):
    sorted_, curved = str(tmp_path / "sorted"), str(tmp_path / "curved")
    write(spark, rows, Layout(cluster_by=("a", "b"), locate_by=("c",)), sorted_)
    write(spark, rows, Layout(interleave_by=("a", "b", "c")), curved)
    # a sort serves its first column and no other
    assert [share_read(sorted_, *x) > 0.9 for x in LOOKUPS] == [False, True, True]
    assert [share_read(curved, *x) < 0.6 for x in LOOKUPS] == [True] * 3
    for column, low, high in LOOKUPS:
        found = f"{column} between '{low}' and '{high}'"
        got = spark.read.parquet(curved).filter(found).collect()
        assert sorted(map(str, got)) == sorted(map(str, rows.filter(found).collect()))


def test_two_columns_with_null_and_one_value(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    write(spark, rows, Layout(interleave_by=("a", "d")), path)
    assert share_read(path, "a", 400_000, 410_000) < 0.35
    stored = spark.read.parquet(path)
    assert stored.columns == rows.columns and stored.count() == 40_000
    one = rows.selectExpr("1 as a", "cast(null as int) as d", "c")
    write(spark, one, Layout(interleave_by=("a", "d")), path)
    assert spark.read.parquet(path).count() == 40_000
    write(spark, rows.limit(0), Layout(interleave_by=("a", "d")), path)
    assert spark.read.parquet(path).count() == 0
