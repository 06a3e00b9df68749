import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from shoplens.operators.numbering import Numbers, numbered
from shoplens.operators.partials import SUM, Partials

SCHEMA = StructType([StructField("k", StringType()), StructField("n", LongType())])


def merge(rows):
    return rows.groupBy("k").agg(F.sum("n").alias("n"))


@pytest.fixture
def table(spark, tmp_path):
    return Partials(spark, str(tmp_path / "t"), SCHEMA, merge, most=3)


def rows(spark, *values):
    return spark.createDataFrame(values, SCHEMA)


def held(table):
    return {r.k: r.n for r in table.read().collect()}


def test_batches_add_up_and_repeated_ones_replace_themselves(spark, table):
    assert held(table) == {}
    table.add("a/b c%", rows(spark, ("x", 1), ("y", 2)))
    table.add("2", rows(spark, ("x", 5)))
    table.add("a/b c%", rows(spark, ("x", 2), ("z", 2)))
    assert held(table) == {"x": 7, "z": 2}


def test_many_batches_become_one_and_are_remembered(spark, table):
    for k in range(4):
        table.add(str(k), rows(spark, ("x", 1)))
    assert table._folders() == [SUM]
    # a late repetition of a batch that was added up, and a new one
    table.add("2", rows(spark, ("x", 100)))
    table.add("new", rows(spark, ("y", 1)))
    assert held(table) == {"x": 4, "y": 1}
    for k in range(10, 14):
        table.add(str(k), rows(spark, ("x", 1)))
    table.add("new", rows(spark, ("y", 100)))
    assert held(table) == {"x": 8, "y": 1}


def test_a_batch_that_fails_leaves_the_table_as_it_was(spark, table):
    table.add("1", rows(spark, ("x", 1)))
    broken = rows(spark, ("x", 1)).withColumn("n", F.raise_error(F.lit("no")).cast("bigint"))
    with pytest.raises(Exception, match="no"):
        table.add("1", broken)
    assert held(table) == {"x": 1}
    assert table._folders() == ["batch=1"]


def test_numbers_have_no_gaps(spark):
    keys = spark.range(1000).repartition(7)
    got = [r.n for r in numbered(keys, "n", after=5).collect()]
    assert sorted(got) == list(range(6, 1006))


def test_numbers_stay(spark, tmp_path):
    numbers = Numbers(spark, str(tmp_path / "n"), "k")
    rng, before = random.Random(1), {}
    for _ in range(4):
        some = [(rng.choice([None, *map(str, range(60))]),) for _ in range(40)]
        numbers.add(spark.createDataFrame(some, "k string").repartition(3))
        now = {r.k: r.number for r in numbers.read().collect()}
        assert before.items() <= now.items() and {k for k, in some} - {None} <= now.keys()
        assert sorted(now.values()) == list(range(1, len(now) + 1))
        before = now
