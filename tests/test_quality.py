import pytest

from shoplens.operators.quality import (
    AcceptedValues,
    Holds,
    NotNull,
    Relationship,
    Unique,
    report,
    value_failures,
)


@pytest.fixture
def tables(spark):
    rows = [("a", "x", 1, 2), ("a", None, 2, 1), (None, "y", None, 1), (None, "z", 3, 3)]
    return {
        "t": spark.createDataFrame(rows, "k string, s string, n int, m int"),
        "parent": spark.createDataFrame([("x",), ("y",), (None,)], "s string"),
    }


CHECKS = [
    Unique("t", "k"),
    NotNull("t", "k"),
    AcceptedValues("t", "s", values=("x", "y")),
    Holds("t", "n", "n_le_m", "n <= m"),
    Relationship("t", "s", parent="parent", parent_column="s"),
    NotNull("parent", "s"),
]


def test_report(tables):
    got = {(r.model, r.test): r.failures for r in report(CHECKS, tables).collect()}
    assert got == {
        ("t", "unique"): 1, ("t", "not_null"): 2, ("t", "accepted_values"): 1, ("t", "n_le_m"): 1,
        ("t", "relationships"): 1, ("parent", "not_null"): 1,
    }


def test_every_table_is_read_once(tables):
    plan = report(CHECKS, tables)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LocalRelation") + plan.count("LogicalRDD") == len(tables)


def test_failing_rows(tables):
    assert NotNull("t", "k").failing_rows(tables).count() == 2
    assert [r.n for r in CHECKS[3].failing_rows(tables).collect()] == [2]


def test_failing_values(tables):
    got = value_failures([CHECKS[0], CHECKS[2], CHECKS[4]], tables).collect()
    assert {(r.test, r.value, r.rows) for r in got} == {
        ("unique", "a", 2), ("accepted_values", "z", 1), ("relationships", "z", 1)}
