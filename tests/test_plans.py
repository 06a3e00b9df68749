"""Shapes of the physical plans that the design relies on."""

import pytest

import __spark_entry__ as spark_entry

FOLDER = "/root/testdata/sf0.001"
# runs jobs while it is built, and reads back a table
WRITES = "orders_incremental_merged"


@pytest.fixture(scope="module")
def plans(spark):
    """Plans without broadcasts, as at a scale where no side is small."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    found = {}
    for query, build in spark_entry.queries().items():
        if query in spark_entry.MODELS and query != WRITES:
            df = build(spark, FOLDER)
            found[query] = df._jdf.queryExecution().executedPlan().toString()
    spark.conf.set(name, before)
    return found


def test_no_plan_leaves_the_jvm_or_pairs_rows_without_a_key(plans):
    unwanted = ("Python", "Pandas", "CartesianProduct", "NestedLoopJoin", "MapPartitions")
    assert not [(q, w) for q, plan in plans.items() for w in unwanted if w in plan]


def test_staging_does_not_shuffle_what_it_reads(plans):
    assert "Exchange" not in plans["stg_products"] + plans["stg_sessions"]


def test_retention_reads_orders_once_and_joins_nothing(plans):
    plan = plans["cohort_retention"]
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_unused_tables_are_not_read(plans):
    assert "events.parquet" not in plans["mart_revenue"]
    assert "lineitem.parquet" not in plans["mart_customer_360"]
    for name in ("channel_attribution_any_touch", "channel_attribution_first_touch"):
        assert "lineitem.parquet" not in plans[name]


def test_counting_customers_per_channel_shuffles_channels_only(plans):
    for name in ("channel_attribution_any_touch", "channel_attribution_first_touch"):
        after_join = plans[name].split("SortMergeJoin")[0]
        assert after_join.count("Exchange") == 1


def test_customer_360_joins_on_one_partitioning(plans):
    joins = [line for line in plans["mart_customer_360"].splitlines() if "SortMergeJoin [customer_id" in line]
    assert len(joins) == 2
    between = plans["mart_customer_360"].split("SortMergeJoin [customer_id")[1]
    assert "Exchange" not in between


def test_the_mark_reaches_the_scan(plans):
    assert "GreaterThan(o_orderdate,ScalarSubquery" in plans["orders_incremental_batch"]


def test_only_used_columns_are_read(plans):
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plans["order_enriched"]
    assert "o_orderpriority" not in plans["order_enriched"]
