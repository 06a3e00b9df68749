"""A third of all rows on one key: results stay whole and the work is cut up."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF
from shoplens.operators.layout import Layout
from shoplens.plans import attribution, customers, retention, revenue, staging

ROWS = 60_000


@pytest.fixture
def small_threshold(spark):
    """Thresholds at which the few rows of a test count as skewed, and no broadcast."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "20000",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8",
    }
    before = {k: spark.conf.get(k) for k in conf if spark.conf.get(k, None) is not None}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k in conf:
        spark.conf.set(k, before[k]) if k in before else spark.conf.unset(k)


@pytest.fixture
def orders(spark):
    """Orders where one customer, one product and the missing product hold a third each."""
    i = F.col("id")
    raw = spark.range(0, ROWS, 1, 8).select(
        i.cast("string").alias("order_id"),
        F.when(i % 3 == 0, "hot").otherwise((i % 500).cast("string")).alias("customer_id"),
        F.timestamp_add("DAY", (i % 700).cast("int"), F.lit("2022-01-01").cast("timestamp_ntz"))
        .alias("order_date"),
        F.lit("completed").alias("status"),
        (i % 97 + 1).cast("decimal(18,4)").alias("amount"),
        F.lit(1).cast("decimal(18,4)").alias("discount"),
        F.lit(2).cast("decimal(18,4)").alias("shipping_cost"),
        F.when(i % 3 == 1, "hot").when(i % 3 == 2, (i % 40).cast("string")).alias("product_id"),
        F.lit(1).alias("quantity"),
    )
    return staging.stg_orders(raw)


@pytest.fixture
def products(spark, raw):
    rows = [{"product_id": str(i)} for i in range(40)] + [{"product_id": "hot"}]
    return staging.stg_products(raw("raw_products", *rows))


@pytest.fixture
def people(spark, raw):
    rows = [{"customer_id": str(i), "email": f"{i}@x.org"} for i in range(500)]
    rows.append({"customer_id": "hot", "email": "h@x.org"})
    return staging.stg_customers(raw("raw_customers", *rows), AS_OF)


def executed(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_hot_products_and_customers_are_cut_up(small_threshold, orders, products, people):
    people = people.withColumn("churn_risk", F.lit("x"))
    enriched = revenue.order_enriched(orders, products, people)
    rows, plan = executed(enriched)
    assert len(rows) == ROWS
    assert plan.count("SortMergeJoin(skew=true)") == 2
    summary, plan = executed(revenue.revenue_monthly(enriched))
    assert sum(r.total_orders for r in summary) == ROWS
    assert "SortMergeJoin(skew=true)" in plan


def test_hot_keys_show_among_thousands_of_partitions(spark, small_threshold, orders, products):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "2500")
    counted = orders.join(products.select("product_id", "category"), "product_id", "left")
    rows, plan = executed(counted.groupBy("category").agg(F.count("*"), F.max("order_id")))
    assert sum(r[1] for r in rows) == ROWS
    assert "SortMergeJoin(skew=true)" in plan


def test_a_hot_customer_is_one_row_per_month_before_it_is_grouped(small_threshold, orders):
    rows, plan = executed(customers.customer_orders(orders, AS_OF))
    hot = next(r for r in rows if r.customer_id == "hot")
    assert (hot.total_orders, hot.active_months) == (ROWS // 3, 24)
    assert "hashpartitioning(customer_id" in plan
    grid, _ = executed(retention.cohort_retention(orders))
    assert sum(r.active_customers for r in grid if r.months_since_cohort == 0) == 501


def test_sessions_without_customer(spark, small_threshold, people, orders):
    i = F.col("id")
    raw_sessions = spark.range(0, ROWS, 1, 8).select(
        i.cast("string").alias("session_id"),
        F.when(i % 3 > 0, (i % 500).cast("string")).alias("customer_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (i % 30).cast("int")).alias("session_date"),
        F.when(i % 3 == 0, "email").otherwise("social").alias("channel"),
        F.lit(1).alias("pages_visited"), F.lit(6).alias("time_on_site"),
        F.lit(True).alias("converted"),
    )
    sessions = staging.stg_sessions(raw_sessions)
    mart = customers.customer_360(people, orders, sessions, AS_OF)
    credit = {r.first_touch_channel: r.acquired_customers
              for r in attribution.channel_attribution_any_touch(sessions, mart).collect()}
    assert credit == {"email": 0, "social": 500}
    daily = attribution.channel_daily(sessions).agg(F.sum("total_sessions"), F.sum("bounces"))
    assert tuple(daily.first()) == (ROWS, ROWS)


def test_a_hot_partition_is_written_by_several_tasks(spark, small_threshold, orders, tmp_path):
    path = str(tmp_path / "t")
    hot = orders.withColumn("order_month", F.when(F.col("customer_id") == "hot", F.lit("m"))
                            .otherwise(F.col("order_month").cast("string")))
    Layout(partition_by=("order_month",), cluster_by=("status",)).replace(hot, path)
    assert len(list(Path(path, "order_month=m").glob("*.parquet"))) > 2
    assert spark.read.parquet(path).count() == ROWS


def test_ranges_end_in_the_key_that_is_looked_up(spark, small_threshold, orders, tmp_path):
    path = str(tmp_path / "t")
    Layout(cluster_by=("status",), locate_by=("order_id",)).replace(orders, path)
    per_file = (
        spark.read.parquet(path).groupBy(F.input_file_name().alias("f"))
        .agg(F.min("order_id").alias("lo"), F.max("order_id").alias("hi")).orderBy("lo").collect()
    )
    assert len(per_file) > 2
    assert all(a.hi < b.lo for a, b in zip(per_file, per_file[1:]))
