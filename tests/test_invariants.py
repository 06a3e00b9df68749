"""Relations between models that hold on any data."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from shoplens.plans import attribution
from shoplens.plans.build import Models
from shoplens.sources.shop_tables import ShopTables

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def models(spark):
    return Models(ShopTables(spark, FOLDER), spark_entry.AS_OF)


@pytest.fixture(scope="module")
def results(spark):
    return {
        name: spark_entry.queries()[name](spark, FOLDER)
        for name in ("mart_revenue", "revenue_monthly", "cohort_retention", "cohort_sizes",
                     "orders_incremental_full", "orders_incremental_merged")
    }


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def test_every_order_is_in_one_revenue_group(models, results):
    orders = models.stg_orders.count()
    for name in ("mart_revenue", "revenue_monthly"):
        assert results[name].agg(F.sum("total_orders")).first()[0] == orders


def test_joins_neither_add_nor_lose_rows(models):
    assert models.mart_customer_360.count() == models.stg_customers.count()
    assert models.order_enriched.count() == models.stg_orders.count()


def test_first_touch_credits_each_customer_once(models):
    sessions = models.stg_sessions
    visitors = sessions.filter("customer_id is not null").select("customer_id").distinct().count()
    first = attribution.first_touches(sessions)
    assert first.count() == visitors <= attribution.channel_touches(sessions).count()
    credited = models.mart_channel_first_touch.agg(F.sum("acquired_customers")).first()[0]
    assert credited == visitors


def test_a_cohort_is_whole_in_its_first_month(results):
    start = results["cohort_retention"].filter("months_since_cohort = 0")
    assert {(r.cohort_month, r.active_customers) for r in start.collect()} == {
        tuple(r) for r in results["cohort_sizes"].select("cohort_month", "cohort_size").collect()}
    assert start.filter("retention_rate <> 100 or active_customers <> cohort_size").isEmpty()


def test_increments_end_in_the_full_load(results):
    full = rows(results["orders_incremental_full"])
    assert rows(results["orders_incremental_merged"]) == full


@pytest.mark.parametrize("zone", ["America/Sao_Paulo", "Asia/Kolkata"])
def test_results_do_not_depend_on_the_session_time_zone(spark, results, zone):
    names = ("mart_revenue", "cohort_retention")
    expected = {name: rows(results[name]) for name in names}
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert {n: rows(spark_entry.queries()[n](spark, FOLDER)) for n in names} == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
