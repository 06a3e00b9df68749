import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF
from shoplens.plans import attribution, customers, retention, revenue, staging


@pytest.fixture
def staged(raw):
    orders = raw(
        "raw_orders",
        {"order_id": "1", "customer_id": "a", "amount": 100, "discount": 10, "quantity": 2,
         "order_date": dt.datetime(2024, 1, 31, 10)},
        {"order_id": "2", "customer_id": "a", "amount": 50, "order_date": dt.datetime(2024, 3, 2)},
        {"order_id": "3", "customer_id": "a", "status": "pending", "amount": 999},
        {"order_id": "4", "customer_id": "b", "status": "returned", "product_id": "none"},
        {"order_id": "5", "customer_id": "b", "amount": 5, "discount": 5, "product_id": None,
         "order_date": dt.datetime(2024, 6, 30)},
        {"order_id": "6", "customer_id": "stranger", "order_date": dt.datetime(2024, 3, 9)},
    )
    people = raw(
        "raw_customers",
        {"customer_id": "a"}, {"customer_id": "b", "email": "b@x.org", "signup_date": AS_OF},
        {"customer_id": "c", "email": "c@x.org"},
    )
    visits = raw(
        "raw_sessions",
        {"session_id": "1", "customer_id": "a", "session_date": dt.date(2024, 2, 1),
         "channel": "social", "converted": True, "time_on_site": 30},
        {"session_id": "2", "customer_id": "a", "channel": "email", "time_on_site": 61},
        {"session_id": "10", "customer_id": "a", "channel": "direct"},
        {"session_id": "3", "customer_id": "c", "channel": "email"},
        {"session_id": "4", "customer_id": None, "channel": "email"},
        {"session_id": "5", "customer_id": "ghost", "channel": "social"},
    )
    return (
        staging.stg_orders(orders), staging.stg_customers(people, AS_OF),
        staging.stg_products(raw("raw_products", {})), staging.stg_sessions(visits),
    )


@pytest.fixture
def customer_360(staged):
    orders, people, _, visits = staged
    return customers.customer_360(people, orders, visits, AS_OF)


def test_customer_360(customer_360):
    got = {r.customer_id: r for r in customer_360.collect()}
    assert set(got) == {"a", "b", "c"}
    a, b, c = got["a"], got["b"], got["c"]
    assert (a.total_orders, a.total_net_revenue, a.avg_order_value) == (2, Decimal("140.00"), 70.0)
    assert (a.total_discounts, a.active_months, a.customer_lifespan_days) == (Decimal("10.00"), 2, 31)
    assert (a.days_since_last_order, a.churn_risk, a.recency_score) == (121, "Medium Risk", 2)
    assert (a.total_sessions, a.session_conversion_rate) == (3, 33.33)
    assert a.annualized_revenue == round(140 / 182 * 365, 2)
    assert (b.recency_score, b.frequency_score, b.annualized_revenue) == (5, 1, None)
    assert (b.total_sessions, b.avg_time_on_site_secs) == (0, 0.0)
    assert (c.total_orders, c.total_net_revenue, c.last_order_date) == (0, Decimal("0.00"), None)
    assert (c.days_since_last_order, c.churn_risk, c.recency_score) == (9999, "High Risk", 1)


def test_score_bounds(spark):
    def scores(f, values):
        df = spark.createDataFrame([(v,) for v in values], "x int")
        return [r[0] for r in df.select(f(F.col("x"))).collect()]

    days = [30, 31, 60, 61, 90, 91, 180, 181]
    assert scores(customers.recency_score, days) == [5, 4, 4, 3, 3, 2, 2, 1]
    assert scores(customers.frequency_score, [20, 19, 10, 9, 5, 4, 2, 1]) == [5, 4, 4, 3, 3, 2, 2, 1]
    assert scores(customers.monetary_score, [2000, 1999, 1000, 999, 500, 499, 200, 199]) == [
        5, 4, 4, 3, 3, 2, 2, 1]
    assert scores(customers.churn_risk, [181, 180, 91, 90]) == [
        "High Risk", "Medium Risk", "Medium Risk", "Low Risk"]


def test_lookup(customer_360):
    assert customers.customer_lookup(customer_360, "a", "New").count() == 1
    assert customers.customer_lookup(customer_360, "a", "Vip").count() == 0


def test_revenue(staged, customer_360):
    orders, _, products, _ = staged
    enriched = revenue.order_enriched(orders, products, customer_360)
    profit = {r.order_id: r.order_profit for r in enriched.collect()}
    assert profit["1"] == Decimal("82.00")
    assert (profit["4"], profit["5"]) == (None, None)

    daily = revenue.revenue_daily(enriched)
    assert daily.agg(F.sum("total_orders")).first()[0] == orders.count()
    by_key = {(r.revenue_date, r.category): r for r in daily.collect()}
    unmatched = by_key[dt.date(2024, 1, 10), None]
    assert (unmatched.completed_orders, unmatched.gross_revenue, unmatched.units_sold) == (0, None, None)
    free = by_key[dt.date(2024, 6, 30), None]
    assert (free.net_revenue, free.profit_margin_pct) == (Decimal("0.00"), None)

    monthly = {(r.order_month, r.category): r for r in revenue.revenue_monthly(enriched).collect()}
    march = monthly[dt.date(2024, 3, 1), "Office"]
    assert (march.total_orders, march.net_revenue, march.avg_order_value) == (2, Decimal("60.00"), 30.0)
    assert march.profit_margin_pct == round(52 / 60 * 100, 2)
    recent = revenue.dashboard_month_category(daily, dt.date(2024, 3, 1)).collect()
    assert {(r.order_month.month, r.category): r.net_revenue for r in recent} == {
        (3, "Office"): Decimal("60.00"), (6, None): Decimal("0.00")}


def test_channel_daily(staged):
    rows = {(r.session_date, r.channel): r for r in attribution.channel_daily(staged[3]).collect()}
    email = rows[dt.date(2024, 1, 1), "email"]
    assert (email.total_sessions, email.unique_visitors, email.conversions) == (3, 2, 0)
    assert (email.avg_time_on_site_mins, email.conversion_rate_pct) == (1.0, 0.0)
    assert rows[dt.date(2024, 2, 1), "social"].conversion_rate_pct == 100.0


def test_attribution_by_any_and_by_first_touch(staged, customer_360):
    visits = staged[3]
    everything = attribution.channel_attribution_any_touch(visits, customer_360)
    first = attribution.channel_attribution_first_touch(visits, customer_360)

    def credit(df):
        return {r.first_touch_channel: (r.acquired_customers, r.total_attributed_revenue)
                for r in df.collect()}

    assert credit(everything) == {
        "email": (2, Decimal("140.00")), "direct": (1, Decimal("140.00")),
        "social": (2, Decimal("140.00")),
    }
    # a's first day has sessions 10 and 2: the lower id as text wins
    assert credit(first) == {
        "direct": (1, Decimal("140.00")), "email": (1, Decimal("0.00")), "social": (1, None)}
    ltv = {r.first_touch_channel: r.avg_customer_ltv for r in everything.collect()}
    assert ltv == {"email": 70.0, "direct": 140.0, "social": 140.0}


def test_cohorts(staged, raw):
    orders = staged[0]
    cohorts = {r.customer_id: r.cohort_month for r in retention.customer_cohorts(orders).collect()}
    assert cohorts == {
        "a": dt.datetime(2024, 1, 1), "b": dt.datetime(2024, 6, 1),
        "stranger": dt.datetime(2024, 3, 1),
    }
    rows = [tuple(r) for r in retention.cohort_retention(orders).collect()]
    assert rows == [
        (dt.datetime(2024, 1, 1), 0, 1, 1, 100.0), (dt.datetime(2024, 1, 1), 2, 1, 1, 100.0),
        (dt.datetime(2024, 3, 1), 0, 1, 1, 100.0), (dt.datetime(2024, 6, 1), 0, 1, 1, 100.0),
    ]
