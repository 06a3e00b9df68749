import datetime as dt
import random
from collections import Counter

import pytest

from conftest import AS_OF
from shoplens.plans import activity, attribution, customers, retention, staging
from shoplens.plans.customer_state import CustomerState
from shoplens.plans.visitors import ChannelVisitors


@pytest.fixture
def shop(raw):
    rng = random.Random(8)
    people = [f"c{k}" for k in range(40)]
    orders = [
        {
            "order_id": str(k),
            # a third of the orders are one customer's
            "customer_id": "c0" if k % 3 == 0 else rng.choice(people),
            "order_date": None if k % 41 == 0 else
            dt.datetime(rng.choice([1969, 1995, 2023, 2024]), rng.randrange(1, 13), 3, k % 24),
            "status": rng.choice(["completed", "completed", "returned", None]),
            "amount": f"{rng.randrange(1, 9000) / 100}", "discount": rng.choice([None, "1.25", "0"]),
        }
        for k in range(300)
    ]
    sessions = [
        {
            "session_id": str(k), "customer_id": rng.choice([None, "c0", *people]),
            "session_date": dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(45)),
            "channel": rng.choice(["email", "direct", None]), "converted": rng.random() < 0.2,
            "pages_visited": rng.choice([None, 1, 4]), "time_on_site": rng.choice([None, 5, 90]),
        }
        for k in range(300)
    ]
    people = [{"customer_id": c, "email": f"{c}@x.org"} for c in [*people, "silent"]]
    return (
        staging.stg_customers(raw("raw_customers", *people), AS_OF),
        lambda part=slice(None): staging.stg_orders(raw("raw_orders", *orders[part])),
        lambda part=slice(None): staging.stg_sessions(raw("raw_sessions", *sessions[part])),
    )


PARTS = [slice(0, 120), slice(120, 130), slice(130, 300)]


def same(got, want):
    assert got.columns == want.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


@pytest.mark.parametrize("most", [1, 16])
def test_customer_360_from_batches(spark, shop, tmp_path, most):
    people, orders, sessions = shop
    state = CustomerState(spark, str(tmp_path), most)
    for k, part in enumerate([*PARTS, PARTS[0]]):
        # the last one is the first again
        state.add(str(k % 3), orders(part), sessions(part))
    for day in (AS_OF, dt.date(2025, 5, 5)):
        same(state.customer_360(people, day), customers.customer_360(people, orders(), sessions(), day))


def test_customer_360_of_an_empty_state(spark, shop, tmp_path):
    people, orders, sessions = shop
    state = CustomerState(spark, str(tmp_path))
    same(
        state.customer_360(people, AS_OF),
        customers.customer_360(people, orders().limit(0), sessions().limit(0), AS_OF),
    )


def test_retention_from_batches(spark, shop, tmp_path):
    _, orders, _ = shop
    active = activity.CustomerActivity(spark, str(tmp_path), most=2)
    for k, part in enumerate([*PARTS, PARTS[1]]):
        active.add_orders(str(k), orders(part))
    same(active.retention(), retention.cohort_retention(orders()))


def test_visitors_of_days_weeks_and_months(spark, shop, tmp_path):
    _, _, sessions = shop
    stored = ChannelVisitors(spark, str(tmp_path), most=2)
    for k, part in enumerate([*PARTS, PARTS[0]]):
        stored.add(str(k), sessions(part))
    rows = [
        (r.session_date, r.channel, r.channel_group, r.customer_id) for r in sessions().collect()
    ]
    starts = {
        "day": lambda d: d, "week": lambda d: d - dt.timedelta(days=d.weekday()),
        "month": lambda d: d.replace(day=1),
    }
    for period, start in starts.items():
        seen = {}
        for day, channel, group, who in rows:
            seen.setdefault((start(day), channel, group), set()).add(who)
        got = {tuple(r)[:3]: r.unique_visitors for r in stored.unique(period).collect()}
        assert got == {k: len(v - {None}) for k, v in seen.items()}
    daily = attribution.channel_daily(sessions())
    assert sum(r.unique_visitors for r in stored.unique("day").collect()) == sum(
        r.unique_visitors for r in daily.collect()
    )
    with pytest.raises(ValueError, match="fortnight"):
        stored.unique("fortnight")
