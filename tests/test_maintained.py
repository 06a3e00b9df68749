import datetime as dt
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF
from shoplens.plans import staging
from shoplens.plans.maintained import MaintainedRevenue

DAY = dt.datetime(2024, 1, 10)


def order(order_id, month, product="p", customer="c", **rest):
    return {"order_id": order_id, "order_date": dt.datetime(2024, month, 10), "product_id": product,
            "customer_id": customer, **rest}


ORDERS = [
    order("1", 1), order("2", 2), order("3", 2, "q"), order("4", 3, "q", "d"), order("5", 4, None),
    order("6", 5, "p", "unknown"),
]


@pytest.fixture
def mart(spark, raw, tmp_path):
    path = str(tmp_path / "mart")
    kept = MaintainedRevenue(spark, path)

    def update(rows, category="office", segment="new", feed=None, dropped=()):
        def staged(some):
            return staging.stg_orders(raw("raw_orders", *some))

        products = [{"product_id": "p"}, {"product_id": "q", "category": category}]
        people = [{"customer_id": "c"}, {"customer_id": "d", "segment": segment, "email": "d@x.org"}]
        tables = (
            staged(rows) if rows else staged(ORDERS).filter(F.lit(False)),
            staging.stg_products(raw("raw_products", *products)),
            staging.stg_customers(
                raw("raw_customers", *(p for p in people if p["customer_id"] not in dropped)), AS_OF
            ),
        )
        before = files(path)
        months = kept.update(*tables, changed_orders=None if feed is None else staged(feed))
        now = files(path)
        stayed = {m for m in before if before[m] == now.get(m)}
        want = kept._revenue(*tables)
        got = kept.read().select(*want.columns)
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
        return [m.month for m in months], sorted(int(m[-5:-3]) for m in stayed)

    return update


def files(path):
    return {
        p.name: sorted((f.name, f.stat().st_mtime_ns) for f in p.glob("*.parquet"))
        for p in Path(path).glob("order_month=*")
    }


def test_only_months_that_changed_are_computed(mart):
    assert mart(ORDERS)[0] == [1, 2, 3, 4, 5]
    assert mart(ORDERS) == ([], [1, 2, 3, 4, 5])
    late = [*ORDERS, order("7", 1)]
    assert mart(late) == ([1], [2, 3, 4, 5])
    returned = [*ORDERS[:1], order("2", 2, status="returned"), *ORDERS[2:], order("7", 1)]
    assert mart(returned) == ([2], [1, 3, 4, 5])
    # months with an order of the product
    assert mart(returned, category="toys") == ([2, 3], [1, 4, 5])
    assert mart(returned, category="toys", segment="vip") == ([3], [1, 2, 4, 5])
    assert mart(returned, category="toys", dropped=["d"]) == ([3], [1, 2, 4, 5])
    assert mart(returned, category="toys", dropped=["c", "d"]) == ([1, 2, 4], [3, 5])


def test_months_that_come_and_go(mart):
    mart(ORDERS)
    moved = [order("1", 6), *ORDERS[1:]]
    assert mart(moved) == ([1, 6], [2, 3, 4, 5])
    assert mart([]) == ([2, 3, 4, 5, 6], [])
    assert mart(ORDERS)[0] == [1, 2, 3, 4, 5]


def test_values_that_change_places_with_null(mart):
    first = [order("1", 1, discount=None, shipping_cost=2), order("2", 2)]
    mart(first)
    assert mart([order("1", 1, discount=2, shipping_cost=None), order("2", 2)]) == ([1], [2])


def test_a_feed_of_changes(mart):
    mart(ORDERS)
    now = [order("1", 2), *ORDERS[1:]]
    # the old and the new version of the order
    assert mart(now, feed=[order("1", 1), order("1", 2)]) == ([1, 2], [3, 4, 5])
    assert mart(now, category="toys", feed=ORDERS[-1:]) == ([2, 3, 5], [4])
    # what the feed said is known to a scan
    assert mart(now, category="toys") == ([], [2, 3, 4, 5])


def test_inputs_are_evaluated_a_few_times(spark, raw, tmp_path):
    """Rows that pass a filter, which counts them, by the number of rows: passes over a table."""
    kept = MaintainedRevenue(spark, str(tmp_path / "mart"))

    def passes(rows, category):
        staged = {
            "orders": staging.stg_orders(raw("raw_orders", *rows)),
            "products": staging.stg_products(
                raw("raw_products", {"product_id": "p"}, {"product_id": "q", "category": category})
            ),
            "customers": staging.stg_customers(
                raw("raw_customers", {"customer_id": "c"}, {"customer_id": "d"}), AS_OF
            ),
        }
        seen = {name: spark.sparkContext.accumulator(0) for name in staged}

        def counted(name):
            count = seen[name]

            @F.udf("boolean")
            def passed(_):
                count.add(1)
                return True

            df = staged[name]
            return df.filter(passed.asNondeterministic()(df.columns[0]))

        kept.update(*(counted(name) for name in staged))
        return {name: seen[name].value / df.count() for name, df in staged.items()}

    assert passes(ORDERS, "office") == {"orders": 2, "products": 2, "customers": 2}
    # digests of months, orders of the changed product, months to compute
    late = [*ORDERS, order("7", 1)]
    assert passes(late, "toys") == {"orders": 3, "products": 2, "customers": 2}
    assert passes(late, "toys") == {"orders": 1, "products": 1, "customers": 1}


def test_orders_without_a_month(spark, raw, tmp_path):
    kept = MaintainedRevenue(spark, str(tmp_path / "mart"))
    dateless = {"order_id": "8", "order_date": None, "product_id": "q", "customer_id": "c"}

    def update(rows, category="office", feed=None):
        tables = (
            staging.stg_orders(raw("raw_orders", *rows)),
            staging.stg_products(
                raw("raw_products", {"product_id": "p"}, {"product_id": "q", "category": category})
            ),
            staging.stg_customers(raw("raw_customers", {"customer_id": "c"}), AS_OF),
        )
        feed = None if feed is None else staging.stg_orders(raw("raw_orders", *feed))
        months = kept.update(*tables, changed_orders=feed)
        want = kept._revenue(*tables)
        got = kept.read().select(*want.columns)
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
        return [m and m.month for m in months]

    rows = [order("1", 1), order("2", 2), dateless]
    update(rows)
    late = [*rows, order("3", 1)]
    # of the product's orders, one has no month
    assert update(late, "toys", feed=late[-1:]) == [1, None]
    # a feed leaves the digest of other months as it was
    assert update(late, "toys") == []
    assert update(late[:2], "toys") == [1, None]
    assert update(late, "pens") == [1, None]
