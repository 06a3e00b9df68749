import datetime as dt
from decimal import Decimal

import pytest

from conftest import AS_OF
from shoplens.plans import staging


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_orders_without_id_customer_or_amount_are_dropped(raw):
    got = by(
        staging.stg_orders(
            raw(
                "raw_orders",
                {"order_id": None}, {"order_id": "1", "customer_id": None},
                {"order_id": "2", "amount": 0}, {"order_id": "3", "amount": None},
                {"order_id": "4", "amount": "0.01"}, {"order_id": "5", "amount": -1},
            )
        ),
        "order_id",
    )
    assert set(got) == {"4"}


def test_order_columns(raw):
    got = by(
        staging.stg_orders(
            raw(
                "raw_orders",
                {"order_id": "a", "status": "  COMPLETED ", "amount": "20.005", "discount": "0.5",
                 "shipping_cost": "2.25", "order_date": dt.datetime(2024, 7, 14, 23, 59)},
                {"order_id": "b", "status": None, "discount": None},
                {"order_id": "c", "shipping_cost": None, "status": "Returned"},
                {"order_id": "d", "order_date": None},
            )
        ),
        "order_id",
    )
    a = got["a"]
    assert (a.order_month, a.order_week) == (dt.date(2024, 7, 1), dt.date(2024, 7, 8))
    assert (a.order_day_of_week, a.status, a.is_completed) == (0, "completed", True)
    assert (a.gross_amount, a.net_amount) == (Decimal("20.01"), Decimal("19.51"))
    assert a.total_amount == Decimal("21.76")
    assert (got["b"].is_completed, got["b"].net_amount, got["b"].total_amount) == (False, None, None)
    assert (got["c"].net_amount, got["c"].total_amount) == (Decimal("10.00"), None)
    assert (got["d"].order_date, got["d"].order_month) == (None, None)


def test_customers(raw):
    got = by(
        staging.stg_customers(
            raw(
                "raw_customers",
                {"customer_id": "a", "first_name": " mary-ann", "email": " A@X.Org ",
                 "segment": "AT-RISK", "signup_date": dt.date(2024, 5, 31)},
                {"customer_id": "b", "last_name": None},
                {"customer_id": "c", "email": None},
                {"customer_id": None},
                {"customer_id": "d", "signup_date": None},
            ),
            AS_OF,
        ),
        "customer_id",
    )
    assert set(got) == {"a", "b", "d"}
    a = got["a"]
    assert (a.full_name, a.email, a.customer_segment) == ("Mary-Ann Lee", "a@x.org", "At-Risk")
    assert (a.days_since_signup, a.months_since_signup) == (31, 2)
    assert got["b"].full_name is None
    assert got["d"].days_since_signup is None


@pytest.mark.parametrize(
    "price, tier",
    [("24.99", "Budget"), ("24.9999", "Budget"), ("25", "Mid-Range"), ("74.99", "Mid-Range"),
     ("75", "Premium"), ("149.99", "Premium"), ("150", "Luxury")],
)
def test_price_tiers(raw, price, tier):
    row = staging.stg_products(raw("raw_products", {"unit_price": price})).first()
    assert row.price_tier == tier


def test_products(raw):
    df = raw(
        "raw_products",
        {"product_id": "a", "product_name": " Pen ", "category": "BOOKS", "sub_category": "non-fiction",
         "unit_price": 30, "cost_price": 20},
        {"product_id": "b", "unit_price": 0}, {"product_id": None}, {"product_id": "c", "unit_price": None},
        {"product_id": "d", "cost_price": None},
    )
    got = by(staging.stg_products(df), "product_id")
    assert set(got) == {"a", "d"}
    a = got["a"]
    assert (a.product_name, a.category, a.sub_category) == ("Pen", "Books", "Non-Fiction")
    assert (a.gross_margin_amount, a.gross_margin_pct) == (Decimal("10.00"), 33.33)
    assert got["d"].gross_margin_pct is None


def test_sessions(raw):
    df = raw(
        "raw_sessions",
        {"session_id": "a", "channel": " Organic_Search", "pages_visited": 1, "time_on_site": 9},
        {"session_id": "b", "channel": "DIRECT", "pages_visited": 1, "time_on_site": 10},
        {"session_id": "c", "channel": "paid_search", "pages_visited": 1, "time_on_site": None},
        {"session_id": "d", "channel": "social", "pages_visited": 2, "time_on_site": 3},
        {"session_id": "e", "channel": None, "customer_id": None, "time_on_site": 63},
        {"session_id": "f", "channel": "email"}, {"session_id": "g", "channel": "affiliate"},
        {"session_id": None},
    )
    got = by(staging.stg_sessions(df), "session_id")
    assert {k: r.channel_group for k, r in got.items()} == {
        "a": "Organic", "b": "Organic", "c": "Paid", "d": "Paid", "e": "Referral", "f": "Owned",
        "g": "Referral",
    }
    assert [k for k, r in got.items() if r.is_bounce] == ["a"]
    assert not any(r.is_bounce is None for r in got.values())
    assert (got["e"].time_on_site_mins, got["e"].customer_id) == (1.1, None)
