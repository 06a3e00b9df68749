import datetime as dt

import pytest

from shoplens.session import local_session
from shoplens.sources import RAW_SCHEMAS

AS_OF = dt.date(2024, 7, 1)


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "4g", **{"spark.sql.maxMetadataStringLength": "2000"})
    yield session
    session.stop()


@pytest.fixture
def raw(spark):
    """Raw tables from partial rows given as dicts; defaults fill the rest."""
    defaults = {
        "raw_orders": {
            "order_id": "o", "customer_id": "c", "order_date": dt.datetime(2024, 1, 10, 12),
            "status": "completed", "amount": 10, "discount": 0, "shipping_cost": 0,
            "product_id": "p", "quantity": 1,
        },
        "raw_customers": {
            "customer_id": "c", "first_name": "ann", "last_name": "lee", "email": "a@x.org",
            "country": "peru", "signup_date": dt.date(2024, 1, 1), "segment": "new",
        },
        "raw_products": {
            "product_id": "p", "product_name": "pen", "category": "office",
            "sub_category": "pens", "unit_price": 30, "cost_price": 4,
        },
        "raw_sessions": {
            "session_id": "s", "customer_id": "c", "session_date": dt.date(2024, 1, 1),
            "channel": "email", "pages_visited": 3, "time_on_site": 60, "converted": False,
        },
    }

    def make(table, *rows):
        schema = RAW_SCHEMAS[table]
        money = ("decimal", "double")
        numbers = {f.name for f in schema if f.dataType.simpleString().startswith(money)}
        loose = ", ".join(
            f"{f.name} {'string' if f.name in numbers else f.dataType.simpleString()}"
            for f in schema
        )
        values = []
        for row in rows:
            full = defaults[table] | row
            values.append(
                tuple(
                    str(full[f.name]) if f.name in numbers and full[f.name] is not None
                    else full[f.name]
                    for f in schema
                )
            )
        df = spark.createDataFrame(values, loose)
        return df.select(*[df[f.name].cast(f.dataType) for f in schema])

    return make
