"""Declared schemas of the raw tables."""

from __future__ import annotations

from pyspark.sql import types as T

from shoplens.functions.money import RAW_MONEY

LOADED_AT = "_loaded_at"


def _schema(*columns: tuple) -> T.StructType:
    """Fields from ``(name, type)``, or ``(name, length)`` for text of a limited length."""
    fields = []
    for name, kind in columns:
        if isinstance(kind, int):
            fields.append(T.StructField(name, T.StringType(), True, {"max_length": kind}))
        else:
            fields.append(T.StructField(name, kind, True))
    return T.StructType(fields)


# fixed values: names, types and text lengths of the raw tables
RAW_SCHEMAS = {
    "raw_orders": _schema(
        ("order_id", 36), ("customer_id", 36), ("order_date", T.TimestampNTZType()),
        ("status", 50), ("amount", RAW_MONEY), ("discount", RAW_MONEY),
        ("shipping_cost", RAW_MONEY), ("product_id", 36), ("quantity", T.IntegerType()),
    ),
    "raw_customers": _schema(
        ("customer_id", 36), ("first_name", 100), ("last_name", 100), ("email", 255),
        ("country", 100), ("signup_date", T.DateType()), ("segment", 50),
    ),
    "raw_products": _schema(
        ("product_id", 36), ("product_name", 255), ("category", 100), ("sub_category", 100),
        ("unit_price", RAW_MONEY), ("cost_price", RAW_MONEY),
    ),
    "raw_sessions": _schema(
        ("session_id", 36), ("customer_id", 36), ("session_date", T.DateType()),
        ("channel", 100), ("pages_visited", T.IntegerType()), ("time_on_site", T.IntegerType()),
        ("converted", T.BooleanType()),
    ),
}
