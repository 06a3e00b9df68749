"""The checks declared for the staging tables and marts."""

from __future__ import annotations

from shoplens.operators.quality import AcceptedValues, Check, Holds, NotNull, Relationship, Unique
from shoplens.plans.attribution import CREDIT_KEYS
from shoplens.plans.revenue import DAILY_KEYS

# fixed values: the accepted values
STATUSES = ("completed", "returned", "cancelled", "pending")
SEGMENTS = ("Vip", "Regular", "New", "At-Risk", "Churned")
CHURN_RISKS = ("High Risk", "Medium Risk", "Low Risk")

UNIQUE = [
    Unique("stg_orders", "order_id"),
    Unique("stg_customers", "customer_id"),
    Unique("stg_customers", "email"),
    Unique("stg_products", "product_id"),
    Unique("mart_customer_360", "customer_id"),
    Unique("mart_channel_attribution", "first_touch_channel"),
]
NOT_NULL = [
    NotNull("stg_orders", "order_id"),
    NotNull("stg_orders", "customer_id"),
    NotNull("stg_orders", "gross_amount"),
    NotNull("stg_orders", "net_amount"),
    NotNull("stg_customers", "customer_id"),
    NotNull("stg_customers", "email"),
    NotNull("stg_products", "product_id"),
    NotNull("mart_customer_360", "customer_id"),
    NotNull("mart_customer_360", "recency_score"),
    NotNull("mart_revenue", "revenue_date"),
    NotNull("mart_revenue", "gross_revenue"),
    NotNull("mart_channel_attribution", "first_touch_channel"),
]
# fixed values: the columns that tell the rows of a table apart
ROW_KEYS = {
    "stg_orders": ("order_id",), "stg_customers": ("customer_id",),
    "stg_products": ("product_id",), "mart_customer_360": ("customer_id",),
    "mart_revenue": DAILY_KEYS, "mart_channel_attribution": CREDIT_KEYS,
}
ACCEPTED_VALUES = [
    AcceptedValues("stg_orders", "status", values=STATUSES),
    AcceptedValues("stg_customers", "customer_segment", values=SEGMENTS),
    AcceptedValues("mart_customer_360", "churn_risk", values=CHURN_RISKS),
]
RELATIONSHIPS = [
    Relationship("stg_orders", "customer_id", parent="stg_customers", parent_column="customer_id"),
]
NET_WITHIN_GROSS = Holds(
    "stg_orders", "net_amount", "net_le_gross", "net_amount <= gross_amount"
)
DECLARED: list[Check] = [
    *UNIQUE, *NOT_NULL, *ACCEPTED_VALUES, *RELATIONSHIPS, NET_WITHIN_GROSS,
]

# keys that orders are joined on
JOIN_KEYS = [Unique("stg_products", "product_id"), Unique("stg_customers", "customer_id")]

# keys of the two models that no declared check looks at
KEYS_OF_OTHERS: list[Check] = [
    Unique("stg_sessions", "session_id"),
    NotNull("stg_sessions", "session_id"),
    Unique("mart_orders_incremental", "order_id"),
    NotNull("mart_orders_incremental", "order_id"),
]
