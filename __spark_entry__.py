"""Every query of the library over the test tables, and the SQL that checks it."""

from __future__ import annotations

import datetime as dt
import importlib.util
import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType

sys.path.insert(0, str(Path(__file__).resolve().parent))

import expected_sql
from shoplens.functions import cents_to_dollars, safe_divide
from shoplens.operators.calendar import calendar_between
from shoplens.operators.layout import UPDATED_AT
from shoplens.operators.quality import (
    AcceptedValues,
    Holds,
    Relationship,
    Unique,
    missing_values,
    report,
    union_all,
    value_failures,
)
from shoplens.operators.upsert import upsert_table
from shoplens.plans import attribution, checks, customers, orders, retention, revenue
from shoplens.plans.activity import CustomerActivity
from shoplens.plans.build import CUSTOMER_LAYOUT, Models, register_views
from shoplens.plans.customer_state import CustomerState
from shoplens.plans.maintained import (
    CUSTOMER_COLUMNS,
    MONTH,
    ORDER_COLUMNS,
    MaintainedRevenue,
)
from shoplens.plans.revenue import PRODUCT_COLUMNS
from shoplens.plans.visitors import PERIODS, ChannelVisitors
from shoplens.session import scratch_path
from shoplens.sources import LOADED_AT, load_raw, read_table
from shoplens.sources.compaction import compact
from shoplens.sources.quarantine import load_csv
from shoplens.sources.shop_tables import ShopTables
from shoplens.streaming.order_feed import latest_versions

FLAGSHIP_DIR = "/root/testdata/sf0.001"
AS_OF = dt.date.fromisoformat(expected_sql.AS_OF)
FIRST_LOAD_BEFORE = dt.datetime.fromisoformat(expected_sql.FIRST_LOAD_BEFORE)
LOOKBACK = dt.timedelta(days=31)
LAST_MONTH = dt.datetime.fromisoformat(expected_sql.LAST_MONTH)
DASHBOARD_SINCE = dt.date.fromisoformat(expected_sql.DASHBOARD_SINCE)


def _models(spark: SparkSession, folder: str) -> Models:
    return Models(ShopTables(spark, folder), AS_OF)


def _model(name: str) -> Callable[[Models], DataFrame]:
    return lambda m: getattr(m, name)


class _Tables(dict):
    """Models and raw tables by name, planned when a check asks for them."""

    def __init__(self, models: Models) -> None:
        self.models = models

    def __missing__(self, name: str) -> DataFrame:
        raw = self.models.raw
        if name == "mart_orders_incremental":
            return _orders_full(self.models)
        if name == "lineitem":
            key = F.concat_ws("-", "l_orderkey", "l_linenumber")
            return raw.read(name).withColumn("line_key", key)
        if name.startswith("raw_"):
            return getattr(raw, name.removeprefix("raw_"))
        return getattr(self.models, name)


def _orders_full(m: Models) -> DataFrame:
    return orders.orders_enriched(m.stg_orders, m.stg_products, m.stg_customers)


def _orders_batch(m: Models) -> DataFrame:
    stored = m.stg_orders.filter(F.col("order_date") < FIRST_LOAD_BEFORE)
    return orders.orders_increment(m.stg_orders, stored)


def _orders_merged(m: Models) -> DataFrame:
    """A first load that still sees its last month as pending, then an incremental run."""
    spark = m.stg_orders.sparkSession
    path = scratch_path(spark, "orders")
    early = m.stg_orders.filter(F.col("order_date") < FIRST_LOAD_BEFORE)
    open_ = F.col("order_date") > FIRST_LOAD_BEFORE - LOOKBACK
    early = early.withColumns(
        {
            "status": F.when(open_, "pending").otherwise(F.col("status")),
            "is_completed": F.col("is_completed") & ~open_,
        }
    )
    orders.update_orders(spark, path, early, m.stg_products, m.stg_customers)
    orders.update_orders(
        spark, path, m.stg_orders, m.stg_products, m.stg_customers, lookback=LOOKBACK
    )
    return read_table(spark, path).drop(orders.MART_LOADED_AT)


def _orders_evolved(m: Models) -> DataFrame:
    """A table that gains a column with one batch, loses one with the next, and a month again."""
    spark = m.stg_orders.sparkSession
    path = scratch_path(spark, "evolved")
    columns = ("order_id", "customer_id", "order_date", "order_month", "status", "net_amount")
    basket = F.when(F.col("quantity") > 3, "large").otherwise("small").alias("basket")
    month, date = F.col("order_month"), F.col("order_date")
    january = month == F.lit(FIRST_LOAD_BEFORE.date())
    again = F.concat("status", F.lit(", seen again"))
    for batch in (
        m.stg_orders.filter(date < FIRST_LOAD_BEFORE).select(*columns, "quantity"),
        m.stg_orders.filter(january).select(*columns, "quantity", basket),
        m.stg_orders.filter((date >= FIRST_LOAD_BEFORE) & ~january).select(*columns, basket),
        m.stg_orders.filter(january).withColumn("status", again).select(*columns, basket),
    ):
        upsert_table(
            spark, path, read_table(spark, path), batch, "order_id", orders.BY_MONTH
        )
    return read_table(spark, path)


def _orders_moved(m: Models) -> DataFrame:
    """A table in which a part of the orders lay in other months before they were put in again."""
    spark = m.stg_orders.sparkSession
    path = scratch_path(spark, "moved")
    enriched = _orders_full(m)
    moved = F.col("order_id").cast("bigint") % 50 == 0
    elsewhere = F.add_months("order_month", -(F.col("order_id").cast("bigint") % 7).cast("int"))
    first = enriched.withColumn(
        "order_month", F.when(moved, elsewhere).otherwise(F.col("order_month"))
    )
    for batch in (first, enriched.filter(moved)):
        upsert_table(
            spark, path, read_table(spark, path), batch, "order_id", orders.ORDERS_LAYOUT
        )
    return read_table(spark, path)


def _orders_by_any(m: Models) -> DataFrame:
    """Three lookups by one column each in a table that is laid out for all of them."""
    spark = m.stg_orders.sparkSession
    path = scratch_path(spark, "interleaved")
    orders.ORDERS_BY_ANY.replace(m.stg_orders, path)
    stored = spark.read.schema(m.stg_orders.schema).parquet(path)
    lookups = {
        "order_date": F.col("order_date") >= FIRST_LOAD_BEFORE,
        "customer_id": F.col("customer_id") == expected_sql.LOOKUP_CUSTOMER,
        "net_amount": F.col("net_amount") > 400,
    }
    return union_all(
        stored.filter(found).select(F.lit(name).alias("lookup"), "order_id", "net_amount")
        for name, found in lookups.items()
    )


def _staging_view(m: Models) -> DataFrame:
    """Staged orders by the name of their view, with the time of the run."""
    spark = m.stg_orders.sparkSession
    register_views(m, FIRST_LOAD_BEFORE)
    view = spark.sql("select * from stg_orders where is_completed")
    return view.withColumn(UPDATED_AT, F.col(UPDATED_AT).cast("timestamp_ntz"))


def _customer_360_stored(m: Models) -> DataFrame:
    """The mart in the ranges of its layout, looked up by segment and churn risk."""
    path = scratch_path(m.stg_orders.sparkSession, "customer_360")
    CUSTOMER_LAYOUT.replace(m.mart_customer_360, path)
    stored = read_table(m.stg_orders.sparkSession, path)
    return stored.filter("customer_segment in ('Vip', 'New') and churn_risk = 'High Risk'")


def _raw_compacted(m: Models) -> DataFrame:
    """Raw orders that came day by day in the last month, and in one go before it."""
    spark = m.raw.orders.sparkSession
    path = scratch_path(spark, "compacted")
    last = F.col("order_date") >= LAST_MONTH
    load_raw(m.raw.orders.filter(~last), "raw_orders", path, FIRST_LOAD_BEFORE)
    tenth = F.pmod(F.xxhash64("order_date"), F.lit(10))
    for k in range(10):
        some = m.raw.orders.filter(last & (tenth == k))
        load_raw(some, "raw_orders", path, FIRST_LOAD_BEFORE, append=True)
    compact(spark, path, "order_date")
    return spark.read.parquet(path).drop(LOADED_AT)


def _csv_rejects(m: Models) -> DataFrame:
    """Products written as CSV, some lines of which are spoilt, and loaded again."""
    spark = m.raw.products.sparkSession
    path, raw, rejected = (scratch_path(spark, name) for name in ("csv", "raw", "rejected"))
    number = F.col("product_id").cast("bigint")
    price = F.when(number % 50 == 0, "unknown").otherwise(F.lit("25.5"))
    more = F.when(number % 61 == 0, ",left over").otherwise(F.lit(""))
    line = F.concat("product_id", F.lit(",pen,office,pens,"), price, F.lit(",1.5"), more)
    header = F.lit("product_id,product_name,category,sub_category,unit_price,cost_price")
    named = m.raw.products.filter(number.isNotNull()).select(line.alias("line"))
    # every file has its header first
    head = spark.range(4).select(F.lit(0).alias("nth"), F.col("id").cast("int").alias("file"), header.alias("line"))
    rows = named.select(
        F.lit(1).alias("nth"), F.pmod(F.xxhash64("line"), F.lit(4)).cast("int").alias("file"), "line"
    )
    files = head.unionAll(rows).repartition(4, "file").sortWithinPartitions("file", "nth")
    files.select("line", "file").write.partitionBy("file").text(path)
    load_csv(
        spark, f"{path}/*", "raw_products", raw, rejected, most_bad=0.05, run_ts=FIRST_LOAD_BEFORE
    )
    good = spark.read.parquet(raw).select("product_id", "unit_price", F.lit(None).alias("reason"))
    lines = spark.read.parquet(rejected)
    bad = lines.select(
        F.split("_line", ",")[0].alias("product_id"), F.lit(None).alias("unit_price"),
        F.col("_reason").alias("reason"),
    )
    return good.unionAll(bad)


def _stored(df: DataFrame, label: str) -> DataFrame:
    """A table that is derived once and read from its files from then on."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _revenue_maintained(m: Models) -> DataFrame:
    """A mart made before late orders, other statuses, categories and segments, then updated.

    The staged tables are stored first: both updates read them several times.
    """
    spark = m.stg_orders.sparkSession
    kept = MaintainedRevenue(spark, scratch_path(spark, "maintained"))
    all_orders = _stored(m.stg_orders.select("order_id", MONTH, *ORDER_COLUMNS), "staged_orders")
    all_products = _stored(m.stg_products.select("product_id", *PRODUCT_COLUMNS), "staged_products")
    all_customers = _stored(
        m.stg_customers.select("customer_id", *CUSTOMER_COLUMNS), "staged_customers"
    )
    number = F.col("order_id").cast("bigint")
    late = (number % 11 == 0) & (F.col("order_month") >= F.lit(DASHBOARD_SINCE))
    open_ = (number % 13 == 0) & (F.col("order_month") == F.lit(FIRST_LOAD_BEFORE.date()))
    early = all_orders.filter(~late).withColumn("is_completed", F.col("is_completed") & ~open_)
    odd = F.col("product_id").cast("bigint") % 997 == 5
    products = all_products.withColumn(
        "category", F.when(odd, "Unsorted").otherwise(F.col("category"))
    )
    other = F.col("customer_id").cast("bigint") % 499 == 7
    customers = all_customers.withColumn(
        "customer_segment", F.when(other, "New").otherwise(F.col("customer_segment"))
    )
    kept.update(early, products, customers)
    kept.update(all_orders, all_products, all_customers)
    return kept.read()


def _thirds(df: DataFrame, key: str) -> list[DataFrame]:
    """The rows of a table in three batches."""
    third = F.pmod(F.xxhash64(key), F.lit(3))
    return [df.filter(third == k) for k in range(3)]


def _from_state(m: Models) -> DataFrame:
    """Customer 360 after three batches, of which the first two were added up."""
    spark = m.stg_orders.sparkSession
    state = CustomerState(spark, scratch_path(spark, "state"), most=1)
    batches = zip(_thirds(m.stg_orders, "order_id"), _thirds(m.stg_sessions, "session_id"))
    for k, (some_orders, some_sessions) in enumerate(batches):
        state.add(f"batch {k}", some_orders, some_sessions)
    return state.customer_360(m.stg_customers, AS_OF)


def _channel_visitors(m: Models) -> DataFrame:
    """Visitors of each day, week and month, from days stored in three batches."""
    spark = m.stg_sessions.sparkSession
    visitors = ChannelVisitors(spark, scratch_path(spark, "visitors"))
    for k, some in enumerate(_thirds(m.stg_sessions, "session_id")):
        visitors.add(str(k), some)
    return union_all(
        visitors.unique(period).select(F.lit(period).alias("period"), "*") for period in PERIODS
    )


def _retention_from_bits(m: Models) -> DataFrame:
    """Retention after three batches of orders."""
    spark = m.stg_orders.sparkSession
    active = CustomerActivity(spark, scratch_path(spark, "activity"))
    for k, some in enumerate(_thirds(m.stg_orders, "order_id")):
        active.add_orders(str(k), some)
    return active.retention()


def _dashboard(m: Models) -> DataFrame:
    """Over a mart computed from the orders that matter."""
    recent = revenue.orders_since(m.stg_orders, DASHBOARD_SINCE)
    enriched = revenue.order_enriched(recent, m.stg_products, m.mart_customer_360)
    return revenue.dashboard_month_category(revenue.revenue_daily(enriched), DASHBOARD_SINCE)


def _order_versions(m: Models) -> DataFrame:
    """The last of several versions of each order: tied, older and without a load time."""
    orders = m.raw.orders.filter("order_id is not null")
    key, placed = F.col("order_id").cast("bigint"), F.col("order_date")
    shifted = placed + F.make_dt_interval((key % 3 - 1).cast("int"))
    never = F.lit(None).cast("timestamp_ntz")
    versions = (
        orders.filter(key % 4 != 0).select("order_id", "status", placed, placed.alias(LOADED_AT))
        .unionAll(orders.select("order_id", F.lit("pending"), placed, shifted))
        .unionAll(orders.select("order_id", F.lit("cancelled"), placed, never))
    )
    return latest_versions(versions).select(
        "order_id", "status", F.col(LOADED_AT).alias("loaded_at"), F.col("_version").alias("digest")
    )


def _date_spine(m: Models) -> DataFrame:
    """The calendar from the first order to the last."""
    day = F.col("order_date").cast("date")
    return calendar_between(
        m.stg_orders.agg(
            F.min(day).alias("start_date"), F.date_add(F.max(day), 1).alias("end_date")
        )
    )


def _safe_divide(m: Models) -> DataFrame:
    ratio = safe_divide(F.col("net_amount").cast("double"), F.col("shipping_cost").cast("double"))
    return m.stg_orders.select("order_id", ratio.alias("net_per_shipping"))


def _cents_to_dollars(m: Models) -> DataFrame:
    cents = (F.col("o_totalprice").cast("decimal(18,2)") * 100).cast("bigint")
    return m.raw.read("orders").select("o_orderkey", cents_to_dollars(cents).alias("dollars"))


RAW_STATUS = AcceptedValues("raw_orders", "status", values=checks.STATUSES)
RAW_SEGMENT = AcceptedValues("raw_customers", "segment", values=checks.SEGMENTS)
LINE_KEY = Unique("lineitem", "line_key")
UNSOLD = Relationship(
    "stg_products", "product_id", parent="stg_orders", parent_column="product_id"
)
POSITIVE_NET = Holds("stg_orders", "net_amount", "net_positive", "net_amount > 0")

MODELS: dict[str, Callable[[Models], DataFrame]] = {
    "stg_orders": _model("stg_orders"),
    "stg_customers": _model("stg_customers"),
    "stg_products": _model("stg_products"),
    "stg_sessions": _model("stg_sessions"),
    "customer_orders": lambda m: customers.customer_orders(m.stg_orders, AS_OF),
    "customer_sessions": lambda m: customers.customer_sessions(m.stg_sessions),
    "mart_customer_360": _model("mart_customer_360"),
    "customer_lookup": lambda m: customers.customer_lookup(
        m.mart_customer_360, expected_sql.LOOKUP_CUSTOMER, "Vip"
    ),
    "order_enriched": _model("order_enriched"),
    "mart_revenue": _model("mart_revenue"),
    "revenue_monthly": lambda m: revenue.revenue_monthly(m.order_enriched),
    "dashboard_month_category": _dashboard,
    "channel_daily": lambda m: attribution.channel_daily(m.stg_sessions),
    "channel_touches": lambda m: attribution.channel_touches(m.stg_sessions),
    "channel_attribution_any_touch": _model("mart_channel_attribution"),
    "channel_attribution_first_touch": _model("mart_channel_first_touch"),
    "orders_incremental_full": _orders_full,
    "orders_incremental_batch": _orders_batch,
    "orders_incremental_merged": _orders_merged,
    "orders_schema_evolution": _orders_evolved,
    "orders_moved": _orders_moved,
    "orders_interleaved": _orders_by_any,
    "staging_view": _staging_view,
    "customer_360_stored": _customer_360_stored,
    "csv_quarantine": _csv_rejects,
    "raw_orders_compacted": _raw_compacted,
    "mart_revenue_maintained": _revenue_maintained,
    "customer_360_from_state": _from_state,
    "channel_visitors": _channel_visitors,
    "cohort_retention_from_bits": _retention_from_bits,
    "order_versions": _order_versions,
    "customer_cohorts": lambda m: retention.customer_cohorts(m.stg_orders),
    "cohort_sizes": lambda m: retention.cohort_sizes(retention.customer_cohorts(m.stg_orders)),
    "cohort_retention": lambda m: retention.cohort_retention(m.stg_orders),
    "date_spine": _date_spine,
    "safe_divide": _safe_divide,
    "cents_to_dollars": _cents_to_dollars,
    "dq_unique": lambda m: value_failures([*checks.UNIQUE, LINE_KEY], _Tables(m)),
    "dq_not_null": lambda m: missing_values(checks.NOT_NULL, _Tables(m), checks.ROW_KEYS),
    "dq_accepted_values": lambda m: value_failures(
        [*checks.ACCEPTED_VALUES, RAW_STATUS, RAW_SEGMENT], _Tables(m)
    ),
    "dq_relationships": lambda m: value_failures([*checks.RELATIONSHIPS, UNSOLD], _Tables(m)),
    "dq_net_le_gross": lambda m: checks.NET_WITHIN_GROSS.failing_rows(_Tables(m)),
    "dq_net_positive": lambda m: POSITIVE_NET.failing_rows(_Tables(m)),
    "dq_report": lambda m: report([*checks.DECLARED, *checks.KEYS_OF_OTHERS], _Tables(m)),
}


def _doubles(df: DataFrame) -> DataFrame:
    """Money as doubles, which compare alike in any engine."""
    return df.select(
        *[
            F.col(f.name).cast("double") if isinstance(f.dataType, DecimalType) else f.name
            for f in df.schema
        ]
    )


def _query(plan: Callable[[Models], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _doubles(plan(_models(spark, sf_dir)))


def entry(spark: SparkSession) -> DataFrame:
    """The customer 360 mart, which draws on every raw table but the products."""
    return queries()["mart_customer_360"](spark, FLAGSHIP_DIR)


def _present(module: str) -> bool:
    """Whether a part that a checkout may lack is there; errors inside it are not hidden."""
    return importlib.util.find_spec(module) is not None


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All queries by name."""
    found = {name: _query(plan) for name, plan in MODELS.items()}
    if _present("shoplens.llm"):
        from shoplens.llm.queries import QUERIES

        found |= QUERIES
    if _present("shoplens.llm") and _present("corpus_pipeline"):
        import corpus_pipeline

        found["pipeline"] = corpus_pipeline.run
    return found


def oracle_sql() -> dict[str, str]:
    """The same results in SQL."""
    found = expected_sql.all_sql()
    if _present("shoplens.llm"):
        from shoplens.llm.queries import ORACLES

        found |= ORACLES
    if _present("shoplens.llm") and _present("corpus_pipeline"):
        import corpus_pipeline

        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
