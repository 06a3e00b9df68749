import datetime as dt
import re
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

import compare
import expected_sql
from shoplens.__main__ import main
from shoplens.plans.build import MARTS, StoredRaw, build_all, check_all, table_path
from shoplens.plans.catalog import publish
from shoplens.plans.customers import customer_lookup
from shoplens.plans.revenue import dashboard_month_category
from shoplens.sources import LOADED_AT, RAW_SCHEMAS, load_raw, read_csv, read_parquet, read_table
from shoplens.sources.shop_tables import ShopTables
from shoplens.streaming import follow_orders
from shoplens.streaming.order_feed import latest_versions

FOLDER = "/root/testdata/sf0.001"
AS_OF = dt.date(2001, 8, 2)
RUN = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("warehouse"))
    source = ShopTables(spark, FOLDER)
    for table in RAW_SCHEMAS:
        df = getattr(source, table.removeprefix("raw_"))
        load_raw(df, table, table_path(root, "raw", table), RUN)
    return root, build_all(spark, StoredRaw(spark, root), root, AS_OF, RUN)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_all_tables(spark, warehouse):
    root, built = warehouse
    sql, duck = expected_sql.all_sql(), compare.connect(FOLDER)
    names = {
        "mart_channel_attribution": "channel_attribution_any_touch",
        "mart_channel_first_touch": "channel_attribution_first_touch",
        "mart_orders_incremental": "orders_incremental_full",
    }
    for name, df in built.items():
        query = sql[names.get(name, name)]
        assert df.count() == duck.execute(f"select count(*) from ({query})").fetchall()[0][0], name
    stored = StoredRaw(spark, root).orders
    assert stored.columns == [*RAW_SCHEMAS["raw_orders"].names, LOADED_AT]
    assert built["mart_revenue"].agg(F.min("dbt_updated_at")).first()[0] == RUN
    assert spark.table("stg_orders").columns[-1] == "dbt_updated_at"


def test_declared_checks(warehouse):
    found = {(r.model, r.column_name, r.test): r.failures for r in check_all(warehouse[1]).collect()}
    rows = compare.connect(FOLDER).execute(expected_sql.all_sql()["dq_report"]).fetchall()
    assert found == {tuple(r[:3]): r[3] for r in rows}
    assert sum(n > 0 for n in found.values()) == 4


def test_dashboard_reads_only_recent_partitions_and_two_columns(warehouse):
    df = dashboard_month_category(warehouse[1]["mart_revenue"], dt.date(2001, 2, 1))
    plan = final_plan(df)
    assert "PartitionFilters: [isnotnull(order_month" in plan
    assert "ReadSchema: struct<category:string,net_revenue:decimal(28,2)>" in plan


def test_lookup_is_pushed_to_the_scan(warehouse):
    plan = final_plan(customer_lookup(warehouse[1]["mart_customer_360"], "59", "Vip"))
    assert "EqualTo(customer_id,59)" in plan and "EqualTo(customer_segment,Vip)" in plan


def test_building_again_changes_nothing(spark, warehouse):
    root, built = warehouse
    before = built["mart_orders_incremental"].collect()
    again = build_all(spark, StoredRaw(spark, root), root, AS_OF, RUN)
    assert sorted(again["mart_orders_incremental"].collect()) == sorted(before)


def test_only_selected_marts_are_written(spark, warehouse):
    root, built = warehouse

    def written(name):
        return {p.name for p in Path(table_path(root, "marts", name)).rglob("*.parquet")}

    before = {name: written(name) for name in MARTS}
    later = build_all(spark, StoredRaw(spark, root), root, AS_OF, RUN, select=["mart_revenue"])
    after = {name: written(name) for name in MARTS}
    assert [name for name in MARTS if before[name] != after[name]] == ["mart_revenue"]
    assert set(later) == set(built)
    sums = spark.sql("select sum(total_orders) from mart_revenue").first()
    assert sums[0] == built["stg_orders"].count()


def test_command_line(spark, raw, tmp_path, capsys):
    root = str(tmp_path / "w")
    seeds = []
    for table in RAW_SCHEMAS:
        path = str(tmp_path / table)
        raw(table, {}).write.option("header", True).csv(path)
        seeds.append(f"{table}={path}")
    assert main(["seed", "--root", root, *seeds]) == 0
    assert main(["run", "--root", root, "--as-of", "2024-07-01"]) == 0
    assert main(["test", "--root", root]) == 0
    pending = raw("raw_orders", {"status": "lost"})
    load_raw(pending, "raw_orders", table_path(root, "raw", "raw_orders"))
    assert main(["test", "--root", root]) == 1
    assert "accepted_values" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main(["seed", "--root", root, "raw_things=x.csv"])


def test_csv(spark, tmp_path):
    header = "product_id,product_name,category,sub_category,unit_price,cost_price\n"
    good = tmp_path / "good.csv"
    good.write_text(header + "p1,Pen,office,non-fiction,12.5,4\n")
    row = read_csv(spark, str(good), "raw_products").first()
    assert (row.product_id, str(row.unit_price), str(row.cost_price)) == ("p1", "12.5", "4.0")
    bad = tmp_path / "bad.csv"
    bad.write_text(header + "p1,Pen,office,non-fiction,much,4\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_csv(spark, str(bad), "raw_products").collect()
    wrong = tmp_path / "wrong.csv"
    wrong.write_text("id,name,a,b,c,d\n1,2,3,4,5,6\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(wrong), "raw_products").collect()


def test_csv_dates_and_booleans(spark, tmp_path):
    orders, visits = tmp_path / "o.csv", tmp_path / "s.csv"
    orders.write_text(
        ",".join(RAW_SCHEMAS["raw_orders"].names) + "\n"
        "1,c,2024-01-05 10:11:12,Completed,10.5,,0,p,2\n"
        "2,c,2024-01-05,Completed,10.5,1,0,,2\n"
        "3,c,2024-01-05T10:11:12.5,Completed,10.5,1,0,p,2\n"
    )
    rows = {r.order_id: r for r in read_csv(spark, str(orders), "raw_orders").collect()}
    assert rows["1"].order_date == dt.datetime(2024, 1, 5, 10, 11, 12)
    assert (rows["2"].order_date, rows["2"].product_id) == (dt.datetime(2024, 1, 5), None)
    assert (rows["3"].order_date.microsecond, rows["1"].discount) == (500000, None)
    visits.write_text(
        ",".join(RAW_SCHEMAS["raw_sessions"].names) + "\n"
        "1,c,2024-01-05,email,1,2,True\n2,,2024-01-06,email,1,2,false\n"
    )
    got = [(r.session_date.day, r.customer_id, r.converted)
           for r in read_csv(spark, str(visits), "raw_sessions").orderBy("session_id").collect()]
    assert got == [(5, "c", True), (6, None, False)]


def test_repeated_dimension_keys_can_be_refused(spark, raw, tmp_path):
    tables = SimpleNamespace(
        orders=raw("raw_orders", {}), customers=raw("raw_customers", {}),
        products=raw("raw_products", {}, {}), sessions=raw("raw_sessions", {}),
    )
    with pytest.raises(ValueError, match="stg_products.product_id"):
        build_all(spark, tables, str(tmp_path / "w"), AS_OF, RUN, check_keys=True)


def test_parquet_of_floats(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.sql(
        "select 'p' product_id, 'n' product_name, 'c' category, 's' sub_category,"
        " 19.99D unit_price, 5 cost_price, 'x' other"
    ).write.parquet(path)
    df = read_parquet(spark, path, "raw_products")
    assert df.schema.names == RAW_SCHEMAS["raw_products"].names
    assert str(df.first().unit_price) == "19.99"


def test_text_longer_than_declared_is_refused(spark, raw, tmp_path):
    with pytest.raises(Exception, match="raw_products.product_id is longer than 36"):
        load_raw(raw("raw_products", {"product_id": "x" * 37}), "raw_products", str(tmp_path / "p"))


def test_missing_table(spark, tmp_path):
    assert read_table(spark, str(tmp_path / "nothing")) is None


def test_order_feed(spark, raw, tmp_path, warehouse):
    models = warehouse[1]
    incoming, table = str(tmp_path / "in"), str(tmp_path / "table")

    def arrive(*rows, at):
        stamped = raw("raw_orders", *rows).withColumn(LOADED_AT, F.lit(at).cast("timestamp_ntz"))
        stamped.write.mode("append").parquet(incoming)

    def follow():
        query = follow_orders(
            spark, incoming, table, str(tmp_path / "cp"), models["stg_products"],
            models["stg_customers"],
        )
        query.awaitTermination()
        return {r.order_id: r.status for r in spark.read.parquet(table).collect()}

    first = dt.datetime(2024, 1, 1)
    arrive({"order_id": "1", "status": "pending"}, {"order_id": "2"}, at=first)
    assert follow() == {"1": "pending", "2": "completed"}
    arrive({"order_id": "1", "status": "pending"}, at=first + dt.timedelta(1))
    arrive({"order_id": "1"}, {"order_id": "3", "order_date": dt.datetime(2023, 5, 5)},
           at=first + dt.timedelta(2))
    assert follow() == {"1": "completed", "2": "completed", "3": "completed"}
    assert follow() == {"1": "completed", "2": "completed", "3": "completed"}


def test_the_order_feed_keeps_every_order_and_its_newest_version(spark, raw, tmp_path, warehouse):
    models, table = warehouse[1], str(tmp_path / "table")
    incoming = str(tmp_path / "in")

    def arrive(rows, at):
        stamp = F.lit(at).cast("timestamp_ntz")
        raw("raw_orders", *rows).withColumn(LOADED_AT, stamp).write.mode("append").parquet(incoming)
        follow_orders(
            spark, incoming, table, str(tmp_path / "cp"), models["stg_products"],
            models["stg_customers"],
        ).awaitTermination()
        return {r.order_id: r.status for r in spark.read.parquet(table).collect()}

    second, first = dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 1)
    # without load times no order is lost
    assert arrive([{"order_id": k} for k in "123"], None) == dict.fromkeys("123", "completed")
    # a version that arrives late does not win
    arrive([{"order_id": "1", "status": "returned"}], second)
    assert arrive([{"order_id": "1", "status": "pending"}], first)["1"] == "returned"
    # versions of one load are decided alike in one batch and in several
    versions = [{"order_id": "2", "status": s} for s in ("pending", "returned", "cancelled")]
    together = latest_versions(
        raw("raw_orders", *versions).withColumn(LOADED_AT, F.lit(first).cast("timestamp_ntz"))
    ).first().status
    for version in versions:
        got = arrive([version], first)
    assert got["2"] == together


def test_a_refused_load_leaves_the_table_and_appended_rows_add_up(spark, raw, tmp_path):
    path = str(tmp_path / "p")
    load_raw(raw("raw_products", {"product_id": "a"}), "raw_products", path)
    for append in (False, True):
        with pytest.raises(Exception, match="longer than 36"):
            load_raw(raw("raw_products", {"product_id": "x" * 40}), "raw_products", path, append=append)
        assert [r.product_id for r in spark.read.parquet(path).collect()] == ["a"]
    load_raw(raw("raw_products", {"product_id": "b"}), "raw_products", path, append=True)
    assert sorted(r.product_id for r in spark.read.parquet(path).collect()) == ["a", "b"]
    assert [p.name for p in tmp_path.iterdir()] == ["p"]


def test_raw_orders_lie_in_ranges_of_their_dates(spark, raw, tmp_path):
    path = str(tmp_path / "o")
    days = [{"order_id": str(k), "order_date": dt.datetime(2024, 1 + k % 12, 1)} for k in range(240)]
    with_partitions = raw("raw_orders", *days).repartition(4)
    load_raw(with_partitions, "raw_orders", path)
    spans = spark.read.parquet(path).groupBy(F.input_file_name()).agg(
        F.min("order_date").alias("low"), F.max("order_date").alias("high")
    ).orderBy("low").collect()
    assert all(a.high < b.low for a, b in zip(spans, spans[1:]))


@pytest.mark.parametrize("name", MARTS)
def test_any_mart_can_be_built_alone_on_a_new_root(spark, tmp_path, name):
    root, source = str(tmp_path / "w"), ShopTables(spark, "/root/testdata/sf0.001")
    built = build_all(spark, source, root, AS_OF, RUN, select=[name])
    assert [m for m in MARTS if m in built] == [name]
    assert built[name].count() > 0
    tables = {r["model"] for r in check_all(built).collect()}
    assert not (set(MARTS) - {name}) & tables


def test_dashboard_bound_reaches_the_scan(spark):
    import __spark_entry__ as spark_entry

    df = spark_entry.queries()["dashboard_month_category"](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate,2001-02-01" in plan


def test_checks_read_every_stored_table_once(warehouse):
    plan = check_all(warehouse[1])._jdf.queryExecution().optimizedPlan()
    tables = re.findall(r"Relation \[([^\]#]+)#", plan.toString())
    assert len(tables) == 8
    assert len(warehouse[1]) == 9  # no check looks at the first-touch mart


def test_another_session_reads_published_tables_by_name(spark, warehouse):
    root = warehouse[0]
    stored = table_path(root, "marts", "mart_revenue")
    names = publish(spark, root)
    assert set(names) == {f"raw.{t}" for t in RAW_SCHEMAS} | {f"marts.{m}" for m in MARTS}
    assert publish(spark, root) == names
    other = spark.newSession()
    mart = other.table("marts.mart_revenue")
    assert mart.count() == spark.read.parquet(stored).count() > 0
    recent = mart.filter("order_month >= date '2001-02-01'")
    assert "PartitionFilters: [isnotnull(order_month" in final_plan(recent)
    other.sql("drop table marts.mart_revenue")
    assert spark.read.parquet(stored).count() > 0
