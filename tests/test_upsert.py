import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF
from shoplens.operators import locator
from shoplens.operators.layout import Layout
from shoplens.operators.upsert import DuplicateKeys, upsert, upsert_table
from shoplens.plans import orders, staging
from shoplens.sources import read_table

LAYOUT = Layout(partition_by=("part",), cluster_by=("v",))


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "t")

    def put(rows, schema="id string, v string, part string"):
        upsert_table(
            spark, path, read_table(spark, path), spark.createDataFrame(rows, schema), "id", LAYOUT
        )

    put.path = path
    put.rows = lambda: sorted(
        tuple(r[c] for c in ("id", "v", "part")) for r in read_table(spark, path).collect()
    )
    return put


def files(path, part):
    return {p.name: p.stat().st_mtime_ns for p in Path(path, f"part={part}").glob("*.parquet")}


def test_rows_are_added_and_replaced_and_other_partitions_keep_their_files(table):
    table([("1", "a", "x"), ("2", "b", "y"), ("3", "c", "y")])
    untouched, rewritten = files(table.path, "x"), files(table.path, "y")
    table([("2", "B", "y"), ("4", "d", "z")])
    assert table.rows() == [("1", "a", "x"), ("2", "B", "y"), ("3", "c", "y"), ("4", "d", "z")]
    assert files(table.path, "x") == untouched
    assert files(table.path, "y") != rewritten


def test_the_same_batch_twice_changes_nothing(table):
    table([("1", "a", "x")])
    for _ in range(2):
        table([("1", "A", "x"), ("2", "b", "x")])
    assert table.rows() == [("1", "A", "x"), ("2", "b", "x")]


def test_a_row_that_moves_leaves_its_old_partition(table):
    table([("1", "a", "x"), ("2", "b", "x"), ("3", "c", "y")])
    table([("2", "b", "z")])
    assert table.rows() == [("1", "a", "x"), ("2", "b", "z"), ("3", "c", "y")]
    table([("3", "c", "z")])
    assert table.rows() == [("1", "a", "x"), ("2", "b", "z"), ("3", "c", "z")]
    assert not files(table.path, "y")


def test_rows_without_partition_value(table):
    table([("1", "a", None), ("2", "b", "x")])
    table([("1", "A", "x"), ("3", "c", None)])
    assert table.rows() == [("1", "A", "x"), ("2", "b", "x"), ("3", "c", None)]
    table([("3", "C", "x")])
    assert table.rows() == [("1", "A", "x"), ("2", "b", "x"), ("3", "C", "x")]


def test_partition_values_that_folders_cannot_show(spark, table):
    table([("1", "a", "x y/z: 50%"), ("2", "b", "007")])
    table([("1", "A", "007"), ("3", "c", "7")])
    stored = spark.read.schema("id string, v string, part string").parquet(table.path)
    assert sorted(map(tuple, stored.collect())) == [
        ("1", "A", "007"), ("2", "b", "007"), ("3", "c", "7")]


def test_an_empty_batch_and_an_empty_table(table):
    table([])
    table([("1", "a", "x")])
    table([])
    assert table.rows() == [("1", "a", "x")]


def test_repeated_keys_in_a_batch_are_refused(table):
    table([("1", "a", "x")])
    with pytest.raises(DuplicateKeys):
        table([("2", "a", "x"), ("2", "b", "x")])
    assert table.rows() == [("1", "a", "x")]


def test_columns_follow_the_batch_and_other_partitions_keep_their_files(spark, table):
    table([("1", "a", "x"), ("2", "b", "y"), ("4", "d", "z")])
    untouched, others = files(table.path, "x"), files(table.path, "z")
    wider = "id string, v string, part string, extra int"
    table([("2", "B", "y", 5)], wider)
    got = {r.id: (r.v, r.extra) for r in read_table(spark, table.path).collect()}
    assert got == {"1": ("a", None), "2": ("B", 5), "4": ("d", None)}
    table([("3", "c", "y")])
    assert set(read_table(spark, table.path).columns) == {"id", "v", "part"}
    assert table.rows() == [("1", "a", "x"), ("2", "B", "y"), ("3", "c", "y"), ("4", "d", "z")]
    table([], "id string, v string, part string, later int")
    assert set(read_table(spark, table.path).columns) == {"id", "v", "part", "later"}
    assert files(table.path, "x") == untouched and files(table.path, "z") == others


def test_a_column_that_comes_back_does_not_bring_its_old_values(spark, table):
    wider = "id string, v string, part string, extra int"
    table([("1", "a", "x", 1), ("2", "b", "y", 2)], wider)
    table([("2", "b", "y")])
    table([("3", "c", "y", 3)], wider)
    got = {r.id: r.extra for r in read_table(spark, table.path).collect()}
    assert got == {"1": None, "2": None, "3": 3}


def test_a_column_of_another_type(spark, table):
    table([("1", "7", "x"), ("2", "8", "y")])
    table([("2", 9, "y")], "id string, v int, part string")
    assert table.rows() == [("1", 7, "x"), ("2", 9, "y")]
    table([("1", 5, "y")], "id string, v int, part string")
    assert table.rows() == [("1", 5, "y"), ("2", 9, "y")]


def spoil(path, part):
    """Makes the files of a partition unreadable."""
    for file in Path(path, f"part={part}").glob("*.parquet"):
        file.write_bytes(b"x" * file.stat().st_size)
        Path(path, f"part={part}", f".{file.name}.crc").unlink(missing_ok=True)


@pytest.mark.parametrize("buckets", [1, 5])
def test_partitions_without_a_key_of_the_batch_are_not_opened(spark, table, monkeypatch, buckets):
    monkeypatch.setattr(locator, "KEYS_PER_BUCKET", -(-6 // buckets))
    monkeypatch.setattr(locator, "MOST_FILES", 2)
    table([(str(k), "v", "xyz"[k // 2]) for k in range(6)])
    table([("0", "w", "x")])
    spoil(table.path, "z")
    # moved, changed and new, and a key moved twice
    table([("1", "m", "y"), ("2", "c", "y"), ("9", "n", "x")])
    table([("1", "m", "x"), ("10", "n", "new")])
    # the former place of a key is looked at in vain, others never
    table([("1", "again", "x")])
    left = read_table(spark, table.path).filter("part <> 'z'").collect()
    assert sorted((r.id, r.v, r.part) for r in left) == [
        ("0", "w", "x"), ("1", "again", "x"), ("10", "n", "new"), ("2", "c", "y"), ("3", "v", "y"),
        ("9", "n", "x")]
    # keys of the other partition are found there
    with pytest.raises(Exception, match="not a Parquet file"):
        table([("4", "v", "x")])


def test_the_key_table_grows_more_buckets(spark, table, monkeypatch):
    monkeypatch.setattr(locator, "MOST_FILES", 1)
    table([(str(k), "v", "x") for k in range(4)])
    monkeypatch.setattr(locator, "KEYS_PER_BUCKET", 5)
    table([(str(k), "w", "y") for k in range(4, 24)])
    held = [p.name for p in Path(table.path).glob("_keys_*")]
    assert held == ["_keys_id_5"]
    table([("3", "moved", "z"), ("20", "moved", "x"), ("99", "new", "y")])
    rows = {r[0]: r[1:] for r in table.rows()}
    assert len(rows) == 25 and rows["3"] == ("moved", "z") and rows["20"] == ("moved", "x")


def test_a_table_replaced_as_a_whole_gets_its_keys_anew(spark, table):
    table([("1", "a", "x"), ("2", "b", "y")])
    table([("1", "A", "x")])
    upsert_table(
        spark, table.path, None, spark.createDataFrame([("5", "e", "x"), ("6", "f", "y")],
                                                       "id string, v string, part string"),
        "id", LAYOUT,
    )
    table([("5", "E", "z"), ("1", "new", "y")])
    assert table.rows() == [("1", "new", "y"), ("5", "E", "z"), ("6", "f", "y")]


def test_upsert_of_frames(spark):
    def df(rows):
        return spark.createDataFrame(rows, "id int, v string")

    got = upsert(df([(1, "a"), (2, "b")]), df([(2, "B"), (3, "c")]), "id").collect()
    assert sorted(map(tuple, got)) == [(1, "a"), (2, "B"), (3, "c")]


@pytest.fixture
def shop(raw):
    products = staging.stg_products(raw("raw_products", {}))
    people = staging.stg_customers(raw("raw_customers", {}), AS_OF)

    def order(order_id, day, status="completed"):
        return {"order_id": order_id, "order_date": day, "status": status}

    def stage(*rows):
        return staging.stg_orders(raw("raw_orders", *rows))

    return order, stage, products, people


def ids(spark, path):
    return {r.order_id: r.status for r in read_table(spark, path).collect()}


def test_only_orders_after_the_mark_are_loaded(spark, shop, tmp_path):
    order, stage, products, people = shop
    path = str(tmp_path / "orders")
    old = order("1", dt.datetime(2024, 1, 10))
    mark = order("2", dt.datetime(2024, 2, 10))
    orders.update_orders(spark, path, stage(old, mark), products, people)
    tie, late = order("3", dt.datetime(2024, 2, 10)), order("4", dt.datetime(2024, 1, 20))
    new = order("5", dt.datetime(2024, 2, 11))
    changed = order("2", dt.datetime(2024, 2, 10), "returned")
    source = stage(old, changed, tie, late, new)
    orders.update_orders(spark, path, source, products, people)
    assert ids(spark, path) == {"1": "completed", "2": "completed", "5": "completed"}
    orders.update_orders(spark, path, source, products, people, lookback=dt.timedelta(days=30))
    assert ids(spark, path) == {
        "1": "completed", "2": "returned", "3": "completed", "4": "completed", "5": "completed"}
    before = {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}
    orders.update_orders(spark, path, source, products, people)
    assert {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")} == before
    orders.update_orders(spark, path, stage(new), products, people, full_refresh=True)
    assert set(ids(spark, path)) == {"5"}


def test_statuses_and_an_empty_first_load(spark, shop, tmp_path):
    order, stage, products, people = shop
    path = str(tmp_path / "orders")
    day = dt.datetime(2024, 1, 10)
    pending = stage(order("1", day, "pending"))
    orders.update_orders(spark, path, pending, products, people, statuses=["completed"])
    both = stage(order("1", day, "pending"), order("2", day))
    orders.update_orders(spark, path, both, products, people, statuses=["completed"])
    assert set(ids(spark, path)) == {"2"}


def test_increment_is_none_over_an_empty_table(shop):
    order, stage, _, _ = shop
    some = stage(order("1", dt.datetime(2024, 1, 10)))
    assert orders.orders_increment(some, some.filter(F.lit(False))).count() == 0


def test_the_first_load_refuses_repeated_keys_too(table):
    with pytest.raises(DuplicateKeys):
        table([("1", "a", "x"), ("1", "b", "y")])
    assert not Path(table.path).exists()


def test_removed_keys_go_and_older_versions_stay_out(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "id string, v string, part string, at int, tie string"

    def put(rows, removed=()):
        upsert_table(
            spark, path, read_table(spark, path), spark.createDataFrame(rows, schema), "id",
            LAYOUT, newer=("at", "tie"),
            removed=spark.createDataFrame([(k,) for k in removed], "id string"),
        )
        return sorted((r.id, r.v) for r in read_table(spark, path).collect())

    assert put([("1", "a", "x", 5, "m"), ("2", "b", "y", None, "m")]) == [("1", "a"), ("2", "b")]
    assert put([("1", "old", "x", 4, "z"), ("2", "new", "y", 1, "a")]) == [("1", "a"), ("2", "new")]
    assert put([("1", "lower", "x", 5, "a"), ("2", "none", "y", None, "z")]) == [("1", "a"), ("2", "new")]
    assert put([("1", "higher", "z", 5, "n")], removed=["2", "9"]) == [("1", "higher")]
    assert not files(path, "x") and not files(path, "y")


def test_an_order_whose_status_leaves_the_list_goes(spark, raw, tmp_path):
    path = str(tmp_path / "orders")
    day = dt.datetime(2024, 1, 10)

    def update(*rows):
        orders.update_orders(
            spark, path, staging.stg_orders(raw("raw_orders", *rows)),
            staging.stg_products(raw("raw_products", {})),
            staging.stg_customers(raw("raw_customers", {}), AS_OF),
            lookback=dt.timedelta(31), statuses=("completed",),
        )
        return sorted(r.order_id for r in read_table(spark, path).collect())

    first = [{"order_id": k, "order_date": day} for k in "abc"]
    assert update(*first, {"order_id": "d", "order_date": day, "status": "pending"}) == ["a", "b", "c"]
    later = [{"order_id": "a", "order_date": day, "status": "returned"},
             {"order_id": "b", "order_date": day, "status": None},
             {"order_id": "d", "order_date": day}]
    assert update(*later) == ["c", "d"]


def test_a_customer_is_found_by_an_increment(spark, raw, tmp_path):
    path = str(tmp_path / "orders")
    people = [{"customer_id": str(k), "country": f"land {k}"} for k in range(50)]
    for day, customer in ((1, "3"), (2, "7")):
        orders.update_orders(
            spark, path,
            staging.stg_orders(raw("raw_orders", {"order_id": customer, "customer_id": customer,
                                                  "order_date": dt.datetime(2024, 1, day)})),
            staging.stg_products(raw("raw_products", {})),
            staging.stg_customers(raw("raw_customers", *people), AS_OF),
        )
    got = {r.order_id: (r.country, r.product_name) for r in read_table(spark, path).collect()}
    assert got == {"3": ("Land 3", "pen"), "7": ("Land 7", "pen")}
