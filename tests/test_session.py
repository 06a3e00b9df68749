from pathlib import Path
from types import SimpleNamespace

import pytest

from shoplens import session as session_module
from shoplens.session import scratch_path, settings_for, sized_session, skew_risks


def session(master, folder=None):
    conf = {"spark.checkpoint.dir": folder} if folder else {}
    return SimpleNamespace(
        conf=SimpleNamespace(get=conf.get),
        sparkContext=SimpleNamespace(master=master),
    )


def test_scratch_lies_in_the_shared_folder():
    paths = {scratch_path(session("yarn", "hdfs://shared/tmp/"), "x") for _ in range(2)}
    assert len(paths) == 2
    assert all(p.startswith("hdfs://shared/tmp/x-") for p in paths)


def test_a_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(session("spark://host"), "x")


def test_a_local_session_gets_a_folder_once():
    local = session("local[2]")
    first, second = scratch_path(local, "x"), scratch_path(local, "x")
    assert first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]


def test_partitions_follow_the_input():
    def sizes(input_bytes, cores):
        conf = settings_for(input_bytes, cores)
        split = int(conf["spark.sql.files.maxPartitionBytes"])
        return split >> 20, int(conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"])

    assert sizes(0, 8) == (128, 8)
    assert sizes(1 << 40, 800) == (128, 800)
    assert sizes(100 << 40, 8000) == (512, 40960)


def test_settings_that_hide_hot_keys_are_named(spark):
    assert skew_risks(spark) == []

    def risks(sql, core):
        context = SimpleNamespace(getConf=lambda: core)
        return skew_risks(SimpleNamespace(conf=sql, sparkContext=context))

    unsized = "spark.sql.adaptive.coalescePartitions.initialPartitionNum is not sized for the input"
    assert risks({}, {}) == [unsized]
    assert risks({"spark.sql.adaptive.enabled": "false"}, {}) == [
        "spark.sql.adaptive.enabled is off", unsized,
    ]
    many = {"spark.sql.shuffle.partitions": "40000"}
    assert len(risks(many, {})) == 1
    assert risks(many, {"spark.shuffle.accurateBlockSkewedFactor": "5.0"}) == []


def test_a_session_is_sized_by_its_input(spark, tmp_path):
    names = ("spark.sql.adaptive.coalescePartitions.initialPartitionNum",
             "spark.sql.files.maxPartitionBytes", "spark.sql.session.timeZone")
    before = {n: spark.conf.get(n) for n in names}
    try:
        (tmp_path / "x").write_bytes(b"x" * 1000)
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        builder = SimpleNamespace(getOrCreate=lambda: spark)
        sized = sized_session(builder, [str(tmp_path), str(tmp_path / "missing")])
        assert sized.conf.get("spark.sql.session.timeZone") == "UTC"
        assert skew_risks(sized) == []
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_scratch_tables_go_when_the_driver_ends(spark):
    path = scratch_path(spark, "leftover")
    spark.range(3).write.parquet(path)
    assert Path(path).exists()
    delete = session_module._delete_scratch
    delete()
    assert not Path(path).exists()
