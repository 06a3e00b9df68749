import datetime as dt
import json
from collections import Counter
from pathlib import Path

import pytest

from shoplens.sources import compaction, load_raw

NOW = dt.datetime(2024, 6, 1)


@pytest.fixture
def table(spark, raw, tmp_path):
    path = str(tmp_path / "orders")

    def add(month, *days, append=True):
        rows = [
            {"order_id": f"{month}-{d}-{k}", "order_date": dt.datetime(2024, month, d, k), "amount": k + 1}
            for d in days for k in range(3)
        ]
        load_raw(raw("raw_orders", *rows), "raw_orders", path, NOW, append)

    add(1, *range(1, 29), append=False)
    add(2, 3)
    for day in range(1, 13):
        add(3, day)
    add.path = path
    return add


def names(path):
    return {p.name for p in Path(path).glob("*.parquet")}


def rows(spark, path):
    return Counter(map(tuple, spark.read.parquet(path).collect()))


def lows(spark, path):
    found = compaction.file_statistics(spark, path, "order_date").collect()
    return {r.file.rpartition("/")[2]: r.low.month for r in found}


def test_only_months_with_many_small_files_are_rewritten(spark, table):
    before, held = rows(spark, table.path), lows(spark, table.path)
    assert Counter(held.values())[3] == 12
    assert compaction.compact(spark, table.path, "order_date") == 12
    assert rows(spark, table.path) == before
    now = lows(spark, table.path)
    assert Counter(now.values())[3] == 1
    assert {n for n, m in held.items() if m != 3} <= now.keys()
    assert compaction.JOURNAL not in {p.name for p in Path(table.path).iterdir()}
    # nothing is left to do, and large files are no small ones
    assert compaction.compact(spark, table.path, "order_date") == 0
    assert compaction.compact(spark, table.path, "order_date", target_bytes=100, most_small=0) == 0
    for day in range(13, 25):
        table(3, day)
    assert compaction.compact(spark, table.path, "order_date") == 13
    assert sum(rows(spark, table.path).values()) == sum(before.values()) + 36


def test_a_run_that_was_cut_off_is_finished(spark, table, monkeypatch):
    before = rows(spark, table.path)
    finish, calls = compaction._finish, []

    def stop(spark, path):
        calls.append(path)
        if len(calls) == 2:
            raise RuntimeError("cut off")
        finish(spark, path)

    monkeypatch.setattr(compaction, "_finish", stop)
    with pytest.raises(RuntimeError, match="cut off"):
        compaction.compact(spark, table.path, "order_date")
    journal = json.loads(Path(table.path, compaction.JOURNAL).read_text())
    assert len(journal["old"]) == 12
    assert rows(spark, table.path) == before
    # some files were moved and deleted before the cut
    fresh = next(Path(table.path, journal["fresh"]).glob("*.parquet"))
    fresh.rename(Path(table.path, fresh.name))
    Path(table.path, journal["old"][0]).unlink()
    monkeypatch.setattr(compaction, "_finish", finish)
    compaction.compact(spark, table.path, "order_date")
    assert rows(spark, table.path) == before
    assert not names(table.path) & set(journal["old"])
