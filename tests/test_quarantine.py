import datetime as dt

import pytest

from shoplens.sources import RAW_SCHEMAS
from shoplens.sources.quarantine import TooManyBadLines, load_csv

HEADER = "product_id,product_name,category,sub_category,unit_price,cost_price"
GOOD = [f'p{k},"pen, {k}",office,pens,{k}.5,1' for k in range(8)] + ["p8,pad,,,,", r'p9,"a \"b\"",c,d,1,2']
BAD = {
    "x1,pen,office,pens,cheap,1": "unit_price is not of type double",
    "x2,pen,office,pens,1,dear": "cost_price is not of type double",
    "x3,pen,office": "wrong number of fields",
    "x4,pen,office,pens,1,2,3": "wrong number of fields",
    f"{'x' * 37},pen,office,pens,1.0,2.0": "product_id is longer than 36",
}


@pytest.fixture
def load(spark, tmp_path):
    def run(name, lines, **rest):
        folder = tmp_path / "in"
        folder.mkdir(exist_ok=True)
        (folder / name).write_text("\n".join([HEADER, *lines]) + "\n")
        return load_csv(
            spark, str(folder / name), "raw_products", str(tmp_path / "raw"),
            str(tmp_path / "rejected"), run_ts=dt.datetime(2024, 1, 1), **rest,
        )

    run.raw, run.rejected = str(tmp_path / "raw"), str(tmp_path / "rejected")
    return run


def test_good_lines_are_loaded_and_bad_ones_kept(spark, load):
    assert load("a.csv", [*GOOD[:5], *BAD, *GOOD[5:]], most_bad=0.5) == (10, 5)
    raw = {r.product_id: r for r in spark.read.parquet(load.raw).collect()}
    assert sorted(raw) == [f"p{k}" for k in range(10)]
    assert raw["p3"].product_name == "pen, 3" and raw["p3"].unit_price == 3.5
    assert raw["p8"].unit_price is None and raw["p9"].product_name == 'a "b"'
    rejected = spark.read.parquet(load.rejected).collect()
    assert {r._line: r._reason for r in rejected} == BAD
    assert all(r._file.endswith("in/a.csv") for r in rejected)
    # another file is added to both
    assert load("b.csv", [GOOD[0], "y,1"], most_bad=0.5, append=True) == (1, 1)
    assert spark.read.parquet(load.raw).count() == 11
    assert spark.read.parquet(load.rejected).count() == 6


def test_too_many_bad_lines_refuse_the_load(spark, load):
    load("a.csv", GOOD)
    with pytest.raises(TooManyBadLines, match="5 of 15 lines"):
        load("b.csv", [*GOOD, *BAD], most_bad=0.3)
    assert spark.read.parquet(load.raw).count() == len(GOOD)
    assert spark.read.parquet(load.rejected).count() == 5


def test_a_wrong_header_raises(spark, load, tmp_path):
    file = tmp_path / "d.csv"
    file.write_text(HEADER.replace("category", "kind") + "\n" + GOOD[0])
    with pytest.raises(Exception, match="(?i)header"):
        load_csv(spark, str(file), "raw_products", load.raw, load.rejected)


def test_no_lines(spark, load):
    assert load("a.csv", []) == (0, 0)
    assert spark.read.parquet(load.raw).columns == [*RAW_SCHEMAS["raw_products"].names, "_loaded_at"]
