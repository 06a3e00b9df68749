import datetime as dt

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from shoplens import functions as fn


def column(spark, values, kind, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in df.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


def test_title_case_starts_words_after_punctuation(spark):
    given_ = ["at-risk", "NON-FICTION", "o'brien mac_x", "a/b(c)d", "", None, "  vip ", "x\ty"]
    wanted = ["At-Risk", "Non-Fiction", "O'brien Mac_X", "A/B(C)D", "", None, "Vip", "X\tY"]
    assert column(spark, given_, "string", fn.title_case) == wanted


@settings(max_examples=5, deadline=None)
@given(words=st.lists(st.text("abXY1 -_./[]\\^$&'", max_size=12), min_size=1, max_size=30))
def test_title_case_agrees_with_a_plain_loop(spark, words):
    def plain(text):
        out, starts = [], True
        for ch in text.strip(" ").lower():
            out.append(ch.upper() if starts else ch)
            starts = ch in fn.text.WORD_DELIMITERS or ch.isspace()
        return "".join(out)

    assert column(spark, words, "string", fn.title_case) == [plain(w) for w in words]


def test_calendar_boundaries(spark):
    rows = [
        (dt.datetime(2024, 1, 31, 23, 59), dt.datetime(2024, 2, 1, 0, 1)),
        (dt.datetime(2023, 12, 31), dt.datetime(2024, 1, 1)),
        (dt.datetime(2024, 3, 1), dt.datetime(2024, 2, 1)),
    ]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    got = df.select(
        fn.day_boundaries(F.col("a"), F.col("b")), fn.month_boundaries(F.col("a"), F.col("b"))
    ).collect()
    assert [tuple(r) for r in got] == [(1, 1), (1, 1), (-29, -1)]


def test_week_starts_on_monday_and_sunday_is_day_zero(spark):
    days = [dt.date(2024, 7, d) for d in (13, 14, 15)]
    monday = dt.date(2024, 7, 8)
    assert column(spark, days, "date", fn.week_start) == [monday, monday, dt.date(2024, 7, 15)]
    assert column(spark, days, "date", fn.day_of_week) == [6, 0, 1]
    assert column(spark, days, "date", fn.month_start) == [dt.date(2024, 7, 1)] * 3
    assert column(spark, days, "date", fn.quarter_start) == [dt.date(2024, 7, 1)] * 3


def test_safe_divide(spark):
    df = spark.createDataFrame([(6.0, 2.0), (1.0, 0.0), (1.0, None), (None, 2.0)], "n double, d double")
    got = [r[0] for r in df.select(fn.safe_divide(F.col("n"), F.col("d"))).collect()]
    assert got == [3.0, None, None, None]


def test_cents_to_dollars(spark):
    got = column(spark, [1999, 5, 0, None], "bigint", fn.cents_to_dollars)
    assert [str(v) for v in got] == ["19.99", "0.05", "0.00", "None"]


def test_money_rounds_half_away_from_zero(spark):
    got = column(spark, ["1.0050", "-1.0050", "1.0049"], "string",
                 lambda c: fn.money(c.cast("decimal(18,4)")))
    assert [str(v) for v in got] == ["1.01", "-1.01", "1.00"]


@pytest.mark.parametrize("partitions", [1, 7])
def test_money_sum_is_exact(spark, partitions):
    df = spark.range(0, 100_000, 1, partitions).select(F.lit("0.01").cast("decimal(18,2)").alias("m"))
    total, mean, empty = df.agg(
        fn.money_sum(F.col("m")), fn.money_mean(F.col("m")),
        fn.money_sum(F.when(F.lit(False), F.col("m"))),
    ).first()
    assert (str(total), mean, empty) == ("1000.00", 0.01, None)


def test_means_ignore_missing_values(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (None,)], "x double")
    x, none = F.col("x"), F.when(F.lit(False), F.col("x"))
    got = df.agg(fn.exact_mean(x, 1), fn.decimal_mean(x), fn.exact_mean(none, 1)).first()
    assert [got[0], got[1], got[2]] == [0.15, 0.15, None]
