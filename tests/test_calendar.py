import datetime as dt

from shoplens.operators.calendar import date_spine


def test_end_is_exclusive(spark):
    rows = date_spine(spark, dt.date(2024, 6, 29), dt.date(2024, 7, 2)).collect()
    assert [r.date_day.day for r in rows] == [29, 30, 1]
    saturday, sunday, monday = rows
    assert (saturday.day_of_week, saturday.day_name, saturday.is_weekend) == (6, "Sat", True)
    assert (sunday.day_of_week, sunday.week_start_date, sunday.is_weekend) == (
        0, dt.date(2024, 6, 24), True)
    assert (monday.month_name, monday.quarter, monday.quarter_start_date) == (
        "Jul", 3, dt.date(2024, 7, 1))
    assert (monday.year, monday.month, monday.day, monday.is_weekend) == (2024, 7, 1, False)


def test_empty_ranges(spark):
    day = dt.date(2024, 1, 1)
    assert date_spine(spark, day, day).count() == 0
    assert date_spine(spark, day, dt.date(2023, 1, 1)).count() == 0
