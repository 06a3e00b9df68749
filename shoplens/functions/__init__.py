"""Column functions: text, calendar and money. All of them are built-in Spark expressions."""

from shoplens.functions.choice import first_match, true_or_false
from shoplens.functions.dates import (
    as_of_date,
    day_boundaries,
    day_of_week,
    month_boundaries,
    month_start,
    quarter_start,
    week_start,
)
from shoplens.functions.money import (
    MONEY,
    RAW_MONEY,
    TOTAL,
    cents_to_dollars,
    decimal_mean,
    exact_mean,
    money,
    money_mean,
    money_sum,
    percent,
    safe_divide,
)
from shoplens.functions.text import clean, row_text, title_case

__all__ = [
    "MONEY", "RAW_MONEY", "TOTAL", "as_of_date", "cents_to_dollars", "clean", "day_boundaries",
    "day_of_week", "decimal_mean", "exact_mean", "first_match", "money", "money_mean", "money_sum",
    "month_boundaries", "month_start", "percent", "quarter_start", "row_text", "safe_divide",
    "title_case", "true_or_false", "week_start",
]
