"""Money as exact decimals, ratios as doubles.

Sums run over decimals or integers, so a result does not depend on how the rows were partitioned.
Raw money stays a double until staging has filtered and tiered it and rounds it once.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DecimalType, DoubleType

MONEY = DecimalType(18, 2)
RAW_MONEY = DoubleType()
TOTAL = DecimalType(28, 2)


def money(c: Column) -> Column:
    """Round half away from zero to cents, which is how Spark casts to a decimal."""
    return c.cast(MONEY)


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """NULL where the denominator is zero or NULL."""
    return numerator / F.nullif(denominator, F.lit(0))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` of ``whole`` in percent, NULL where ``whole`` is zero."""
    return F.round(safe_divide(part.cast("double"), whole.cast("double")) * 100, digits)


def cents_to_dollars(c: Column) -> Column:
    return money(c / F.lit(Decimal("100.0")))


def money_sum(c: Column) -> Column:
    """Exact sum of a column of cents-precise decimals, with or without ANSI mode."""
    return F.sum(c.cast(MONEY)).cast(TOTAL)


def money_mean(c: Column) -> Column:
    """Mean of a decimal column: an exact sum, divided once."""
    return money_sum(c).cast("double") / F.nullif(F.count(c), F.lit(0))


def exact_mean(c: Column, digits: int) -> Column:
    """Mean of doubles that carry ``digits`` decimals, summed as integers."""
    unit = 10**digits
    return F.sum(F.rint(c * unit).cast("bigint")) / (F.nullif(F.count(c), F.lit(0)) * unit)


def decimal_mean(c: Column) -> Column:
    """Mean of doubles that have been divided already, summed with all their digits."""
    return F.sum(c.cast("decimal(38,18)")).cast("double") / F.nullif(F.count(c), F.lit(0))
