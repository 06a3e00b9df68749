"""Choosing a value by conditions."""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from pyspark.sql import Column, functions as F


def first_match(branches: Iterable[tuple[Column, Any]], otherwise: Any) -> Column:
    """The value of the first condition that holds."""
    (condition, value), *rest = branches
    chosen = F.when(condition, value)
    for condition, value in rest:
        chosen = chosen.when(condition, value)
    return chosen.otherwise(otherwise)


def true_or_false(condition: Column) -> Column:
    """A condition whose unknown outcome counts as false."""
    return F.coalesce(condition, F.lit(False))
