"""Data-quality checks.

``failing_rows`` of a check is empty when it passes. ``report`` counts the failures of many checks
with one pass per table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shoplens.functions import row_text


@dataclass(frozen=True)
class RowCheck:
    """A check each row passes or fails on its own."""

    table: str
    column: str
    name: str

    def fails(self) -> Column:
        raise NotImplementedError

    def failing_rows(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        return tables[self.table].filter(self.fails())


@dataclass(frozen=True)
class NotNull(RowCheck):
    name: str = "not_null"

    def fails(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class AcceptedValues(RowCheck):
    """NULL passes."""

    name: str = "accepted_values"
    values: tuple[str, ...] = ()

    def fails(self) -> Column:
        return ~F.col(self.column).isin(*self.values)

    def failing_values(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        """Values outside the list with their number of rows."""
        return self.failing_rows(tables).groupBy(F.col(self.column).alias("value")).agg(
            F.count("*").alias("rows")
        )


@dataclass(frozen=True)
class Holds(RowCheck):
    """A condition that must not be false, as SQL text over the columns of a row."""

    name: str = "holds"
    condition: str = "true"

    def fails(self) -> Column:
        return ~F.expr(self.condition)


@dataclass(frozen=True)
class Unique:
    """No value twice. NULL passes, however often it occurs."""

    table: str
    column: str
    name: str = "unique"

    def failing_rows(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        """Repeated values with their number of rows."""
        value = F.col(self.column)
        counted = tables[self.table].filter(value.isNotNull()).groupBy(value.alias("value"))
        return counted.agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)


@dataclass(frozen=True)
class Relationship:
    """Every value occurs in a column of another table. NULL passes."""

    table: str
    column: str
    name: str = "relationships"
    parent: str = ""
    parent_column: str = ""

    def failing_rows(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        """Orphaned values with their number of rows.

        Both sides are reduced to distinct values before they meet, so one that fills a third of
        either table is one row. The parents' reduction shuffles as the join needs it.
        """
        value = F.col(self.column)
        children = (
            tables[self.table].filter(value.isNotNull())
            .groupBy(value.alias("value")).agg(F.count("*").alias("rows"))
        )
        parents = tables[self.parent].select(F.col(self.parent_column).alias("value")).distinct()
        return children.join(parents, "value", "left_anti")


Check = RowCheck | Unique | Relationship


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def value_failures(checks: Iterable[Check], tables: Mapping[str, DataFrame]) -> DataFrame:
    """Failing values of several checks and their number of rows.

    Every table is read once, and values of all checks meet in one aggregation.
    """
    checks = list(checks)
    rows = _inlined(
        _findings(checks, lambda value: [value.alias("value")], by_value=True), tables
    )
    values = rows.groupBy("number", "value").agg(
        F.sum("child").alias("rows"), F.sum("parent").alias("parents")
    )
    once = F.col("number").isin([k for k, c in enumerate(checks) if isinstance(c, Unique)])
    fails = F.when(once, F.col("rows") > 1).otherwise((F.col("rows") > 0) & (F.col("parents") == 0))
    named = _label_of(checks, F.col("number"))
    return values.filter(fails).select(
        *(named[name].alias(name) for name in ("model", "column_name", "test")), "value", "rows"
    )


def missing_values(
    checks: Iterable[NotNull], tables: Mapping[str, DataFrame], row_keys: Mapping[str, Sequence[str]]
) -> DataFrame:
    """The rows that fail ``NotNull`` checks, named by the columns that tell a table's rows apart.

    Every table is read once.
    """
    entries: dict[str, list[Column]] = {}
    for check in checks:
        failure = F.struct(*_names(check), row_text(*row_keys[check.table]).alias("row_key"))
        entries.setdefault(check.table, []).append(F.when(check.fails(), failure))
    return _inlined(entries, tables)


def _names(check: Check) -> list[Column]:
    return [
        F.lit(check.table).alias("model"), F.lit(check.column).alias("column_name"),
        F.lit(check.name).alias("test"),
    ]


def _label_of(checks: Sequence[Check], number: Column) -> Column:
    return F.array(*(F.struct(*_names(c)) for c in checks))[number]


def _inlined(entries: Mapping[str, list[Column]], tables: Mapping[str, DataFrame]) -> DataFrame:
    """The entries of each row of each table that are not NULL, as rows."""
    return union_all(
        tables[name].select(F.inline(F.filter(F.array(*own), lambda e: e.isNotNull())))
        for name, own in entries.items()
    )


def _hashed(value: Column) -> list[Column]:
    """128 bits of hash, which makes a collision as good as impossible."""
    return [F.xxhash64(value).alias("high"), F.xxhash64(F.lit(1), value).alias("low")]


def _findings(
    checks: list[Check], shown: Callable[[Column], list[Column]] = _hashed, by_value: bool = False
) -> dict[str, list[Column]]:
    """For each table what a row of it adds to each check; NULL where it adds nothing.

    ``child`` counts a failing row, a value, or a value that needs a parent, ``parent`` a parent.
    Values travel as ``shown``; those that fail on their own only with ``by_value``.
    """
    found: dict[str, list[Column]] = {}

    def add(table: str, number: int, when: Column, value: Column, *, parent: bool = False) -> None:
        text = value.cast("string")
        entry = F.struct(
            F.lit(number).alias("number"),
            *shown(text),
            F.lit(int(not parent)).alias("child"),
            F.lit(int(parent)).alias("parent"),
        )
        found.setdefault(table, []).append(F.when(when, entry))

    for number, check in enumerate(checks):
        if isinstance(check, RowCheck):
            value = F.col(check.column) if by_value else F.lit(None)
            add(check.table, number, check.fails(), value)
            continue
        value = F.col(check.column)
        add(check.table, number, value.isNotNull(), value)
        if isinstance(check, Relationship):
            value = F.col(check.parent_column)
            add(check.parent, number, value.isNotNull(), value, parent=True)
    return found


def report(checks: Iterable[Check], tables: Mapping[str, DataFrame]) -> DataFrame:
    """Failures per check. Repeated and orphaned values count once each.

    Every table is read once, whatever checks look at it, and all values meet in one aggregation,
    of which each task first reduces its own rows.
    """
    checks = list(checks)
    rows = _inlined(_findings(checks), tables)
    values = rows.groupBy("number", "high", "low").agg(
        F.sum("child").alias("child"), F.sum("parent").alias("parent")
    )

    def numbers(kind: type) -> Column:
        return F.col("number").isin([k for k, c in enumerate(checks) if isinstance(c, kind)])

    failures = (
        F.when(numbers(Unique), (F.col("child") > 1).cast("bigint"))
        .when(numbers(Relationship), ((F.col("child") > 0) & (F.col("parent") == 0)).cast("bigint"))
        .otherwise(F.col("child"))
    )
    counted = values.groupBy("number").agg(F.sum(failures).alias("failures"))
    names = F.array(
        *[
            F.struct(F.lit(k).alias("number"), *_names(c)) for k, c in enumerate(checks)
        ]
    )
    listed = rows.sparkSession.range(1).select(F.inline(names))
    return listed.join(counted, "number", "left").select(
        "model", "column_name", "test", F.coalesce("failures", F.lit(0).cast("bigint")).alias("failures")
    )
