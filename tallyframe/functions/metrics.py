"""Aggregate and ratio expressions shared by all reports.

Arguments are column names or SQL expressions, and each measure is parsed as one expression: a wide
report has about a hundred of them, and composing every one from column calls would take longer to plan
than a small report takes to run.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyframe.functions.sqltext import literal, name


def guarded_ratio(numerator: str, denominator: str) -> Column:
    """Quotient as a double; NULL where the denominator is zero or NULL, also under ANSI mode."""
    return F.expr(f"try_divide({numerator}, {denominator})")


def average(total: str, count: str, scale: int = 1) -> Column:
    return F.expr(f"round(try_divide({total}, {count}), {scale})")


def percent(part: str, whole: str, scale: int = 0) -> Column:
    """Percentage rounded half up; NULL where ``whole`` is zero or NULL."""
    return F.expr(f"round(try_divide({part}, {whole}) * 100, {scale})")


def differs_or_null(column: str, value: str) -> Column:
    """``column != value OR column IS NULL``."""
    return ~F.col(column).eqNullSafe(F.lit(value))


def status_counts(status: str, names: Mapping[str, str]) -> list[Column]:
    """One conditional count per status code, named by ``names`` (code -> output column)."""
    return [F.expr(f"count_if({status} = {literal(code)}) AS {name(out)}") for code, out in names.items()]


def status_indicators(status: str, names: Mapping[str, str]) -> dict[str, Column]:
    """0/1 columns per status code, for ``DataFrame.withColumns``."""
    return {out: F.when(F.col(status) == code, 1).otherwise(0) for code, out in names.items()}


def wide_distribution(value: str, values: Iterable[int], pattern: str, when: str = "true") -> list[Column]:
    """One count per listed value (a column each, 0 where unseen); ``pattern`` holds ``{}`` for the value."""
    return [F.expr(f"count_if(({when}) AND {value} = {v}) AS {name(pattern.format(v))}") for v in values]


def wide_percents(values: Iterable[int], count: str, whole: str, pattern: str, scale: int = 0) -> list[Column]:
    """Percentages of ``whole`` for the columns that :func:`wide_distribution` made with ``count``."""
    return [
        F.expr(f"round(try_divide({name(count.format(v))}, {whole}) * 100, {scale}) AS {name(pattern.format(v))}")
        for v in values
    ]


def summed(names: Iterable[str]) -> list[Column]:
    """Second-level aggregates: partial counts and totals add up under the same name."""
    return [F.expr(f"sum({name(n)}) AS {name(n)}") for n in names]


def distinct_count(column: str) -> Column:
    """Exact number of distinct values, NULLs left out, as a set that merges like a sum.

    COUNT(DISTINCT) beside other measures groups by the keys and the column first, with all the measures, and shuffles
    these rows, then groups again. A set is part of the same aggregate as the measures, is put together
    in the tasks, and one row per group and task is shuffled. A group holds its distinct values in memory while it
    is merged: for columns of which there are so few values that this is little, such as schools.
    """
    return F.size(F.collect_set(column)).cast("long")
