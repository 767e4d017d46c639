"""Selecting, stacking and comparing periods. A period is a string code ordered as text."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.metrics import percent


def as_periods(periods: str | Iterable[str] | None) -> list[str] | None:
    """One period or several as a sorted list of distinct six-digit codes; None stays None.

    Anything else is an error, an empty list too: it would otherwise give an empty report.
    """
    if periods is None:
        return None
    found = sorted({periods} if isinstance(periods, str) else set(periods))
    if not found:
        raise ValueError("an empty list of periods; None means all")
    wrong = [p for p in found if not (isinstance(p, str) and re.fullmatch(r"[0-9]{6}", p))]
    if wrong:
        raise ValueError(f"periods are six digits, not {wrong}")
    return found


def only_periods(df: DataFrame, periods: str | Iterable[str] | None, column: str = "time_period") -> DataFrame:
    """Rows of the given periods; all rows for None. Prunes partitions when ``column`` partitions the data."""
    if periods is None:
        return df
    if isinstance(periods, str):
        return df.filter(F.col(column) == periods)
    return df.filter(F.col(column).isin(sorted(set(periods))))


def period_range(df: DataFrame, first: str, last: str, column: str = "time_period") -> DataFrame:
    return df.filter(F.col(column).between(first, last))


def distinct_periods(df: DataFrame, column: str = "time_period") -> DataFrame:
    return df.select(column).filter(F.col(column).isNotNull()).distinct()


def last_periods(
    df: DataFrame, n: int = 1, column: str = "time_period", known: Iterable[str] | None = None
) -> DataFrame:
    """Rows of the ``n`` latest periods present (the latest one by default).

    With the ``known`` periods of the table (``Bronze.periods`` lists them without reading it) the latest are a plain
    filter, so of a table stored by period only their partitions are read. Without, they are found by reading
    the column once more. That side has at most ``n`` rows whatever the data size, so broadcasting it is safe and lets
    Spark prune partitions dynamically.
    """
    if known is not None:
        return only_periods(df, sorted(set(known))[-n:] if n > 0 else [], column)
    latest = distinct_periods(df, column).orderBy(F.col(column).desc()).limit(n)
    return df.join(F.broadcast(latest), column, "left_semi")


def union_periods(build: Callable[[str], DataFrame], periods: Sequence[str]) -> DataFrame:
    """Stack per-period frames by column name.

    Reports carry the period as a group key and need no loop: call them once with all periods. This is
    for builds that can only make one period at a time.
    """
    return reduce(DataFrame.unionByName, [build(p) for p in periods])


def compare_periods(
    df: DataFrame,
    dims: Sequence[str],
    measures: Sequence[str],
    before: str,
    after: str,
    column: str = "time_period",
) -> DataFrame:
    """Measures of two periods side by side, with change and percent change.

    Expects one row per (period, dims), as a report gives, and fails where there are more. One grouping
    instead of a self-join: a single exchange, NULL dims compare equal, and groups present in only one period are
    kept with NULLs.
    """
    def of(period: str, m: str):
        value = F.max(F.when(F.col(column) == period, F.col(m)))
        more = F.raise_error(F.lit(f"more than one row of period {period} for the same {list(dims)}"))
        return F.when(F.count_if(F.col(column) == period) <= 1, value).otherwise(more.cast(df.schema[m].dataType))

    sides = [c for m in measures for c in (of(before, m).alias(f"{m}_before"), of(after, m).alias(f"{m}_after"))]
    paired = only_periods(df, [before, after], column).groupBy(*dims).agg(*sides)
    changes = []
    for m in measures:
        change = f"{m}_after - {m}_before"
        changes += [
            F.col(f"{m}_before"),
            F.col(f"{m}_after"),
            F.expr(change).alias(f"{m}_change"),
            percent(change, f"{m}_before", 1).alias(f"{m}_change_percent"),
        ]
    return paired.select(*dims, *changes)
