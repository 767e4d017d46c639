"""Long and cumulative value distributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions.metrics import percent
from tallyframe.operators.shape import all_of


def frequencies(df: DataFrame, keys: Sequence[str], count: str, of: str | Column = "*") -> DataFrame:
    """One row per observed combination of ``keys`` with its count."""
    return df.groupBy(*keys).agg(F.count(of).alias(count))


def group_totals(df: DataFrame, keys: Sequence[str], count: str, total: str) -> DataFrame:
    """Second-level aggregate: sum of counts per group."""
    return df.groupBy(*keys).agg(F.sum(count).alias(total))


def cumulative(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    count: str,
    cumulative_count: str,
    cumulative_percent: str | None = None,
    descending: bool = True,
    drop_null_groups: bool = False,
) -> DataFrame:
    """Running count over ``value`` within each group, with its percentage of the group total.

    ``df`` holds counts, so a group has at most one row per distinct value and the window stays small
    however many records were counted. Running sum and total use the same partitioning: one exchange
    feeds both. With ``drop_null_groups`` groups that have a NULL key are left out, as an inner join of
    the counts with their totals on ``by`` would do.
    """
    if drop_null_groups:
        df = df.filter(all_of(F.col(c).isNotNull() for c in by))
    group = Window.partitionBy(*by)
    order = F.col(value).desc() if descending else F.col(value).asc()
    running = group.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    result = df.withColumn(cumulative_count, F.sum(count).over(running))
    if cumulative_percent is None:
        return result
    return (
        result.withColumn("__total", F.sum(count).over(group))
        .withColumn(cumulative_percent, percent(cumulative_count, "__total"))
        .drop("__total")
    )
