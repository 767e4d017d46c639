from pyspark.sql import functions as F

from tallyframe.functions.metrics import (
    average,
    differs_or_null,
    guarded_ratio,
    percent,
    status_counts,
    status_indicators,
    wide_distribution,
    wide_percents,
)
from tests.conftest import rows


def test_ratios_are_guarded_and_round_half_up(spark):
    df = spark.createDataFrame([(1, 8), (3, 8), (1, 0), (5, None), (0, 3), (1, 3)], "a bigint, b bigint")
    got = df.select(percent("a", "b"), average("a", "b"), guarded_ratio("a", "b")).collect()
    assert [tuple(r)[:2] for r in got] == [
        (13.0, 0.1), (38.0, 0.4), (None, None), (None, None), (0.0, 0.0), (33.0, 0.3),
    ]
    assert got[0][2] == 0.125


def test_status_counts_with_unknown_and_null(spark):
    df = spark.createDataFrame([("C",), ("A",), ("X",), (None,), ("C",)], "s string")
    names = {"C": "done", "A": "absent", "U": "unable"}
    got = df.agg(*status_counts("s", names), F.count_if(differs_or_null("s", "C")).alias("rest")).first()
    assert got.asDict() == {"done": 2, "absent": 1, "unable": 0, "rest": 3}
    flags = df.withColumns(status_indicators("s", {"C": "done"}))
    assert rows(flags.select("done")) == [(0,), (0,), (0,), (1,), (1,)]


def test_wide_distribution_has_zero_columns_for_unseen_values(spark):
    df = spark.createDataFrame([(1, "C"), (1, "W"), (3, "C"), (None, "C")], "v int, s string")
    counts = df.agg(
        F.count_if(F.col("s") == "C").alias("done"),
        *wide_distribution("v", [3, 2, 1], "v{}", when="s = 'C'"),
    )
    got = counts.select("*", *wide_percents([3, 2, 1], "v{}", "done", "p{}")).first().asDict()
    assert got == {"done": 3, "v3": 1, "v2": 0, "v1": 1, "p3": 33.0, "p2": 0.0, "p1": 33.0}
