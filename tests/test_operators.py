import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.operators.distribution import cumulative, frequencies, group_totals
from tallyframe.operators.periods import (
    as_periods,
    compare_periods,
    distinct_periods,
    last_periods,
    only_periods,
    period_range,
    union_periods,
)
from tallyframe.operators.shape import (
    all_of,
    rename,
    renamed_select,
    round_columns,
    select_fixed,
    with_constants,
    with_percent,
    with_time,
)
from tests.conftest import plan, rows


def test_rename_ignores_absent_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rename(df, {"a": "x", "zz": "y"}).columns == ["x", "b"]
    assert renamed_select(df, {"a": "x", "zz": "b"}, ["b", "x"]).columns == ["b", "x"]


def test_select_fixed_types_missing_columns(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    out = select_fixed(df, {"s": "string", "absent": "string", "n": T.LongType(), "d": "double"})
    assert out.dtypes == [("s", "string"), ("absent", "string"), ("n", "bigint"), ("d", "double")]
    out.write.option("header", True).csv(str(tmp_path / "csv"))  # a void column could not be written
    assert rows(out) == [("a", None, 1, None)]


def test_constants_rounding_and_conditions(spark):
    df = spark.createDataFrame([(1.25, 2)], "x double, n int")
    assert with_time(df, "202122").first().asDict()["time_identifier"] == "Academic year"
    assert with_constants(df, n=5).first()["n"] == 5
    assert round_columns(df, ["x", "absent"]).first()["x"] == 1.3
    assert with_percent(df, "n", "n", "p").first()["p"] == 100.0
    assert df.filter(all_of([])).count() == 1
    assert df.filter(all_of([F.col("n") == 2, F.col("x") > 2])).count() == 0


def test_cumulative_counts_down_and_keeps_or_drops_null_groups(spark):
    data = [("a", 3, 1), ("a", 1, 2), ("a", None, 1), (None, 2, 5)]
    df = spark.createDataFrame(data, "k string, v int, n bigint")
    out = cumulative(df, ["k"], "v", "n", "c", "p")
    assert rows(out) == sorted(
        [("a", 3, 1, 1, 25.0), ("a", 1, 2, 3, 75.0), ("a", None, 1, 4, 100.0), (None, 2, 5, 5, 100.0)], key=repr
    )
    assert cumulative(df, ["k"], "v", "n", "c", drop_null_groups=True).count() == 3
    up = cumulative(df.filter("v IS NOT NULL"), ["k"], "v", "n", "c", descending=False)
    assert rows(up.filter("k = 'a'").select("v", "c")) == [(1, 2), (3, 3)]


def test_cumulative_needs_one_exchange(spark):
    df = spark.createDataFrame([("a", 3, 1)], "k string, v int, n bigint")
    assert plan(cumulative(df, ["k"], "v", "n", "c", "p")).count("Exchange") == 1


def test_frequencies_and_totals(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", None)], "k string, v int")
    counts = frequencies(df, ["k", "v"], "n")
    assert rows(counts) == sorted([("a", 1, 2), ("a", 2, 1), ("b", None, 1)], key=repr)
    assert rows(group_totals(counts, ["k"], "n", "t")) == [("a", 3), ("b", 1)]


@pytest.fixture
def years(spark):
    data = [("202122", 1), ("202223", 2), ("202324", 3), ("202324", 4), (None, 5)]
    return spark.createDataFrame(data, "time_period string, n int")


def test_period_selection(years):
    assert rows(distinct_periods(years)) == [("202122",), ("202223",), ("202324",)]
    assert rows(last_periods(years).select("n")) == [(3,), (4,)]
    assert rows(last_periods(years, 2).select("n")) == [(2,), (3,), (4,)]
    assert rows(period_range(years, "202122", "202223").select("n")) == [(1,), (2,)]
    assert only_periods(years, None).count() == 5
    assert only_periods(years, "202122").count() == 1
    assert only_periods(years, iter(["202122", "202324"])).count() == 3


def test_union_is_by_name(spark):
    def build(p):
        df = spark.createDataFrame([(p, 1)], "time_period string, n int")
        return df if p == "a" else df.select("n", "time_period")

    assert rows(union_periods(build, ["a", "b"])) == [("a", 1), ("b", 1)]


def test_compare_periods_pairs_null_dims_and_keeps_one_sided_groups(spark):
    data = [
        ("a", None, 10), ("b", None, 12),
        ("a", "x", 0), ("b", "x", 5),
        ("a", "gone", 3), ("b", "new", 4), ("c", "x", 99),
    ]
    df = spark.createDataFrame(data, "time_period string, d string, m bigint")
    assert rows(compare_periods(df, ["d"], ["m"], "a", "b")) == sorted(
        [
            (None, 10, 12, 2, 20.0),
            ("x", 0, 5, 5, None),
            ("gone", 3, None, None, None),
            ("new", None, 4, None, None),
        ],
        key=repr,
    )


def test_periods():
    assert as_periods(None) is None and as_periods("202324") == ["202324"]
    assert as_periods({"202425", "202324"}) == ["202324", "202425"]
    for wrong in ("2023", ["202324", "2"], ["2023-24"]):
        with pytest.raises(ValueError):
            as_periods(wrong)


def test_compare_periods_fails_on_repeated_rows(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "x", 9), ("b", "x", 2)], "time_period string, d string, m bigint")
    with pytest.raises(Exception, match="more than one row of period a"):
        compare_periods(df, ["d"], ["m"], "a", "b").collect()


def test_partition_sizing():
    from tallyframe.session import initial_partitions

    assert initial_partitions(0) == 200
    assert initial_partitions(1 << 40) == 8192
    assert initial_partitions(100 << 40) == 819_200


def test_scanned_parts():
    from tallyframe.session import scan_bytes

    assert scan_bytes(0) == scan_bytes(100 << 30) == 16 << 20
    assert scan_bytes(3 << 40) == -(-(3 << 40) // 50_000)
    assert scan_bytes(100 << 40) == 128 << 20
