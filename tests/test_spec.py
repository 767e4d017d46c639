import pytest
from pyspark.sql import types as T

from tallyframe.plans.spec import ReportSpec, mapped_columns, profile, validate
from tests.conftest import rows


@pytest.fixture
def tables(spark):
    return {
        "people": spark.createDataFrame([(1, "a", 10), (2, "a", 20), (3, "b", None)], "id int, team string, age int"),
        "visits": spark.createDataFrame([(1, 5), (1, 7), (3, 9)], "id int, length int"),
    }


GROUPED = ReportSpec(
    base="people",
    joins={"visits": "id"},
    columns={"team": "upper(people.team)", "visits": "count(visits.id)", "longest": "max(visits.length)"},
    filters=("people.id < 4", "people.team IN ('a', 'b') OR people.team = 'c'"),
    group_by=("team",),
    order_by=("visits DESC", "team"),
)


def test_grouped_spec(tables):
    out = GROUPED.build(tables)
    assert out.columns == ["team", "visits", "longest"]
    assert [tuple(r) for r in out.collect()] == [("A", 2, 7), ("B", 1, 9)]


def test_spec_without_groups_keeps_unmatched_base_rows(tables):
    spec = ReportSpec("people", {"who": "people.id", "length": "visits.length"}, {"visits": ("id", "id")})
    assert rows(spec.build(tables)) == sorted([(1, 5), (1, 7), (2, None), (3, 9)], key=repr)


def test_spec_of_keys_only_is_distinct(tables):
    spec = ReportSpec("people", {"team": "people.team"}, group_by=("team",))
    assert rows(spec.build(tables)) == [("a",), ("b",)]


def test_filters_stay_separate_conditions(tables):
    spec = ReportSpec("people", {"id": "people.id"}, filters=("id = 1 OR id = 2", "team = 'b'"))
    assert spec.build(tables).count() == 0


def test_validation(tables):
    ok = validate(GROUPED, tables, T.StructType.fromDDL("team string, visits bigint, longest int"))
    assert ok.valid and ok.row_count == 2 and not ok.errors and not ok.warnings
    wrong = validate(GROUPED, tables, T.StructType.fromDDL("team string, visits int, missing int"))
    assert not wrong.valid
    assert wrong.errors == ("column visits is bigint, not int", "no column missing")
    assert wrong.warnings == ("column longest is not expected",)
    empty = validate(ReportSpec("people", {"id": "people.id"}, filters=("id > 9",)), tables)
    assert empty.valid and empty.warnings == ("no rows",)
    null = validate(ReportSpec("people", {"nothing": "nullif(people.id, people.id)"}), tables)
    assert null.warnings == ("column nothing is always NULL",)
    assert not validate(ReportSpec("people", {"x": "people.absent"}), tables).valid
    assert not validate(ReportSpec("people", {"x": "people.id"}, group_by=("y",)), tables).valid
    assert validate(ReportSpec("nobody", {"x": "x"}), tables).errors == ("no table nobody",)
    assert validate(ReportSpec("people", {"id": "people.id"}), tables, sample_rows=2).row_count == 2


def test_profile(tables):
    assert rows(profile(tables["people"])) == [("age", 3, 2, 1), ("id", 3, 3, 0), ("team", 3, 3, 0)]


def test_mapped_columns(spark, tables):
    mapping = spark.createDataFrame(
        [("r", "age", "years"), ("r", "id", "key"), ("r", "id", "code"), ("r", "zz", "zz"), ("q", "team", "t")],
        "report_id string, source_column string, target_column string",
    )
    assert mapped_columns(tables["people"], mapping, "r").columns == ["code", "key", "years"]
    clash = spark.createDataFrame([("r", "age", "x"), ("r", "id", "x")], mapping.schema)
    with pytest.raises(ValueError, match="one target"):
        mapped_columns(tables["people"], clash, "r")


def test_order_by_names_with_blanks(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "c")], "k int, v string")
    spec = ReportSpec(base="t", columns={"my col": "t.v", "desc": "t.k"}, order_by=("my col DESC",))
    assert [r["my col"] for r in spec.build({"t": df}).collect()] == ["c", "b", "a"]
    for order, first in (("my col", 2), ("desc", 1), ("desc desc", 3), ("my col asc", 2)):
        built = ReportSpec(base="t", columns=spec.columns, order_by=(order,)).build({"t": df})
        assert built.first()["desc"] == first
