import itertools

import pytest
from pyspark.sql import functions as F

from tallyframe.functions.codes import (
    BASE_CODES,
    COMPLETION_STATUS,
    DEFAULT_LABELS,
    FURTHER_CODES,
    STANDARD_CODES,
)
from tallyframe.functions.decode import (
    PASSTHROUGH,
    canonical_code,
    decode,
    decode_columns,
    decode_with_lookup,
    label_predicate,
)
from tests.conftest import plan, rows

CODE_COUNTS = {
    "sex": 8,
    "ethnicity_major": 16,
    "ethnicity_minor": 29,
    "first_language": 8,
    "fsm_status": 8,
    "disadvantage_status": 9,
    "month_of_birth": 23,
    "sen_provision": 12,
    "sen_primary_need": 17,
    "establishment_type_group": 17,
    "education_phase": 10,
    "school_religious_character": 19,
    "geographic_level": 7,
}


def reference(value, mapping, default):
    return mapping.get(value, value if default is PASSTHROUGH else default)


def values_of(column):
    codes = STANDARD_CODES[column]
    return [*codes, *codes.values(), "no such code", "", "o'clock", "back\\slash", None]


def policies():
    return [(c, d) for c in STANDARD_CODES for d in (DEFAULT_LABELS.get(c, PASSTHROUGH), "Total", "elsewhere")]


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "code string")


def test_code_tables_are_complete():
    assert {c: len(codes) for c, codes in BASE_CODES.items()} == CODE_COUNTS
    assert len(COMPLETION_STATUS) == 6
    assert sum(map(len, FURTHER_CODES.values())) == 6
    for column, further in FURTHER_CODES.items():
        assert not set(further) & set(BASE_CODES[column])


def test_decode_canonical_and_predicate_agree_with_the_dictionaries(spark):
    for column in STANDARD_CODES:
        mapping = STANDARD_CODES[column]
        values = values_of(column)
        df = frame(spark, values)
        for default in (DEFAULT_LABELS.get(column, PASSTHROUGH), "Total", "elsewhere"):
            wanted = ["Total", "Boys", "Unknown", "no such code", "elsewhere"]
            canonical = canonical_code("code", mapping, default)
            got = df.select(
                "code",
                decode("code", mapping, default).alias("label"),
                decode(canonical, mapping, default).alias("late"),
                canonical.alias("canonical"),
                label_predicate("code", wanted, mapping, default).alias("hit"),
            ).collect()
            by_label = {}
            for r in got:
                label = reference(r.code, mapping, default)
                assert r.label == label and r.late == label, (column, r)
                assert bool(r.hit) == (label in wanted), (column, r)
                by_label.setdefault(label, set()).add(r.canonical)
            # grouping by the canonical code is grouping by the label
            assert all(len(c) == 1 for c in by_label.values())
            assert len(set().union(*by_label.values())) == len(by_label)


def test_passthrough_decoding_is_idempotent(spark):
    for column, mapping in STANDARD_CODES.items():
        if column == "first_language" or column in DEFAULT_LABELS:
            continue
        labels = frame(spark, sorted(set(mapping.values()) - set(mapping)))
        assert rows(labels.select(decode("code", mapping))) == rows(labels)


def test_empty_mapping(spark):
    df = frame(spark, ["a", None])
    assert rows(df.select(decode("code", {}))) == [("a",), (None,)]
    assert rows(df.select(decode("code", {}, "Total"))) == [("Total",), ("Total",)]


def test_quotes_and_backslashes_survive(spark):
    mapping = {"it's": "label's \\ end", "a\\b": 'say "x"'}
    df = frame(spark, [*mapping, "other"])
    assert rows(df.select(decode("code", mapping))) == sorted([("label's \\ end",), ('say "x"',), ("other",)])


def test_decode_columns_skips_absent_and_unknown_columns(spark):
    df = spark.createDataFrame([("M", "keep")], "sex string, other string")
    assert rows(decode_columns(df)) == [("Boys", "keep")]
    assert rows(decode_columns(df, ["first_language"])) == [("M", "keep")]


def test_decode_with_lookup_never_multiplies_rows(spark):
    df = frame(spark, ["a", "a", "b", None])
    lookup = spark.createDataFrame(
        [("code", "a", "A1"), ("code", "a", "A2"), ("code", None, "nothing"), ("else", "b", "B")],
        "column string, code string, label string",
    )
    assert rows(decode_with_lookup(df, "code", lookup)) == sorted([("A1",), ("A1",), ("b",), (None,)], key=repr)
    assert rows(decode_with_lookup(df, "code", lookup, "Total", output="label").select("label")) == [
        ("A1",), ("A1",), ("Total",), ("Total",),
    ]


@pytest.mark.parametrize("label, pushed", [("Girls", True), ("Total", False)])
def test_label_filter_reaches_the_scan(spark, tmp_path, label, pushed):
    path = str(tmp_path / "p")
    frame(spark, ["M", "F", None]).write.parquet(path)
    df = spark.read.parquet(path).filter(label_predicate("code", label, STANDARD_CODES["sex"], "Total"))
    text = plan(df)
    assert ("PushedFilters: [In(code" in text) or not pushed
    assert "Or(" in text or "In(code" in text
    assert df.count() == 1
