"""A pupil's codes are one number while the facts are shuffled and joined."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from tallyframe.functions.codes import STANDARD_CODES
from tallyframe.functions.packing import OTHERS, PACKED, pack, packable, unpack
from tallyframe.plans.reports import CLAIMED_COLUMNS, FAMILIES, build_report, scored_pupils, with_numbered_claims
from tests.conftest import plan, rows
from tests.test_reports import as_bronze, random_tables


def test_packed_codes_come_back_as_they_were(spark):
    columns = [c for c in CLAIMED_COLUMNS if c in STANDARD_CODES]
    values = [[*STANDARD_CODES[c], "", " M", "m", "no code's", "\\", None] for c in columns]
    given = [(str(i), *[v[(i * (k + 1) + k) % len(v)] for k, v in enumerate(values)]) for i in range(500)]
    given += [("none", *[None] * len(columns)), ("other", *["?"] * len(columns)), ("last", *[v[-7] for v in values])]
    df = spark.createDataFrame(given, "id string, " + ", ".join(f"{c} string" for c in columns))
    assert packable(df, df.columns) == columns
    packed = pack(df, columns)
    assert packed.columns == ["id", PACKED, OTHERS]
    assert rows(unpack(packed, columns).select(df.columns)) == rows(df)
    known = packed.filter("id IN ('none', 'last')")
    assert known.filter(F.col(OTHERS).isNull()).count() == 2
    # only what is in no list is carried beside the number
    one = df.limit(1).select("id", *[F.lit("x" if c == "sex" else None).cast("string").alias(c) for c in columns])
    assert pack(one, columns).first()[OTHERS] == ["x"]


def test_other_types_and_few_columns_are_left_alone(spark):
    df = spark.createDataFrame([(1, "F", "A")], "sex int, ethnicity_major string, sen_provision string")
    assert packable(df, df.columns) == []
    assert pack(df, []).columns == unpack(df, []).columns == df.columns


def test_pupils_are_shuffled_with_their_codes_as_one_number(spark):
    bronze = as_bronze(spark, random_tables(5, pupils=20))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for how in ("inner", "left"):
            query = build_report("national_pupil", bronze, how=how)._jdf.queryExecution()
            text = spark._jvm.PythonSQLUtils.explainString(query, "formatted")
            moved = re.findall(r"\) Exchange\nInput \[\d+\]: \[([^\]]*)\]\nArguments: hashpartitioning\(pupil_id", text)
            pupils = [re.sub(r"#\d+L?", "", m).split(", ") for m in moved if "school_id" in m]
            assert len(pupils) == 1, text
            key = ["pupil_id", "time_period", "school_id", "new_la_code"]
            assert sorted(pupils[0]) == sorted([*key, PACKED, OTHERS])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_regional_reports_read_no_columns_that_they_do_not_group_by():
    assert not {"month_of_birth", "sen_primary_need"} & set(FAMILIES["regional_pupil"].fact_columns)


def test_unpacking_between_two_joins_moves_no_rows(spark):
    bronze = as_bronze(spark, random_tables(5, pupils=20))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(with_numbered_claims(scored_pupils(bronze, *CLAIMED_COLUMNS), bronze))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert PACKED in text and text.count("hashpartitioning(") == 3
