"""A key that holds a third of all rows."""

import pytest
from pyspark.sql import functions as F

from tallyframe.plans.reports import build_report, pupil_measures, scored_pupils
from tallyframe.sources.bronze import Bronze
from tests.conftest import plan, rows

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    "spark.sql.shuffle.partitions": "100",
}
PUPILS = 20_000


@pytest.fixture
def no_broadcast(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def bronze(spark):
    ids = spark.range(0, PUPILS, 1, 8)
    key = [F.concat(F.lit("P"), "id").alias("pupil_id"), F.lit("202324").alias("acad_year_code")]
    # one school and one authority hold more than a third of the pupils
    hot = F.col("id") % 5 < 2
    pupil = ids.select(
        *key,
        F.when(hot, "S0").otherwise(F.concat(F.lit("S"), F.col("id") % 50)).alias("school_id"),
        F.when(hot, "E0").otherwise(F.concat(F.lit("E"), F.col("id") % 9)).alias("la_code_new"),
        *[F.lit(None).cast("string").alias(c) for c in (
            "estab_type_group", "ethnic_major_group", "ethnic_minor_group", "first_lang",
            "birth_month_code", "sen_prov_code", "sen_type_rank",
        )],
        F.when(F.col("id") % 2 == 0, "M").otherwise("F").alias("gender"),
    )
    results = ids.select(
        *key, (F.hash("id") % 26).cast("int").alias("pupil_mark"), F.lit("C").alias("completion_status")
    )
    claimcare = ids.select(*key, F.lit("1").alias("claim_type"), F.lit("Y").alias("fsm_claim_flag"))
    school = spark.range(50).select(
        F.concat(F.lit("S"), "id").alias("school_id"), F.lit("E9").alias("country_code"),
        F.lit("England").alias("country_name"), F.lit("AC").alias("estab_type_group"),
        F.lit("PRI").alias("phase_of_education"), F.lit("CE").alias("religious_character"), F.lit("M").alias("gender"),
    )
    geography = spark.range(9).select(
        F.concat(F.lit("E"), "id").alias("la_new"), F.lit("1").alias("la_old"), F.lit("Area").alias("la_name_full"),
        F.lit("R").alias("gor_code"), F.lit("Region").alias("gor_name"), F.lit("E9").alias("country_cd"),
        F.lit("England").alias("country_nm"), F.lit("NATIONAL").alias("geographic_lvl"),
    )
    return Bronze(pupil, school, results, claimcare, geography)


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]


def test_hot_pupil_key_is_split(spark, bronze, no_broadcast):
    hot = bronze.results.withColumn("pupil_id", F.lit("P7"))
    skewed = bronze.with_tables(results=bronze.results.unionByName(hot))
    df = scored_pupils(skewed, "school_id").groupBy("school_id").agg(*pupil_measures())
    assert "skew=true" in final_plan(df)
    assert df.agg(F.sum("eligible_pupil_count")).first()[0] == 2 * PUPILS


def test_hot_school_reaches_the_join_as_one_row(bronze, no_broadcast):
    df = build_report("national_school", bronze)
    text = final_plan(df)
    assert "skew=true" not in text
    below_join = text.split("SortMergeJoin [school_id")[1]
    assert "HashAggregate(keys=[" in below_join.split("Join [pupil_id")[0]
    assert df.collect()[0]["eligible_pupil_count"] == PUPILS


def test_hot_authority(bronze, no_broadcast):
    df = build_report("national_pupil", bronze)
    assert rows(df.groupBy().sum("eligible_pupil_count")) == [(PUPILS,)]
    assert df.agg(F.max("establishment_count")).first()[0] <= 50


def test_areas_of_unknown_size_move_no_pupils(bronze, no_broadcast):
    for filters in ({}, {"country_name": "England"}):
        for how in ("inner", "left"):
            df = build_report("national_pupil", bronze, filters=filters, how=how)
            joins = plan(df)
            assert "SortMergeJoin [new_la_code" not in joins and "SortMergeJoin [la_code_new" not in joins
            assert rows(df.groupBy().sum("eligible_pupil_count")) == [(PUPILS,)]
