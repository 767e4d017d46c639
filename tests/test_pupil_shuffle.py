"""Facts are dealt by the pupil alone, once each."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tallyframe.plans.reports import scored_pupils, with_numbered_claims
from tallyframe.sources.bronze import Bronze
from tests.conftest import plan, rows


@pytest.fixture
def bronze(spark):
    key = "pupil_id string, acad_year_code string"
    pupil = spark.createDataFrame([("p", "1", "s"), ("p", "2", "s"), ("p", None, "s"), (None, "1", "s"), ("q", "1", "t")], f"{key}, school_id string")
    results = spark.createDataFrame([("p", "1", 3), ("p", "2", 4), ("p", "3", 5), (None, "1", 6), ("p", None, 7)], f"{key}, pupil_mark int")
    results = results.withColumn("completion_status", F.lit("C"))
    claims = spark.createDataFrame(
        [("p", "1", "1"), ("p", "2", "0"), ("p", "2", "1"), ("p", "2", "1"), ("q", "1", "1")], f"{key}, claim_type string"
    ).withColumn("fsm_claim_flag", F.lit("Y"))
    return Bronze(pupil=pupil, results=results, claimcare=claims, school=None, geography=None)


def test_claims_are_numbered_by_pupil_and_year(bronze):
    found = with_numbered_claims(scored_pupils(bronze, "school_id"), bronze)
    kept = rows(found.select("pupil_id", "time_period", "mtc_score", "__claim"))
    assert kept == [("p", "1", 3, 1), ("p", "2", 4, 1), ("p", "2", 4, 2), ("p", "2", 4, 3)]
    left = with_numbered_claims(scored_pupils(bronze, "school_id", how="left"), bronze).filter("mtc_score IS NULL")
    assert rows(left.select("pupil_id", "time_period", "__claim")) == sorted(
        [("p", None, None), (None, "1", None), ("q", "1", 1)], key=repr
    )


def test_three_shuffles_by_pupil(spark, bronze):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(with_numbered_claims(scored_pupils(bronze, "school_id"), bronze))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    dealt = re.findall(r"hashpartitioning\(([^)]*)\)", text)
    assert len(dealt) == 3 and all(re.fullmatch(r"_*pupil_id#\d+, \d+", keys) for keys in dealt)
