"""Filters on dims whose codes travel as one number: small plans, small generated methods, the same rows."""

from __future__ import annotations

import pytest

from tallyframe.functions.codes import STANDARD_CODES
from tallyframe.plans.reports import CLAIMED_COLUMNS, build_report
from tests.conftest import rows
from tests.test_reports import as_bronze, random_tables

CODED = [c for c in CLAIMED_COLUMNS if c in STANDARD_CODES]
THREE = {"sex": "Girls", "ethnicity_major": "White", "disadvantage_status": "Disadvantaged"}


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "left"])
def test_a_filter_on_a_report_does_not_repeat_what_packs_its_codes(spark, how):
    report = build_report("national_pupil", as_bronze(spark, random_tables(5, pupils=20)), how=how)
    assert optimized(report).count("array_position(") == len(CODED)
    # with plain columns 136 after one filter and 648 after two; with a few the driver's memory is full before the query begins
    assert optimized(report.filter("sex = 'Girls'")).count("array_position(") == len(CODED)
    for dim in CODED:
        report = report.filter(f"{dim} = '{next(iter(STANDARD_CODES[dim].values()))}'")
    assert optimized(report).count("array_position(") == len(CODED)


def test_a_filter_on_a_report_comes_before_the_facts_are_joined(spark):
    report = build_report("national_pupil", as_bronze(spark, random_tables(5, pupils=20)))
    lines = optimized(report.filter("sex = 'Girls'")).splitlines()
    made = next(i for i, line in enumerate(lines) if "Generate inline" in line)
    assert "Filter" in lines[made - 1] and "Girls" in lines[made - 1]


@pytest.mark.parametrize("name", ["national_pupil", "national_pupil_scores", "regional_la_pupil_scores"])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_filters_on_raw_codes_are_not_made_again_on_packed_ones(spark, name, how):
    dims = [c for c in CODED if name.startswith("national") or c not in ("month_of_birth", "sen_primary_need")]
    filters = {c: next(iter(STANDARD_CODES[c].values())) for c in dims}
    bronze = as_bronze(spark, random_tables(3))
    text = optimized(build_report(name, bronze, filters=filters, how=how))
    above = [line for line in text.splitlines() if "Filter" in line and "__packed" in line]
    assert "Generate inline" in text and not above
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # adaptive plans have no code before they run
    try:
        stages = build_report(name, bronze, filters=filters, how=how)._jdf.queryExecution().debug().codegenToSeq()
        sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert sizes and 0 < max(sizes) < 8000, sizes


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("default", [None, "Total"])
def test_filters_before_and_after_a_report_keep_the_same_rows(spark, how, default):
    bronze = as_bronze(spark, random_tables(11, pupils=200))
    whole = build_report("national_pupil", bronze, how=how, default=default)
    found = 0
    # a label, several codes' label, a default, a value that is in no list, a code that is no label, and three at once
    for filters in ({"sex": "Girls"}, {"sex": "Total"}, {"ethnicity_minor": "ZZZZ"}, {"sex": "F"}, THREE, {"fsm_status": "Total"}):
        expected = whole.filter(" AND ".join(f"{d} = '{v}'" for d, v in filters.items()))
        got = rows(build_report("national_pupil", bronze, filters=filters, how=how, default=default))
        assert got == rows(expected), filters
        found += len(got)
    assert found
