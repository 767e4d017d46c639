import random

import pytest

from tallyframe.plans.reports import REPORTS, build_report
from tallyframe.sources.bronze import Bronze
from tallyframe.sources.schemas import BRONZE
from tests import brute
from tests.conftest import plan, rows

WIDTHS = {
    "national_pupil": 33,
    "regional_la_pupil": 36,
    "national_school": 27,
    "national_cumulative": 11,
    "national_school_scores": 69,
    "national_pupil_scores": 75,
    "regional_la_pupil_scores": 78,
}


def random_tables(seed, pupils=260):
    """Small tables with every awkward case: duplicates, missing rows, NULL and unknown codes, odd marks."""
    rnd = random.Random(seed)
    pick = rnd.choice
    years = ["202223", "202324"]
    schools = [f"S{i}" for i in range(6)]
    areas = ["E1", "E2", "E3"]
    t = {name: [] for name in BRONZE}
    for a in areas:
        for level in ("NATIONAL", "NAT", "REGIONAL", "LOCAL_AUTHORITY"):
            if level == "NAT" and a != "E2":
                continue  # E2 has two national rows, which counts its pupils twice
            row = {
                "la_new": a, "la_old": a[-1], "la_name_full": "Area " + a, "gor_code": "R1", "gor_name": "Region",
                "country_cd": "E9", "country_nm": "England", "geographic_lvl": level,
            }
            t["geography"] += [row] * (2 if (a, level) == ("E3", "REGIONAL") else 1)
    for s in schools[:5]:  # the last school is unknown to the school table
        t["school"].append(
            {
                "school_id": s, "country_code": "E9", "country_name": "England",
                "estab_type_group": pick(["AC", "ACADEMY_CONV", "QQ", None]),
                "phase_of_education": pick(["PRI", "JUN"]), "religious_character": pick(["CE", None]),
                "gender": pick(["M", "MIXED", None]),
            }
        )
    t["school"].append(dict(t["school"][0]))
    t["school"].append(dict(t["school"][1], religious_character="RC"))
    for i in range(pupils):
        for y in years:
            key = {"pupil_id": f"P{i}", "acad_year_code": y}
            t["pupil"].append(
                {
                    **key, "school_id": schools[0] if i % 3 == 0 else pick(schools),
                    "estab_type_group": pick(["AC", "Academy converter", None]),
                    "la_code_new": pick([*areas, "E404"]), "gender": pick(["M", "1", "F", None]),
                    "ethnic_major_group": pick(["W", "WHITE"]), "ethnic_minor_group": pick(["WBRI", "ZZZZ"]),
                    "first_lang": "E", "birth_month_code": pick(["9", "09"]), "sen_prov_code": pick(["N", "NONE"]),
                    "sen_type_rank": pick(["BESD", "SEMH", None]),
                }
            )
            for _ in range(pick([0, 1, 1, 1, 1, 2])):
                status = pick(["C", "C", "C", "A", "U", "W", "J", "M", "X", None])
                mark = pick([*range(26), 30, None]) if status in ("C", "W") else None
                t["results"].append(
                    {**key, "school_id": "other", "pupil_mark": mark, "completion_status": status}
                )
            for _ in range(pick([0, 1, 1, 1, 1, 2])):
                t["claimcare"].append(
                    {**key, "claim_type": pick(["1", "Y", "0", None]), "fsm_claim_flag": pick(["N", "0"])}
                )
    return t


def as_bronze(spark, tables):
    return Bronze(
        **{
            name: spark.createDataFrame(
                [tuple(row.get(f.name) for f in schema.fields) for row in tables[name]], schema
            )
            for name, schema in BRONZE.items()
        }
    )


@pytest.fixture(scope="module")
def tables():
    return random_tables(7)


@pytest.fixture(scope="module")
def bronze(spark, tables):
    return as_bronze(spark, tables)


@pytest.mark.parametrize("name", REPORTS)
def test_report_matches_brute_force(bronze, tables, name):
    df = build_report(name, bronze)
    assert tuple(df.columns) == REPORTS[name].columns and len(df.columns) == WIDTHS[name]
    assert df.dtypes == [(f.name, f.dataType.simpleString()) for f in REPORTS[name].schema.fields]
    got = rows(df)
    assert got == brute.report(name, tables)
    assert len(got) >= 10


@pytest.mark.parametrize("name", ["national_pupil", "regional_la_pupil_scores", "national_school"])
def test_left_variant_matches_brute_force(bronze, tables, name):
    assert rows(build_report(name, bronze, how="left")) == brute.report(name, tables, how="left")


def test_cumulative_can_keep_null_groups(bronze, tables):
    df = build_report("national_cumulative", bronze, drop_null_groups=False)
    assert rows(df) == brute.report("national_cumulative", tables, drop_null_groups=False)
    assert df.filter("establishment_type_group IS NULL").count() > 0


@pytest.mark.parametrize(
    "name, filters",
    [
        ("national_pupil", {"sex": "Girls", "disadvantage_status": "Disadvantaged"}),
        ("national_pupil", {"sex": "Total", "ethnicity_minor": "ZZZZ", "country_name": "England"}),
        ("national_pupil", {"establishment_type_group": "Academy converter", "time_period": "202324"}),
        ("regional_la_pupil", {"la_name": "Area E3", "geographic_level": "Regional", "sex": "Boys"}),
        ("national_school", {"sex": "Total", "geographic_level": "National", "education_phase": "Highest statutory age 7"}),
        ("national_cumulative", {"sex": "Boys", "time_identifier": "Academic year"}),
    ],
)
@pytest.mark.parametrize("how", ["inner", "left"])
def test_filters_keep_exactly_the_matching_rows(bronze, tables, name, filters, how):
    columns = REPORTS[name].columns
    expected = [
        r for r in brute.report(name, tables, how) if all(r[columns.index(d)] == v for d, v in filters.items())
    ]
    assert expected
    assert rows(build_report(name, bronze, filters=filters, how=how)) == expected


def test_unknown_filter_and_period(bronze):
    with pytest.raises(ValueError, match="no dimension"):
        build_report("national_school", bronze, filters={"fsm_status": "x"})
    years = {r.time_period for r in build_report("national_school", bronze, periods="202223").collect()}
    assert years == {"202223"}


def test_order(bronze):
    got = [tuple(r) for r in build_report("national_cumulative", bronze, ordered=True).collect()]
    i = REPORTS["national_cumulative"].columns.index
    key = [(r[0], r[i("establishment_type_group")], r[i("sex")], -1 if r[i("mtc_score")] is None else r[i("mtc_score")]) for r in got]
    assert key == sorted(key, key=lambda k: (k[0], k[1], k[2], -k[3]))
    got = build_report("regional_la_pupil", bronze, ordered=True).select("time_period", "region_name", "la_name", "sex").collect()
    assert got == sorted(got)


def test_invariants(bronze):
    wide = build_report("national_pupil_scores", bronze)
    total = "+".join(f"mtc_score_{s}_pupil_count" for s in range(26))
    assert wide.filter("completed_check_pupil_count + not_completed_check_pupil_count <> eligible_pupil_count").isEmpty()
    assert wide.filter(f"{total} > completed_check_pupil_count").isEmpty()
    running = build_report("national_cumulative", bronze)
    assert running.filter("mtc_score = 0").count() > 0
    assert running.filter("cumulative_pupil_count < pupil_count OR cumulative_pupil_percent > 100").isEmpty()


@pytest.mark.parametrize("name", REPORTS)
def test_no_python_runs_in_a_report(bronze, name):
    text = plan(build_report(name, bronze))
    assert "Python" not in text and "Pandas" not in text and "CartesianProduct" not in text


def test_school_facts_are_grouped_before_the_school_join(bronze):
    text = plan(build_report("national_school", bronze))
    lines = text.splitlines()
    join = next(i for i, line in enumerate(lines) if "Join" in line and "school_id" in line)
    below = "\n".join(lines[join:])
    assert "HashAggregate" in below and "count_if" not in below.splitlines()[0]


def test_two_counted_aggregates_share_groups(bronze):
    a = build_report("national_school", bronze)
    b = build_report("national_school_scores", bronze)
    shared = ["time_period", "sex", "education_phase", "establishment_count", "eligible_pupil_count", "mtc_score_average"]
    assert rows(a.select(shared)) == rows(b.select(shared))


def test_area_and_school_filters_reach_the_pupils(spark, tmp_path):
    from tallyframe.sources.bronze import bronze_from_parquet, write_bronze_parquet

    write_bronze_parquet(as_bronze(spark, random_tables(3)), str(tmp_path))
    bronze = bronze_from_parquet(spark, str(tmp_path))
    for name, filters in (
        ("regional_la_pupil_scores", {"region_name": "North"}),
        ("national_school", {"education_phase": "Primary"}),
    ):
        text = plan(build_report(name, bronze, filters=filters))
        # the other scans with a pupil read a mark or a claim
        scans = [line for line in text.splitlines() if "Scan parquet [pupil_id" in line]
        scan = next(line for line in scans if "pupil_mark" not in line and "claim" not in line)
        assert "LeftSemi" in text and text.index("LeftSemi") < text.index(scan)
        # the semi-join is the first join above the pupil scan
        above = text[: text.index(scan)].splitlines()
        assert "LeftSemi" in next(line for line in reversed(above) if "Join" in line), text
        assert rows(build_report(name, bronze, filters=filters)) == rows(
            build_report(name, bronze).filter(f"{next(iter(filters))} = '{next(iter(filters.values()))}'")
        )


def test_every_generated_method_is_small_enough_to_be_compiled(spark):
    """The JVM interprets methods of more than 8,000 bytes for ever."""
    bronze = as_bronze(spark, random_tables(3))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # adaptive plans have no code before they run
    try:
        for name in REPORTS:
            for options in ({}, {"default": "Total"}, {"how": "left"}):
                stages = build_report(name, bronze, **options)._jdf.queryExecution().debug().codegenToSeq()
                sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
                assert sizes and 0 < max(sizes) < 8000, (name, options, sizes)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
