import glob
import os

import pytest

from tallyframe.plans.reports import FACT_KEY, FAMILIES, REPORTS, build_report, claimed_pupils, scored_pupils
from tallyframe.plans.run import all_reports, write_all_csv, write_all_tables
from tallyframe.sources.staging import Stage
from tests.conftest import plan, rows
from tests.test_reports import as_bronze, random_tables


@pytest.fixture(scope="module")
def bronze(spark):
    return as_bronze(spark, random_tables(11, pupils=60))


def test_shared_run_gives_the_separate_reports(spark, bronze):
    assert bronze.periods() == ["202223", "202324"]
    for name, df in all_reports(spark, bronze).items():
        assert rows(df) == rows(build_report(name, bronze)), name
        assert "Join" not in plan(df) and "Aggregate" not in plan(df)


def test_shared_run_of_one_year_with_left_joins(spark, bronze):
    for name, df in all_reports(spark, bronze, ["202324"], how="left").items():
        assert rows(df) == rows(build_report(name, bronze, periods="202324", how="left")), name


def test_csv_run(spark, bronze, tmp_path):
    paths = write_all_csv(spark, bronze, str(tmp_path), parts={"national_school": 1})
    assert sorted(map(os.path.basename, paths.values())) == sorted(os.listdir(tmp_path))
    assert os.path.basename(paths["national_pupil"]) == "mtc_national_pupil_characteristics_2023_to_2024"
    assert len(glob.glob(paths["national_school"] + "/part-*")) == 1
    for name, path in paths.items():
        report = build_report(name, bronze)
        # empty strings and NULLs look alike in CSV; the reports hold no empty strings
        back = spark.read.option("header", True).schema(report.schema).csv(path)
        assert back.columns == report.columns and rows(back) == rows(report), name
    text = open(glob.glob(paths["national_school"] + "/part-*")[0]).read().splitlines()
    assert text[0] == ",".join(REPORTS["national_school"].columns)


def test_one_year_as_a_string(spark, bronze):
    for name, df in all_reports(spark, bronze, "202324").items():
        assert rows(df) == rows(build_report(name, bronze, periods="202324")), name
    with pytest.raises(ValueError):
        all_reports(spark, bronze, "2023")


def test_staged_tables_are_removed(spark, bronze, tmp_path):
    from tallyframe.sources.staging import staging_root

    root = staging_root(spark).removeprefix("file:")
    before = set(os.listdir(root))
    write_all_csv(spark, bronze, str(tmp_path), "202223")
    assert set(os.listdir(root)) == before


def test_fact_rows_are_staged_once(spark, bronze):
    with Stage(spark) as stage:
        all_reports(spark, bronze, stage=stage)
        stored = sorted(os.listdir(stage.path.removeprefix("file:")))
        assert stored == sorted(["facts", "geography", *FAMILIES])
        facts = spark.read.parquet(f"{stage.path}/facts")
        assert rows(facts.filter("__claim IS NOT NULL").select(*FACT_KEY)) == rows(claimed_pupils(bronze).select(*FACT_KEY))
        assert rows(facts.filter("__claim IS NULL OR __claim = 1").select(*FACT_KEY)) == rows(scored_pupils(bronze).select(*FACT_KEY))


def test_default_label_for_the_whole_run(spark, bronze):
    for name, df in all_reports(spark, bronze, default="Total").items():
        assert rows(df) == rows(build_report(name, bronze, default="Total")), name


def test_table_run(spark, bronze):
    spark.sql("CREATE DATABASE IF NOT EXISTS gold")
    written = write_all_tables(spark, bronze, schema="gold", periods=["202223"])
    assert len(written) == 7 and "mtc_national_school_characteristics" in written
    got = spark.table("gold.mtc_national_school_characteristics")
    assert rows(got) == rows(build_report("national_school", bronze, periods="202223"))


def test_sets_are_hashed_in_sessions_made_elsewhere(spark, bronze):
    setting = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
    before = spark.conf.get(setting)
    try:
        for given, used in (("128", "20000"), ("500", "500")):
            spark.conf.set(setting, given)
            build_report("national_pupil", bronze)
            assert spark.conf.get(setting) == used
    finally:
        spark.conf.set(setting, before)


def test_parts_are_small_in_sessions_made_elsewhere(spark, bronze):
    settings = {
        "spark.sql.files.maxPartitionBytes": ("134217728b", "16m", "32m"),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": ("67108864b", "16m", "8m"),
    }
    for setting, (default, used, chosen) in settings.items():
        before = spark.conf.get(setting)
        try:
            for given, kept in ((default, used), (chosen, chosen)):
                spark.conf.set(setting, given)
                build_report("national_school_scores", bronze)
                assert spark.conf.get(setting) == kept
        finally:
            spark.conf.set(setting, before)


def test_parts_are_small_before_the_facts_are_staged(spark, bronze, monkeypatch):
    setting, seen, write = "spark.sql.files.maxPartitionBytes", [], Stage.tables

    def noted(stage, frames):
        seen.append((sorted(frames), spark.conf.get(setting)))
        return write(stage, frames)

    monkeypatch.setattr(Stage, "tables", noted)
    before = spark.conf.get(setting)
    try:
        spark.conf.set(setting, "134217728b")
        all_reports(spark, bronze)
    finally:
        spark.conf.set(setting, before)
    assert seen[0] == (["facts", "geography"], "16m")
