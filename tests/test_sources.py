import glob
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyframe.plans.reports import build_report, claimed_pupils
from tallyframe.plans.silver import register_views, silver
from tallyframe.sources.bronze import (
    bronze_from_catalog,
    bronze_from_parquet,
    qualified,
    read_table,
    use_namespace,
    write_bronze_parquet,
    write_bronze_tables,
)
from tallyframe.sources.keyed import (
    absent_rows,
    insert_if_absent,
    read_snapshot,
    write_snapshot,
)
from tallyframe.sources.schemas import BRONZE
from tallyframe.sources.sinks import write_csv, write_parquet, write_table, year_suffix
from tallyframe.sources.staging import Stage, run_together, staging_root
from tests.conftest import plan, rows
from tests.test_reports import as_bronze, random_tables


@pytest.fixture(scope="module")
def bronze(spark):
    return as_bronze(spark, random_tables(3, pupils=80))


@pytest.fixture(scope="module")
def stored(spark, bronze, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("bronze"))
    write_bronze_parquet(bronze, root)
    return bronze_from_parquet(spark, root), root


def test_declared_schemas():
    assert {n: len(s) for n, s in BRONZE.items()} == {
        "pupil": 16, "school": 10, "results": 6, "claimcare": 9, "geography": 9,
    }
    required = {n: {f.name for f in s if not f.nullable} for n, s in BRONZE.items()}
    assert required["pupil"] == {"pupil_id", "acad_year_code", "school_id"}
    assert required["results"] == {"pupil_id", "school_id", "acad_year_code"}
    assert BRONZE["results"]["pupil_mark"].dataType.simpleString() == "int"
    assert all(s["load_date"].dataType.simpleString() == "date" for s in BRONZE.values())


def test_parquet_round_trip_keeps_years_as_strings(stored, bronze):
    read, root = stored
    assert sorted(glob.glob(root + "/pupil/acad_year_code=*"))
    assert not glob.glob(root + "/school/acad_year_code=*")
    for name, df in bronze.tables().items():
        back = read.tables()[name].select(df.columns)
        assert back.dtypes == df.dtypes
        assert rows(back) == rows(df)


def test_year_is_a_partition_filter_on_every_fact_scan(stored):
    text = plan(build_report("national_pupil", stored[0], periods="202324"))
    scans = [line for line in text.splitlines() if "FileScan parquet" in line]
    facts = [s for s in scans if "acad_year_code" in s]
    assert len(facts) == 3 and len(scans) == 4
    for scan in facts:
        filters = scan.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
        assert "202324" in filters
        assert "load_date" not in scan and "disadvantaged_flag" not in scan and "la_code_old" not in scan


def test_label_filters_become_scan_filters(stored):
    text = plan(build_report("national_pupil", stored[0], filters={"sex": "Girls", "fsm_status": "FSM eligible"}))
    pushed = [line.split("PushedFilters: [")[1] for line in text.splitlines() if "PushedFilters" in line]
    assert any("In(gender, [2,F,Female])" in p for p in pushed)
    assert any("fsm_claim_flag" in p for p in pushed)
    assert any("geographic_lvl" in p for p in pushed)


def test_catalog_tables_and_namespace(spark, bronze):
    spark.sql("CREATE DATABASE IF NOT EXISTS school_data")
    write_bronze_tables(bronze, schema="school_data")
    use_namespace(spark, "spark_catalog", "school_data")
    try:
        assert qualified("t", "s", "c") == "`c`.`s`.`t`"
        assert read_table(spark, "pupil").count() == bronze.pupil.count()
        report = build_report("national_school", bronze_from_catalog(spark))
        assert rows(report) == rows(build_report("national_school", bronze))
        write_table(report, "gold_school")
        write_table(report, "gold_school")
        assert rows(read_table(spark, "gold_school", "school_data", "spark_catalog")) == rows(report)
    finally:
        use_namespace(spark, schema="default")


def test_bucketed_facts_join_without_a_shuffle(spark, bronze):
    spark.sql("CREATE DATABASE IF NOT EXISTS bucketed")
    write_bronze_tables(bronze, schema="bucketed", buckets=4)
    tables = bronze_from_catalog(spark, "bucketed")
    facts = claimed_pupils(tables, "school_id")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(facts)
        assert text.count("Join") == 2 and "Exchange" not in text
        assert rows(facts) == rows(claimed_pupils(bronze, "school_id"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_tasks_that_write_buckets_dont_grow_with_the_table(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS large_buckets")
    columns = ["md5(cast(id AS STRING)) AS pupil_id", "'202324' AS acad_year_code", "md5(cast(-id AS STRING)) AS school_id"]
    pupils = spark.range(0, 40000, 1, 8).selectExpr(*columns)
    pupils = pupils.withColumns({f.name: F.lit(None).cast(f.dataType) for f in BRONZE["results"] if f.name not in pupils.columns})
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        write_bronze_tables({"results": pupils}, "large_buckets", buckets=2)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    stored = spark.table("large_buckets.results")
    per_file = stored.groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n"), F.min("pupil_id"), F.max("pupil_id"))
    # the rows have some 2.5 MB, and two tasks had half of them each
    assert max(r.n for r in per_file.collect()) < 10000
    assert rows(stored.select("pupil_id", "school_id")) == rows(pupils.select("pupil_id", "school_id"))


def test_views_from_sql(spark, bronze):
    register_views(bronze)
    got = spark.sql("SELECT sex, count(*) AS n FROM v_pupil GROUP BY sex")
    assert rows(got) == rows(silver("pupil", bronze.pupil).groupBy("sex").agg(F.count("*").alias("n")))
    assert spark.table("v_results").columns == [
        "pupil_id", "school_id", "time_period", "mtc_score", "completion_status", "completion_status_label",
    ]
    widths = {t: len(spark.table(f"v_{t}").columns) for t in BRONZE}
    assert widths == {"pupil": 14, "school": 9, "results": 6, "claimcare": 4, "geography": 8}


@pytest.mark.parametrize(
    "periods, suffix",
    [
        (["202122", "202223", "202324", "202425"], "2022_to_2025"),
        (["202425", "202122"], "2022_to_2025"),
        (["202324"], "2024_to_2024"),
        (["199900", "200001"], "2000_to_2001"),
    ],
)
def test_year_suffix(periods, suffix):
    assert year_suffix(periods) == suffix


def test_year_suffix_needs_periods():
    with pytest.raises(ValueError):
        year_suffix([])


def test_csv_parts(spark, tmp_path):
    df = spark.range(100).repartition(4)
    write_csv(df, str(tmp_path / "many"))
    write_csv(df, str(tmp_path / "one"), parts=1)
    write_csv(df, str(tmp_path / "one"), parts=1)
    assert len(glob.glob(str(tmp_path / "many/part-*"))) == 4
    assert len(glob.glob(str(tmp_path / "one/part-*"))) == 1
    assert spark.read.option("header", True).csv(str(tmp_path / "one")).count() == 100
    write_parquet(df, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 100


def test_staging_uses_the_shared_folder(spark):
    assert staging_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    stage = Stage(spark)
    table = stage.tables({"numbers": spark.range(5), "more": spark.range(9)})["numbers"]
    assert table.count() == 5 and stage.path.startswith(staging_root(spark))
    assert "Range" not in plan(table)


def test_a_failing_job_is_reported(spark):
    def fail():
        raise ValueError("no")

    with pytest.raises(ValueError):
        run_together(spark, [lambda: None, fail])
    run_together(spark, [])


def test_absent_rows(spark):
    schema = "a string, b int, c string"
    existing = spark.createDataFrame([("x", 1, "old")], schema)
    new = spark.createDataFrame(
        [("x", 1, "new"), ("x", 2, "q"), ("x", 2, "p"), (None, 1, "n"), ("y", None, "m")], schema
    )
    assert rows(absent_rows(existing, new, ["a", "b"])) == sorted(
        [("x", 2, "p"), (None, 1, "n"), ("y", None, "m")], key=repr
    )
    keys_only = absent_rows(existing.select("a"), new.select("a"), ["a"])
    assert rows(keys_only) == sorted([(None,), ("y",)], key=repr)


def test_null_keys_match(spark, tmp_path):
    new = spark.createDataFrame([(None, 1), (None, 2), ("b", 6), ("b", None)], "k string, v int")
    for _ in range(3):
        insert_if_absent(spark, str(tmp_path / "t"), new, ["k"])
    assert rows(spark.read.parquet(str(tmp_path / "t"))) == sorted([(None, 1), ("b", None)], key=repr)
    for _ in range(3):
        insert_if_absent(spark, str(tmp_path / "u"), new, ["k", "v"])
    assert rows(spark.read.parquet(str(tmp_path / "u"))) == rows(new)


def test_insert_if_absent_is_repeatable(spark, tmp_path):
    path = str(tmp_path / "table")
    first = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    for _ in range(2):
        insert_if_absent(spark, path, first, ["k"])
    insert_if_absent(spark, path, spark.createDataFrame([(2, "z"), (3, "d")], "k int, v string"), ["k"])
    assert rows(spark.read.parquet(path)) == [(1, "a"), (2, "c"), (3, "d")]


def test_snapshots_give_back_every_type(spark, tmp_path):
    df = spark.sql(
        "SELECT timestamp'2024-02-29 00:00:00.123456' AS t, timestamp_ntz'1999-12-31 23:59:59.000001' AS n, "
        "date'1900-01-01' AS d, 12345678901234.5678BD AS m, cast('ab' AS binary) AS b, double('NaN') AS f, "
        "float(1.1) AS g, true AS o, array(1, NULL) AS a, map('k', 'v') AS p, named_struct('x', 9223372036854775807) AS s, "
        "'quote\" comma, \u00e9' AS c, cast(NULL AS int) AS z"
    )
    path = str(tmp_path / "types")
    assert write_snapshot(df, path, "a report/ä", datetime(2025, 1, 1, 0, 0, 0, 1))
    assert rows(read_snapshot(spark, path, "a report/ä", df.schema).drop("f")) == rows(df.drop("f"))
    assert read_snapshot(spark, path, "other", df.schema).count() == 0


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "snapshots")
    early, late = datetime(2025, 1, 1, 12), datetime(2025, 2, 1, 12)
    a = spark.createDataFrame([("x", 1, 0.5), (None, None, None)], "s string, n bigint, d double")
    b = spark.createDataFrame([("y", 2, 1.5)], a.schema)
    assert write_snapshot(a, path, "R1", early)
    assert write_snapshot(b, path, "R1", late)
    assert write_snapshot(b, path, "R2", early)
    assert not write_snapshot(b, path, "R1", early)
    assert rows(read_snapshot(spark, path, "R1", a.schema, early)) == rows(a)
    assert rows(read_snapshot(spark, path, "R1", a.schema)) == rows(b)
    assert rows(read_snapshot(spark, path, "R2", a.schema)) == rows(b)
