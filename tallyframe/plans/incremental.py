"""Keeping stored reports up to date: only the years whose raw data changed are made again."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tallyframe.functions.codes import DEFAULT_LABELS, STANDARD_CODES
from tallyframe.plans.reports import REPORTS
from tallyframe.plans.run import all_reports
from tallyframe.sources.bronze import bronze_from_parquet
from tallyframe.sources.folders import delete, exists, partition_values, read_text, state, write_text
from tallyframe.sources.schemas import BRONZE, PARTITION_COLUMN, PARTITIONED
from tallyframe.sources.staging import Stage, run_together

#: file below the reports that tells what they were made from
STATE = "_years.json"
_YEAR = "time_period"


def year_states(spark: SparkSession, root: str) -> dict[str, dict[str, str]]:
    """The state of each fact table's partition, by year, from listings alone."""
    years = sorted({y for t in PARTITIONED for y in partition_values(spark, f"{root}/{t}", PARTITION_COLUMN)})
    return {y: {t: state(spark, f"{root}/{t}/{PARTITION_COLUMN}={y}") for t in PARTITIONED} for y in years}


def _shared_state(spark: SparkSession, root: str, how: str, labels: object) -> str:
    """The state of all that every year depends on: tables without years, decoding and join type."""
    tables = [state(spark, f"{root}/{t}") for t in BRONZE if t not in PARTITIONED]
    told = json.dumps([tables, how, labels], sort_keys=True, default=dict)
    return hashlib.blake2b(told.encode(), digest_size=16).hexdigest()


def changed_years(spark: SparkSession, root: str, out: str, shared: str) -> tuple[list[str], list[str], dict]:
    """Years to be made, years that are gone, and the state to note when that is done."""
    now = {"shared": shared, "years": year_states(spark, root)}
    before = json.loads(read_text(spark, f"{out}/{STATE}") or "{}")
    known = before.get("years", {}) if before.get("shared") == shared else {}
    if any(not exists(spark, f"{out}/{name}") for name in REPORTS):
        known = {}
    made = [y for y, found in now["years"].items() if known.get(y) != found]
    return made, sorted(set(before.get("years", {})) - set(now["years"])), now


def update_reports(
    spark: SparkSession,
    root: str,
    out: str,
    how: str = "inner",
    codes: Mapping[str, Mapping[str, str]] = STANDARD_CODES,
    defaults: Mapping[str, str] = DEFAULT_LABELS,
    default: str | None = None,
) -> list[str]:
    """Bring the seven reports below ``out`` up to date with the raw tables below ``root``; returns the years made.

    The reports are Parquet tables partitioned by year. A year is made again if the files of its partition in any
    fact table have changed since it was made, all years if a table without years, the decoding or the join type has.
    Raw data of other years is not read, and their report partitions are not written (dynamic partition overwrite).
    Years that are gone from the raw tables are removed, and so is a year of a report that has no rows any more.

    What the reports were made from is noted last, so a run that fails is made up for by the next one. Listing costs the
    driver one pass over the names of the raw files and no memory that grows with them. One updater at a time.
    """
    shared = _shared_state(spark, root, how, [codes, defaults, default])
    years, gone, now = changed_years(spark, root, out, shared)
    if years:
        bronze = bronze_from_parquet(spark, root)
        with Stage(spark) as stage:
            finished = all_reports(
                spark, bronze, years, how=how, codes=codes, defaults=defaults, default=default, stage=stage
            )
            run_together(spark, [lambda n=name, d=df: _overwrite(d, f"{out}/{n}", years) for name, df in finished.items()])
    for name in REPORTS:
        for year in gone:
            delete(spark, f"{out}/{name}/{_YEAR}={year}")
    if years or gone:
        write_text(spark, f"{out}/{STATE}", json.dumps(now))
    return years


def _overwrite(df: DataFrame, path: str, years: list[str]) -> None:
    spark = df.sparkSession
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(_YEAR).parquet(path)
    # the overwrite leaves alone what it has no rows for
    stored = set(partition_values(spark, path, _YEAR)) & set(years)
    with_rows = {r[0] for r in df.select(_YEAR).distinct().collect()} if stored else set()
    for year in stored - with_rows:
        delete(spark, f"{path}/{_YEAR}={year}")


def read_report(spark: SparkSession, out: str, name: str) -> DataFrame:
    """A stored report with its fixed columns in order."""
    report = REPORTS[name]
    return spark.read.schema(report.schema).parquet(f"{out}/{name}").select(*report.columns)
