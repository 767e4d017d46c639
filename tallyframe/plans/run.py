"""All reports in one run."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions.codes import DEFAULT_LABELS, STANDARD_CODES
from tallyframe.functions.decode import Labels
from tallyframe.operators.periods import as_periods
from tallyframe.plans.reports import (
    CLAIM_NUMBER,
    CLAIMED_COLUMNS,
    FAMILIES,
    FILE_NAMES,
    REPORTS,
    SCORED_COLUMNS,
    claimed_pupils,
    scored_pupils,
    unique_bridge,
    with_numbered_claims,
)
from tallyframe.session import fill_settings
from tallyframe.sources.bronze import Bronze
from tallyframe.sources.sinks import write_csv, write_table, year_suffix
from tallyframe.sources.staging import Stage, run_together


def staged_families(
    spark: SparkSession,
    bronze: Bronze,
    periods: str | Iterable[str] | None = None,
    how: str = "inner",
    codes: Mapping[str, Mapping[str, str]] = STANDARD_CODES,
    defaults: Mapping[str, str] = DEFAULT_LABELS,
    default: str | None = None,
    stage: Stage | None = None,
    check_bridge: bool = False,
) -> dict[str, DataFrame]:
    """The four wide aggregates behind the seven reports, each computed once and staged as a table.

    The fact joins are the expensive part, so they are done once for all the families, one after the other in the same
    partitions, and staged as narrow rows of raw codes. A pupil with its result is there once for each of its claims, or
    once without any; the families that read no claims take the first of these rows, the others those with a claim. They
    then read only the columns they need. Geography is staged too: where Spark only estimates its size, it shuffles all
    facts by authority before it sees that it could have broadcast the areas.
    """
    fill_settings(spark)
    stage = stage or Stage(spark)
    bronze, labels = bronze.for_periods(periods), Labels(codes, defaults, default)
    if check_bridge:
        bronze = bronze.with_tables(geography=unique_bridge(bronze.geography, labels))
    columns = dict.fromkeys((*CLAIMED_COLUMNS, *SCORED_COLUMNS))
    facts = with_numbered_claims(scored_pupils(bronze, *columns, how=how), bronze)
    stored = stage.tables({"facts": facts, "geography": bronze.geography})
    facts, bronze = stored["facts"], bronze.with_tables(geography=stored["geography"])
    with_claim = F.col(CLAIM_NUMBER).isNotNull()
    rows_of = {
        claimed_pupils: facts.filter(with_claim) if how == "inner" else facts,
        scored_pupils: facts.filter(~with_claim | (F.col(CLAIM_NUMBER) == 1)),
    }
    return stage.tables(
        {name: family.wide(bronze, labels, how, facts=rows_of[family.facts]) for name, family in FAMILIES.items()}
    )


def all_reports(
    spark: SparkSession, bronze: Bronze, periods: str | Iterable[str] | None = None, **options
) -> dict[str, DataFrame]:
    """Every report as a projection of the staged family aggregates."""
    wide = staged_families(spark, bronze, periods, **options)
    return {name: report.project(wide[report.family]) for name, report in REPORTS.items()}


def write_all_csv(
    spark: SparkSession,
    bronze: Bronze,
    root: str,
    periods: str | Iterable[str] | None = None,
    parts: int | Mapping[str, int] | None = None,
    **options,
) -> dict[str, str]:
    """Write the seven reports, ordered, as CSV folders below ``root``; returns their paths.

    ``parts`` sets the number of CSV parts, for all reports or by report name. By default the sort
    decides: a report's parts, read in name order, are in report order.
    """
    years = as_periods(periods) or bronze.periods()
    suffix = year_suffix(years)
    paths = {name: f"{root}/{FILE_NAMES[name].format(years=suffix)}" for name in REPORTS}

    def write(name: str, df: DataFrame) -> None:
        number = parts.get(name) if isinstance(parts, Mapping) else parts
        write_csv(df, paths[name], number, REPORTS[name].sort_keys())

    with Stage(spark) as stage:
        finished = all_reports(spark, bronze, years, stage=stage, **options)
        run_together(spark, [lambda n=name, d=df: write(n, d) for name, df in finished.items()])
    return paths


def write_all_tables(
    spark: SparkSession,
    bronze: Bronze,
    schema: str | None = None,
    catalog: str | None = None,
    periods: str | Iterable[str] | None = None,
    **options,
) -> list[str]:
    """Create or replace one table per report; tables are left unsorted."""
    tables = {name: FILE_NAMES[name].removesuffix("_{years}") for name in REPORTS}
    with Stage(spark) as stage:
        finished = all_reports(spark, bronze, periods, stage=stage, **options)
        run_together(
            spark, [lambda t=tables[name], d=df: write_table(d, t, schema, catalog) for name, df in finished.items()]
        )
    return list(tables.values())
