"""The seven reports: which rows they count, by what, and with which measures.

Reports come in families that share rows and groups, so a family is computed once as one wide aggregate
and each of its reports is a projection of it (Catalyst drops the aggregates a projection does not use).

How each family is laid out for large data:

* Every input is cut to the needed columns first, and fact tables are joined on (pupil, year) with their
  short raw codes; labels are put in after the rows have been grouped.
* Grouping is by one canonical code per label, which gives the groups of the labels themselves.
* Where a report counts by local authority, or by school, the facts are grouped by it *before* the
  geography or school table is joined. The join then sees one row per group instead of one per pupil:
  no fan-out of pupils over geographic levels, and no hot school or authority in the join.
* Reference tables get no broadcast hint. Spark broadcasts them when their size is under
  ``spark.sql.autoBroadcastJoinThreshold`` and otherwise joins by shuffle, with AQE splitting skew. The areas that pupils
  themselves are joined to are the exception: see ``few_areas``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions.codes import DEFAULT_LABELS, STANDARD_CODES
from tallyframe.functions.columns import SOURCES
from tallyframe.functions.decode import Labels
from tallyframe.functions.metrics import (
    average,
    differs_or_null,
    distinct_count,
    percent,
    status_counts,
    summed,
    wide_distribution,
    wide_percents,
)
from tallyframe.functions.packing import pack, packable, unpack
from tallyframe.operators.distribution import cumulative, frequencies
from tallyframe.operators.shape import all_of, select_fixed, with_constants
from tallyframe.plans.silver import TIME_IDENTIFIER, renamed
from tallyframe.session import fill_settings
from tallyframe.sources.bronze import Bronze

# ---------------------------------------------------------------------------
# Status codes, score range and the names of report columns and files.
# ---------------------------------------------------------------------------

COMPLETED = "C"

REASONS = {
    "A": "absent",
    "U": "unable_to_participate",
    "W": "working_below",
    "J": "just_arrived",
    "M": "missing_reason",
}

SCORES = range(25, -1, -1)

TIME_DIMS = ("time_period", "time_identifier")
COUNTRY_DIMS = ("geographic_level", "country_code", "country_name")
AREA_DIMS = ("region_code", "region_name", "old_la_code", "new_la_code", "la_name")
PUPIL_DIMS = (
    "establishment_type_group", "sex", "disadvantage_status", "ethnicity_major", "ethnicity_minor",
    "first_language", "fsm_status",
)
NATIONAL_PUPIL_DIMS = (*PUPIL_DIMS, "month_of_birth", "sen_provision", "sen_primary_need")
REGIONAL_PUPIL_DIMS = (*PUPIL_DIMS, "sen_provision")
SCHOOL_DIMS = ("establishment_type_group", "education_phase", "school_religious_character", "sex")

NATIONAL = ("National",)
REGIONAL_AND_LA = ("Regional", "Local authority")

ESTABLISHMENTS = "establishment_count"
ELIGIBLE = "eligible_pupil_count"
DONE = "completed_check_pupil_count"
NOT_DONE = "not_completed_check_pupil_count"
SCORE_TOTAL = "mtc_score_total"
SCORE_AVERAGE = "mtc_score_average"
SCORE_COUNT = "mtc_score_{}_pupil_count"
SCORE_PERCENT = "mtc_score_{}_pupil_percent"

FILE_NAMES = {
    "national_pupil": "mtc_national_pupil_characteristics_{years}",
    "regional_la_pupil": "mtc_regional_la_pupil_characteristics_{years}",
    "national_school": "mtc_national_school_characteristics_{years}",
    "national_cumulative": "mtc_national_cumulative_score_distribution_{years}",
    "national_school_scores": "mtc_national_score_distribution_by_school_characteristics_{years}",
    "national_pupil_scores": "mtc_national_score_distribution_by_pupil_characteristics_{years}",
    "regional_la_pupil_scores": "mtc_regional_la_score_distribution_by_pupil_characteristics_{years}",
}

# ---------------------------------------------------------------------------
# End of the fixed values.
# ---------------------------------------------------------------------------

REASON_COUNTS = {code: f"{name}_pupil_count" for code, name in REASONS.items()}
STATUS_PERCENTS = {
    "completed_check_pupil_percent": DONE,
    "not_completed_check_pupil_percent": NOT_DONE,
    **{f"{name}_pupil_percent": f"{name}_pupil_count" for name in REASONS.values()},
}
SCORE_COUNTS = [SCORE_COUNT.format(s) for s in SCORES]
SCORE_PERCENTS = [SCORE_PERCENT.format(s) for s in SCORES]

#: Measures that add up over disjoint sets of pupils.
ADDITIVE = (ELIGIBLE, DONE, NOT_DONE, *REASON_COUNTS.values(), SCORE_TOTAL, *SCORE_COUNTS)

CHARACTERISTIC_METRICS = (
    ESTABLISHMENTS, ELIGIBLE, DONE, NOT_DONE, *REASON_COUNTS.values(),
    SCORE_TOTAL, SCORE_AVERAGE, *STATUS_PERCENTS,
)
SCORE_METRICS = (
    ESTABLISHMENTS, ELIGIBLE, DONE, NOT_DONE, *SCORE_COUNTS,
    SCORE_TOTAL, SCORE_AVERAGE, *list(STATUS_PERCENTS)[:2], *SCORE_PERCENTS,
)
CUMULATIVE_METRICS = ("mtc_score", "pupil_count", "cumulative_pupil_count", "cumulative_pupil_percent")

FACT_KEY = ("pupil_id", "time_period")


def _type_of(column: str) -> T.DataType:
    if column == "mtc_score":
        return T.IntegerType()
    if column.endswith(("_percent", "_average")):
        return T.DoubleType()
    if column.endswith(("_count", "_total")):
        return T.LongType()
    return T.StringType()


# --- measures -----------------------------------------------------------------


def pupil_measures() -> list:
    """Additive measures over pupil rows.

    The score total takes every mark there is, not only those of completed checks.
    """
    return [
        F.count("pupil_id").alias(ELIGIBLE),
        *status_counts("completion_status", {COMPLETED: DONE}),
        F.count_if(differs_or_null("completion_status", COMPLETED)).alias(NOT_DONE),
        *status_counts("completion_status", REASON_COUNTS),
        F.sum("mtc_score").alias(SCORE_TOTAL),
        *wide_distribution("mtc_score", SCORES, SCORE_COUNT, when=f"completion_status = '{COMPLETED}'"),
    ]


#: more partitions than any stage has
_EVERY_PARTITION = 1 << 30


def own_stage(df: DataFrame) -> DataFrame:
    """``df`` with its generated code apart from that of what follows.

    Spark puts all operators up to the next exchange into one generated method per stage, and the JVM compiles no method
    of more than 8,000 bytes: beyond that a stage is interpreted. An operator without generated code ends a
    stage; this one merges partitions to at most so many as never are, so it moves no rows.
    """
    return df.coalesce(_EVERY_PARTITION)


def with_ratios(df: DataFrame) -> DataFrame:
    """Averages and percentages of an aggregate, in one projection.

    Averages and score percentages are over completed checks, status percentages over eligible pupils. With some eighty
    measures they are a stage of their own, beside the one that makes the counts.
    """
    return own_stage(df).select(
        "*",
        average(SCORE_TOTAL, DONE).alias(SCORE_AVERAGE),
        *[percent(count, ELIGIBLE).alias(name) for name, count in STATUS_PERCENTS.items()],
        *wide_percents(SCORES, SCORE_COUNT, DONE, SCORE_PERCENT),
    )


# --- fact rows ----------------------------------------------------------------


def join_facts(rows: DataFrame, others: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``others`` of the same pupil and year.

    Rows are dealt by the pupil alone: the years are compared as a range, which is no key of a shuffle. A pupil's rows of all
    years are neighbours in the shuffle then, where what repeats in them takes next to nothing, and tables bucketed
    by pupil are not moved.
    """
    other = others.withColumnsRenamed({c: f"__{c}" for c in FACT_KEY})
    pupil, year = FACT_KEY
    same_year = (F.col(year) >= F.col(f"__{year}")) & (F.col(year) <= F.col(f"__{year}"))
    met = rows.join(other, (F.col(pupil) == F.col(f"__{pupil}")) & same_year, how)
    return met.drop(*[f"__{c}" for c in FACT_KEY])


def _joined_pupils(bronze: Bronze, columns: tuple[str, ...], how: str, claimed: bool) -> DataFrame:
    """Pupils with their result and, where ``claimed``, their claim record of the same year.

    A pupil's codes are one number while tasks hold the rows for the shuffle and the sorts of the joins.
    """
    pupils = renamed("pupil", bronze.pupil, *FACT_KEY, *columns)
    results = renamed("results", bronze.results, *FACT_KEY, "mtc_score", "completion_status")
    coded = packable(pupils, columns)
    rows = join_facts(pack(pupils, coded), results, how)
    if not claimed:
        return unpack(rows, coded)
    rows = unpack(with_claims(rows, bronze, how), coded)
    # with the canonical codes and the areas that follow, the method would be too large; nothing is joined by pupil any more
    return own_stage(rows) if coded else rows


def scored_pupils(bronze: Bronze, *columns: str, how: str = "inner") -> DataFrame:
    """Pupils with their result of the same year; ``columns`` of the pupil table are kept, as codes."""
    return _joined_pupils(bronze, columns, how, claimed=False)


def claimed_pupils(bronze: Bronze, *columns: str, how: str = "inner") -> DataFrame:
    """Pupils with their result and their claim record of the same year."""
    return _joined_pupils(bronze, columns, how, claimed=True)


def with_claims(rows: DataFrame, bronze: Bronze, how: str = "inner") -> DataFrame:
    claims = renamed("claimcare", bronze.claimcare, *FACT_KEY, "disadvantage_status", "fsm_status")
    return join_facts(rows, claims, how)


#: which of a pupil's claims of a year a row has
CLAIM_NUMBER = "__claim"


def with_numbered_claims(rows: DataFrame, bronze: Bronze) -> DataFrame:
    """Every row once for each claim record of the same pupil and year, or once without; claims are numbered from 1.

    Rows with a claim are those of ``with_claims``, and rows without or with the first one are ``rows`` as they were.
    """
    claims = renamed("claimcare", bronze.claimcare, *FACT_KEY, "disadvantage_status", "fsm_status")
    # dealt by the pupil alone, as for the join: the rank of a year is one more than the claims of earlier years
    of_pupil = Window.partitionBy(FACT_KEY[0]).orderBy(FACT_KEY[1])
    number = F.row_number().over(of_pupil) - F.rank().over(of_pupil) + 1
    return join_facts(rows, claims.withColumn(CLAIM_NUMBER, number), "left")


CLAIMED_COLUMNS = (
    "school_id", "new_la_code",
    *[c for c in NATIONAL_PUPIL_DIMS if c not in ("disadvantage_status", "fsm_status")],
)
REGIONAL_CLAIMED_COLUMNS = tuple(c for c in CLAIMED_COLUMNS if c not in ("month_of_birth", "sen_primary_need"))
SCORED_COLUMNS = ("school_id", "new_la_code", "establishment_type_group", "sex")


def area_rows(geography: DataFrame, levels: Iterable[str], labels: Labels, *columns: str) -> DataFrame:
    """``columns`` of the geography rows of given levels. The level is tested on its raw code, in the scan."""
    level = labels.predicate("geographic_lvl", "geographic_level", levels)
    return labels.decode(renamed("geography", geography.filter(level), *columns))


def few_areas(areas: DataFrame) -> DataFrame:
    """Area rows of one level, at most one per authority, to be joined to pupils without moving these.

    Where Spark knows the size of geography by an estimate only, as of a view, it shuffles all pupils by authority unless
    the areas happen to be there before the facts are joined. A few authorities then hold all pupils, and the
    largest bounds the number of useful tasks. Authorities don't grow in number with the pupils, so their rows are broadcast.
    """
    return F.broadcast(areas)


def unique_bridge(geography: DataFrame, labels: Labels = Labels()) -> DataFrame:
    """Geography with an assertion in the plan: one row per authority and level.

    A second one would count the authority's pupils twice. The query fails where it meets one at a level that it uses;
    rows without an authority join nothing and may repeat.
    """
    # a level may have several codes, and they are one level to a report
    level = labels.canonical(geography.withColumnRenamed("geographic_lvl", "geographic_level"), ["geographic_level"])
    marked = level.withColumnRenamed("geographic_level", "__level").withColumn("geographic_lvl", F.col("__level"))
    repeats = F.count(F.lit(1)).over(Window.partitionBy("la_new", "__level"))
    told = F.concat(
        F.lit("authority "), "la_new", F.lit(" is in the bridge more than once at level "),
        F.coalesce("__level", F.lit("NULL")),
    )
    checked = F.when(F.col("la_new").isNull() | (repeats == 1), F.col("la_new")).otherwise(F.raise_error(told).cast("string"))
    return marked.withColumn("la_new", checked).select(*geography.columns)


# --- families -----------------------------------------------------------------


def national_pupil_family(facts: DataFrame, bronze: Bronze, labels: Labels, how: str) -> DataFrame:
    """By country and pupil characteristics. Authorities are dropped from the groups, so it joins first."""
    dims = NATIONAL_PUPIL_DIMS
    areas = area_rows(bronze.geography, NATIONAL, labels, "new_la_code", *COUNTRY_DIMS)
    rows = labels.canonical(facts, dims).join(few_areas(areas), "new_la_code")
    grouped = rows.groupBy("time_period", *COUNTRY_DIMS, *dims).agg(
        distinct_count("school_id").alias(ESTABLISHMENTS), *pupil_measures()
    )
    return labels.decode(grouped, dims)


def regional_pupil_family(facts: DataFrame, bronze: Bronze, labels: Labels, how: str) -> DataFrame:
    """By authority and pupil characteristics, repeated for each geographic level.

    An authority's groups are the same at every level, so they are made once and joined to its area rows
    afterwards. Area rows that are equal in all group keys count their pupils once each, as joining them
    to the pupils would.
    """
    dims = REGIONAL_PUPIL_DIMS
    area_keys = (*COUNTRY_DIMS, *AREA_DIMS)
    areas = frequencies(area_rows(bronze.geography, REGIONAL_AND_LA, labels, *area_keys), area_keys, "__copies")
    grouped = (
        labels.canonical(facts, dims)
        .groupBy("time_period", "new_la_code", *dims)
        .agg(distinct_count("school_id").alias(ESTABLISHMENTS), *pupil_measures())
    )
    placed = grouped.join(areas, "new_la_code").withColumns(
        {name: F.expr(f"{name} * __copies") for name in ADDITIVE}
    )
    return labels.decode(placed.drop("__copies"), dims)


def school_family(facts: DataFrame, bronze: Bronze, labels: Labels, how: str) -> DataFrame:
    """By characteristics of the school: facts are summed per school, then schools are grouped.

    A school meets each of its distinct descriptions once, so establishments are counted without DISTINCT
    and schools are summed before the shuffle. Equal rows of the school table count their pupils once each.
    """
    per_school = facts.groupBy("time_period", "school_id").agg(*pupil_measures())
    columns = ("school_id", "country_code", "country_name", *SCHOOL_DIMS)
    schools = frequencies(
        labels.decode(renamed("school", bronze.school, *columns)), columns, "__copies"
    )
    return with_constants(
        per_school.join(schools, "school_id", how)
        .groupBy("time_period", "country_code", "country_name", *SCHOOL_DIMS)
        .agg(
            F.count("school_id").alias(ESTABLISHMENTS),
            # counts are never NULL; telling Spark so spares a test in each of the ratios
            *[F.expr(f"coalesce(sum({name} * coalesce(__copies, 1)), 0) AS {name}") for name in ADDITIVE if name != SCORE_TOTAL],
            F.expr(f"sum({SCORE_TOTAL} * coalesce(__copies, 1)) AS {SCORE_TOTAL}"),
        ),
        geographic_level="National",
    )


def cumulative_family(
    facts: DataFrame, bronze: Bronze, labels: Labels, how: str, drop_null_groups: bool = True
) -> DataFrame:
    """Score frequencies of completed checks with running counts from the top score down."""
    dims = ("establishment_type_group", "sex")
    completed = facts.filter(F.col("completion_status") == COMPLETED)
    per_area = frequencies(
        labels.canonical(completed, dims), ["time_period", "new_la_code", *dims, "mtc_score"],
        "pupil_count", of="pupil_id",
    )
    areas = area_rows(bronze.geography, NATIONAL, labels, "new_la_code", "country_code", "country_name")
    groups = ["time_period", "country_code", "country_name", *dims]
    counts = per_area.join(areas, "new_la_code").groupBy(*groups, "mtc_score").agg(*summed(["pupil_count"]))
    running = cumulative(
        counts, groups, "mtc_score", "pupil_count", "cumulative_pupil_count", "cumulative_pupil_percent",
        drop_null_groups=drop_null_groups,
    )
    return with_constants(labels.decode(running, dims), geographic_level="National")


@dataclass(frozen=True)
class Family:
    """Reports over the same rows and groups."""

    facts: Callable[..., DataFrame]
    fact_columns: tuple[str, ...]
    build: Callable[..., DataFrame]
    ratios: bool = True

    def wide(
        self,
        bronze: Bronze,
        labels: Labels = Labels(),
        how: str = "inner",
        facts: DataFrame | None = None,
        **options,
    ) -> DataFrame:
        """The family's aggregate with all measures; ``facts`` replaces the fact join by its stored rows."""
        fill_settings(bronze.pupil.sparkSession)
        if facts is None:
            facts = self.facts(bronze, *self.fact_columns, how=how)
        wide = self.build(facts, bronze, labels, how, **options)
        wide = with_constants(wide, time_identifier=TIME_IDENTIFIER)
        return with_ratios(wide) if self.ratios else wide


FAMILIES = {
    "national_pupil": Family(claimed_pupils, CLAIMED_COLUMNS, national_pupil_family),
    "regional_pupil": Family(claimed_pupils, REGIONAL_CLAIMED_COLUMNS, regional_pupil_family),
    "school": Family(scored_pupils, ("school_id",), school_family),
    "cumulative": Family(
        scored_pupils, ("new_la_code", "establishment_type_group", "sex"), cumulative_family, ratios=False
    ),
}


# --- reports ------------------------------------------------------------------


@dataclass(frozen=True)
class Report:
    """One published table: a family, its columns in order and its row order."""

    family: str
    dims: tuple[str, ...]
    metrics: tuple[str, ...]
    order: tuple[str, ...]
    descending: tuple[str, ...] = ()

    @property
    def columns(self) -> tuple[str, ...]:
        return (*TIME_DIMS, *self.dims, *self.metrics)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, _type_of(c)) for c in self.columns])

    def project(self, wide: DataFrame) -> DataFrame:
        return select_fixed(wide, self.schema)

    def sort_keys(self) -> list[Column]:
        return [*[F.col(c).asc() for c in self.order], *[F.col(c).desc() for c in self.descending]]

    def ordered(self, df: DataFrame) -> DataFrame:
        return df.orderBy(*self.sort_keys())


_NATIONAL_PUPIL = (*COUNTRY_DIMS, *NATIONAL_PUPIL_DIMS)
_REGIONAL_PUPIL = (*COUNTRY_DIMS, *AREA_DIMS, *REGIONAL_PUPIL_DIMS)
_SCHOOL = (*COUNTRY_DIMS, *SCHOOL_DIMS)
_BY_ESTABLISHMENT = ("time_period", "establishment_type_group", "sex")
_BY_AREA = ("time_period", "region_name", "la_name", "sex")
_BY_PHASE = ("time_period", "establishment_type_group", "education_phase", "sex")

REPORTS: dict[str, Report] = {
    "national_pupil": Report("national_pupil", _NATIONAL_PUPIL, CHARACTERISTIC_METRICS, _BY_ESTABLISHMENT),
    "regional_la_pupil": Report("regional_pupil", _REGIONAL_PUPIL, CHARACTERISTIC_METRICS, _BY_AREA),
    "national_school": Report("school", _SCHOOL, CHARACTERISTIC_METRICS, _BY_PHASE),
    "national_cumulative": Report(
        "cumulative", (*COUNTRY_DIMS, "establishment_type_group", "sex"), CUMULATIVE_METRICS,
        _BY_ESTABLISHMENT, ("mtc_score",),
    ),
    "national_school_scores": Report("school", _SCHOOL, SCORE_METRICS, _BY_PHASE),
    "national_pupil_scores": Report("national_pupil", _NATIONAL_PUPIL, SCORE_METRICS, _BY_ESTABLISHMENT),
    "regional_la_pupil_scores": Report("regional_pupil", _REGIONAL_PUPIL, SCORE_METRICS, _BY_AREA),
}

#: Where the decoded and plain dimensions of a report come from: fact tables first, as in the reports.
_DIM_SOURCES = {
    "school": ("school",),
    "national_pupil": ("pupil", "claimcare", "geography"),
    "regional_pupil": ("pupil", "claimcare", "geography"),
    "cumulative": ("pupil", "geography"),
}
_AREA_SIDE = {*COUNTRY_DIMS, *AREA_DIMS}


#: Raw key of the pupil table for each reference table that is joined to it.
_PUPIL_KEYS = {"geography": ("la_code_new", "la_new"), "school": ("school_id", "school_id")}


def _filter_sources(
    bronze: Bronze, family: str, filters: Mapping[str, str], labels: Labels, how: str
) -> tuple[Bronze, dict[str, str]]:
    """Apply ``dim = label`` filters to the raw tables that the dims come from, as filters on raw codes.

    Returned beside the tables are the filters that are left for the finished rows. A filter on raw codes keeps the rows
    with its label and no others, so it is not made again on decoded columns.

    Where a reference table is filtered, pupils without a match in it cannot reach the report either, so the
    pupil table is semi-joined with the keys that are left: other regions' pupils are gone before the facts
    are joined and grouped. With left joins only pupil and geography rows can be filtered early, as these are
    never replaced by NULLs.
    """
    left = dict(filters)
    for dim, label in filters.items():
        if dim == "time_period":
            bronze = bronze.for_periods(label)
            continue
        tables = _DIM_SOURCES[family]
        if dim in _AREA_SIDE and "geography" in tables:
            tables = ("geography",)
        for table in tables:
            raw = {out: r for r, out in SOURCES[table].items()}.get(dim, dim)
            df = getattr(bronze, table)
            if raw not in df.columns:
                continue
            if how == "inner" or table in ("pupil", "geography"):
                hit = labels.predicate(raw, dim, label) if dim in labels.codes else F.col(raw) == label
                bronze = bronze.with_tables(**{table: df.filter(hit)})
                del left[dim]
            break
    for table, (key, other) in _PUPIL_KEYS.items():
        filtered = any(dim in filters for dim in (_AREA_SIDE if table == "geography" else SCHOOL_DIMS))
        if not filtered or table not in _DIM_SOURCES[family] or how != "inner" and table == "school":
            continue
        keys = getattr(bronze, table)
        if table == "geography":
            levels = REGIONAL_AND_LA if family == "regional_pupil" else NATIONAL
            keys = keys.filter(labels.predicate("geographic_lvl", "geographic_level", levels))
        keys = keys.select(F.col(other).alias(key)).distinct()
        keys = few_areas(keys) if table == "geography" else keys
        bronze = bronze.with_tables(pupil=bronze.pupil.join(keys, key, "left_semi"))
    return bronze, left


def build_report(
    name: str,
    bronze: Bronze,
    periods: str | Iterable[str] | None = None,
    filters: Mapping[str, str] | None = None,
    how: str = "inner",
    ordered: bool = False,
    check_bridge: bool = False,
    codes: Mapping[str, Mapping[str, str]] = STANDARD_CODES,
    defaults: Mapping[str, str] = DEFAULT_LABELS,
    default: str | None = None,
    **options,
) -> DataFrame:
    """One report as a lazy DataFrame with its fixed schema.

    ``periods`` restricts the years (all by default) as a partition filter on every fact table.
    ``filters`` keeps the rows with the given labels (``{"sex": "Girls"}``); the labels are turned into filters on
    raw codes below the joins, as far as the join type allows. ``how="left"`` keeps pupils without a result or
    claim record. ``defaults`` has the label of unknown codes by column, ``default`` one for all columns.
    ``ordered`` sorts the rows, which costs a range shuffle. ``check_bridge`` makes the query fail where geography has
    an authority more than once at a level, instead of counting its pupils as often.
    """
    report = REPORTS[name]
    filters = dict(filters or {})
    unknown = set(filters) - {*TIME_DIMS, *report.dims}
    if unknown:
        raise ValueError(f"report {name} has no dimension {sorted(unknown)}")
    labels = Labels(codes, defaults, default)
    if check_bridge:
        bronze = bronze.with_tables(geography=unique_bridge(bronze.geography, labels))
    bronze, left = _filter_sources(bronze.for_periods(periods), report.family, filters, labels, how)
    wide = FAMILIES[report.family].wide(bronze, labels, how, **options)
    result = report.project(wide)
    # every dim is a group key, so the same filter holds on the finished rows
    result = result.filter(all_of(F.col(dim) == label for dim, label in left.items())) if left else result
    return report.ordered(result) if ordered else result
