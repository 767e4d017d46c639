"""Decoded views of the raw tables: output names, labels in place of codes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions import columns as names
from tallyframe.functions.codes import COMPLETION_STATUS, DEFAULT_LABELS, STANDARD_CODES
from tallyframe.functions.decode import PASSTHROUGH, decode, decode_columns
from tallyframe.operators.shape import renamed_select
from tallyframe.sources.bronze import Bronze

TIME_IDENTIFIER = "Academic year"

#: Output columns of each view that come straight from the raw table, under their output names.
VIEW_COLUMNS: dict[str, tuple[str, ...]] = {
    "pupil": (
        "pupil_id", "school_id", "time_period", "establishment_type_group", "new_la_code", "old_la_code",
        "sex", "ethnicity_major", "ethnicity_minor", "first_language", "month_of_birth", "sen_provision",
        "sen_primary_need",
    ),
    "school": (
        "school_id", "new_la_code", "old_la_code", "country_code", "country_name",
        "establishment_type_group", "education_phase", "school_religious_character", "sex",
    ),
    "results": ("pupil_id", "school_id", "time_period", "mtc_score", "completion_status"),
    "claimcare": ("pupil_id", "time_period", "disadvantage_status", "fsm_status"),
    "geography": (
        "new_la_code", "old_la_code", "la_name", "region_code", "region_name", "country_code",
        "country_name", "geographic_level",
    ),
}


def renamed(table: str, df: DataFrame, *only: str) -> DataFrame:
    """A raw table under output names with its codes untouched, all view columns or ``only`` some."""
    return renamed_select(df, names.SOURCES[table], only or VIEW_COLUMNS[table])


def silver(
    table: str,
    df: DataFrame,
    codes: Mapping[str, Mapping[str, str]] = STANDARD_CODES,
    defaults: Mapping[str, str] = DEFAULT_LABELS,
    default: str | None = None,
) -> DataFrame:
    """The decoded view of one raw table; ``default`` is one label for all unknown codes and NULLs."""
    view = decode_columns(renamed(table, df), codes=codes, defaults=defaults, default=default)
    if table == "pupil":
        keys = ("pupil_id", "school_id", "time_period")
        rest = [c for c in VIEW_COLUMNS["pupil"] if c not in keys]
        return view.select(*keys, F.lit(TIME_IDENTIFIER).alias("time_identifier"), *rest)
    if table == "results":
        return view.withColumn(
            "completion_status_label", decode("completion_status", COMPLETION_STATUS, PASSTHROUGH if default is None else default)
        )
    return view


def register_views(bronze: Bronze, codes: Mapping[str, Mapping[str, str]] = STANDARD_CODES) -> None:
    """Register the five views as ``v_<table>`` for use from SQL."""
    for table, df in bronze.tables().items():
        silver(table, df, codes).createOrReplaceTempView(f"v_{table}")
