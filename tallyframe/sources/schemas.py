"""Declared schemas of the five raw tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _table(required: str, optional: str, tail: tuple[T.StructField, ...] = ()) -> T.StructType:
    fields = [T.StructField(n, T.StringType(), False) for n in required.split()]
    fields += [T.StructField(n, T.StringType(), True) for n in optional.split()]
    return T.StructType([*fields, *tail, T.StructField("load_date", T.DateType(), True)])


PUPIL = _table(
    "pupil_id acad_year_code school_id",
    "estab_type_group la_code_new la_code_old gender ethnic_major_group ethnic_minor_group first_lang "
    "disadvantaged_flag fsm_eligible_flag birth_month_code sen_prov_code sen_type_rank",
)

SCHOOL = _table(
    "school_id",
    "la_code_new la_code_old country_code country_name estab_type_group phase_of_education "
    "religious_character gender",
)

RESULTS = _table(
    "pupil_id school_id acad_year_code",
    "",
    (
        T.StructField("pupil_mark", T.IntegerType(), True),
        T.StructField("completion_status", T.StringType(), True),
    ),
)

CLAIMCARE = _table(
    "pupil_id acad_year_code",
    "claim_type fsm_claim_flag ever_fsm_6 pupil_premium_flag service_child_flag lac_flag",
)

GEOGRAPHY = _table(
    "la_new",
    "la_old la_name_full gor_code gor_name country_cd country_nm geographic_lvl",
)

BRONZE: dict[str, T.StructType] = {
    "pupil": PUPIL,
    "school": SCHOOL,
    "results": RESULTS,
    "claimcare": CLAIMCARE,
    "geography": GEOGRAPHY,
}

#: Fact tables are partitioned by year; the two reference tables carry no year.
PARTITION_COLUMN = "acad_year_code"
PARTITIONED = ("pupil", "results", "claimcare")

#: Join key of the fact tables, in raw names.
FACT_KEY = ("pupil_id", "acad_year_code")
