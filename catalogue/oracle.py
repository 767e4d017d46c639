"""Independent SQL for the registered queries, in the oracle's dialect.

Labels come from a lookup relation joined to the rows, counts from FILTER clauses, and joins and
groupings are written straight from the definition of each report, without the rewrites that the Spark
plans use.
"""

from __future__ import annotations

from collections.abc import Iterable

from catalogue.fixture import SQL as FIXTURE
from tallyframe.functions.codes import COMPLETION_STATUS, STANDARD_CODES


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def codes_cte(columns: Iterable[str] | None = None) -> str:
    tables = dict(STANDARD_CODES, completion_status_label=COMPLETION_STATUS)
    rows = [
        f"({_quote(column)},{_quote(code)},{_quote(label)})"
        for column, codes in tables.items()
        if columns is None or column in columns
        for code, label in codes.items()
    ]
    return f"codes(col, code, label) AS (VALUES {', '.join(rows)})"


def label(column: str, raw: str, default: str | None = None) -> str:
    """Scalar lookup of the label; unknown codes pass through, for sex they become Total, or all become ``default``."""
    other = _quote(default) if default is not None else "'Total'" if column == "sex" else raw
    return f"coalesce((SELECT k.label FROM codes k WHERE k.col = '{column}' AND k.code = {raw}), {other})"


_label = label


def views(default: str | None = None) -> dict[str, str]:
    """The five views as SQL."""

    def label(column: str, raw: str) -> str:
        return _label(column, raw, default)

    return {
    "v_pupil": f"""
SELECT pupil_id, school_id, acad_year_code AS time_period, 'Academic year' AS time_identifier,
  {label('establishment_type_group', 'estab_type_group')} AS establishment_type_group,
  la_code_new AS new_la_code, la_code_old AS old_la_code,
  {label('sex', 'gender')} AS sex,
  {label('ethnicity_major', 'ethnic_major_group')} AS ethnicity_major,
  {label('ethnicity_minor', 'ethnic_minor_group')} AS ethnicity_minor,
  {label('first_language', 'first_lang')} AS first_language,
  {label('month_of_birth', 'birth_month_code')} AS month_of_birth,
  {label('sen_provision', 'sen_prov_code')} AS sen_provision,
  {label('sen_primary_need', 'sen_type_rank')} AS sen_primary_need
FROM pupil""",
    "v_school": f"""
SELECT school_id, la_code_new AS new_la_code, la_code_old AS old_la_code, country_code, country_name,
  {label('establishment_type_group', 'estab_type_group')} AS establishment_type_group,
  {label('education_phase', 'phase_of_education')} AS education_phase,
  {label('school_religious_character', 'religious_character')} AS school_religious_character,
  {label('sex', 'gender')} AS sex
FROM school""",
    "v_results": f"""
SELECT pupil_id, school_id, acad_year_code AS time_period, pupil_mark AS mtc_score, completion_status,
  {label('completion_status_label', 'completion_status')} AS completion_status_label
FROM results""",
    "v_claimcare": f"""
SELECT pupil_id, acad_year_code AS time_period,
  {label('disadvantage_status', 'claim_type')} AS disadvantage_status,
  {label('fsm_status', 'fsm_claim_flag')} AS fsm_status
FROM claimcare""",
    "v_geography": f"""
SELECT la_new AS new_la_code, la_old AS old_la_code, la_name_full AS la_name, gor_code AS region_code,
  gor_name AS region_name, country_cd AS country_code, country_nm AS country_name,
  {label('geographic_level', 'geographic_lvl')} AS geographic_level
FROM geography""",
    }


def with_views(*names: str, body: str, extra: str = "", default: str | None = None) -> str:
    """``body`` below the fixture tables and views it needs."""
    parts, defined = [codes_cte()] if names else [], views(default)
    for view in names:
        name = view.removeprefix("v_")
        parts.append(f"{name} AS ({FIXTURE[name]})")
        parts.append(f"{view} AS ({defined[view]})")
    if extra:
        parts.append(extra)
    return "WITH " + ",\n".join(parts) + "\n" + body


def with_tables(*names: str, body: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({FIXTURE[n]})" for n in names) + "\n" + body


# --- reports ------------------------------------------------------------------

NATIONAL_PUPIL = [
    "p.time_period", "p.time_identifier", "g.geographic_level", "g.country_code", "g.country_name",
    "p.establishment_type_group", "p.sex", "c.disadvantage_status", "p.ethnicity_major", "p.ethnicity_minor",
    "p.first_language", "c.fsm_status", "p.month_of_birth", "p.sen_provision", "p.sen_primary_need",
]
REGIONAL_PUPIL = [
    *NATIONAL_PUPIL[:5], "g.region_code", "g.region_name", "g.old_la_code", "g.new_la_code", "g.la_name",
    *NATIONAL_PUPIL[5:12], "p.sen_provision",
]
SCHOOL = [
    "p.time_period", "s.country_code", "s.country_name", "s.establishment_type_group", "s.education_phase",
    "s.school_religious_character", "s.sex",
]
SCHOOL_LITERALS = "'Academic year' AS time_identifier, 'National' AS geographic_level"

DONE = "count(*) FILTER (WHERE r.completion_status = 'C')"
NOT_DONE = "count(*) FILTER (WHERE r.completion_status IS DISTINCT FROM 'C')"
REASONS = {
    "absent": "A", "unable_to_participate": "U", "working_below": "W", "just_arrived": "J", "missing_reason": "M",
}


def pct(part: str, whole: str) -> str:
    return f"round({part} / nullif({whole}, 0) * 100, 0)"


def _common() -> list[str]:
    return [
        "count(DISTINCT p.school_id) AS establishment_count",
        "count(p.pupil_id) AS eligible_pupil_count",
        f"{DONE} AS completed_check_pupil_count",
        f"{NOT_DONE} AS not_completed_check_pupil_count",
        "CAST(sum(r.mtc_score) AS BIGINT) AS mtc_score_total",
        f"round(sum(r.mtc_score) / nullif({DONE}, 0), 1) AS mtc_score_average",
        f"{pct(DONE, 'count(p.pupil_id)')} AS completed_check_pupil_percent",
        f"{pct(NOT_DONE, 'count(p.pupil_id)')} AS not_completed_check_pupil_percent",
    ]


def characteristics() -> str:
    items = _common()
    for name, code in REASONS.items():
        n = f"count(*) FILTER (WHERE r.completion_status = '{code}')"
        items += [f"{n} AS {name}_pupil_count", f"{pct(n, 'count(p.pupil_id)')} AS {name}_pupil_percent"]
    return ",\n  ".join(items)


def scores() -> str:
    items = _common()
    for s in range(26):
        n = f"count(*) FILTER (WHERE r.completion_status = 'C' AND r.mtc_score = {s})"
        items += [f"{n} AS mtc_score_{s}_pupil_count", f"{pct(n, DONE)} AS mtc_score_{s}_pupil_percent"]
    return ",\n  ".join(items)


def pupil_report(
    metrics: str, dims: list[str], levels: str, where: str = "", how: str = "JOIN", default: str | None = None
) -> str:
    return with_views(
        "v_pupil", "v_results", "v_claimcare", "v_geography", default=default,
        body=f"""SELECT {', '.join(dims)},
  {metrics}
FROM v_pupil p
{how} v_results r ON r.pupil_id = p.pupil_id AND r.time_period = p.time_period
{how} v_claimcare c ON c.pupil_id = p.pupil_id AND c.time_period = p.time_period
JOIN v_geography g ON g.new_la_code = p.new_la_code
WHERE g.geographic_level IN ({levels}) {where}
GROUP BY {', '.join(dims)}""",
    )


def school_report(metrics: str, where: str = "", how: str = "JOIN", default: str | None = None) -> str:
    return with_views(
        "v_pupil", "v_results", "v_school", default=default,
        body=f"""SELECT {', '.join(SCHOOL)}, {SCHOOL_LITERALS},
  {metrics}
FROM v_pupil p
{how} v_results r ON r.pupil_id = p.pupil_id AND r.time_period = p.time_period
{how} v_school s ON s.school_id = p.school_id
{where}
GROUP BY {', '.join(SCHOOL)}""",
    )


CUMULATIVE_KEYS = "time_period, establishment_type_group, sex, country_code, country_name"


def cumulative_report(keep_null_groups: bool = False) -> str:
    compare = "IS NOT DISTINCT FROM" if keep_null_groups else "="
    on = " AND ".join(f"t.{k} {compare} n.{k}" for k in CUMULATIVE_KEYS.split(", "))
    return with_views(
        "v_pupil", "v_results", "v_geography",
        extra=f"""n AS (
  SELECT p.time_period, g.country_code, g.country_name, p.establishment_type_group, p.sex, r.mtc_score,
    count(p.pupil_id) AS pupil_count
  FROM v_pupil p
  JOIN v_results r ON r.pupil_id = p.pupil_id AND r.time_period = p.time_period
  JOIN v_geography g ON g.new_la_code = p.new_la_code
  WHERE r.completion_status = 'C' AND g.geographic_level = 'National'
  GROUP BY ALL),
t AS (SELECT {CUMULATIVE_KEYS}, sum(pupil_count) AS total FROM n GROUP BY ALL),
running AS (
  SELECT a.time_period, a.establishment_type_group, a.sex, a.country_code, a.country_name, a.mtc_score,
    sum(b.pupil_count) AS up_to
  FROM n a JOIN n b ON {' AND '.join(f'a.{k} IS NOT DISTINCT FROM b.{k}' for k in CUMULATIVE_KEYS.split(', '))}
    AND (a.mtc_score IS NULL OR b.mtc_score >= a.mtc_score)
  GROUP BY ALL)""",
        body=f"""SELECT n.time_period, 'Academic year' AS time_identifier, 'National' AS geographic_level,
  n.country_code, n.country_name, n.establishment_type_group, n.sex, n.mtc_score, n.pupil_count,
  CAST(u.up_to AS BIGINT) AS cumulative_pupil_count, {pct('u.up_to', 't.total')} AS cumulative_pupil_percent
FROM n JOIN t ON {on}
JOIN running u ON u.mtc_score IS NOT DISTINCT FROM n.mtc_score
  AND {' AND '.join(f'u.{k} IS NOT DISTINCT FROM n.{k}' for k in CUMULATIVE_KEYS.split(', '))}""",
    )


def reports() -> dict[str, str]:
    both = "'Regional', 'Local authority'"
    return {
        "national_pupil": pupil_report(characteristics(), NATIONAL_PUPIL, "'National'"),
        "regional_la_pupil": pupil_report(characteristics(), REGIONAL_PUPIL, both),
        "national_school": school_report(characteristics()),
        "national_cumulative": cumulative_report(),
        "national_school_scores": school_report(scores()),
        "national_pupil_scores": pupil_report(scores(), NATIONAL_PUPIL, "'National'"),
        "regional_la_pupil_scores": pupil_report(scores(), REGIONAL_PUPIL, both),
    }
