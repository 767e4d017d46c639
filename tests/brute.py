"""The reports computed row by row in plain Python, for small inputs."""

from __future__ import annotations

from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

from tallyframe.functions.codes import DEFAULT_LABELS, STANDARD_CODES
from tallyframe.plans.reports import REPORTS


def label(column, code):
    return STANDARD_CODES[column].get(code, DEFAULT_LABELS.get(column, code))


def rounded(numerator, denominator, scale):
    if not denominator or numerator is None:
        return None
    exact = Fraction(numerator, denominator) * (100 if scale == 0 else 1)
    shifted = exact * 10**scale
    whole = int(shifted + Fraction(1, 2)) if shifted >= 0 else -int(-shifted + Fraction(1, 2))
    return float(Decimal(whole) / Decimal(10**scale))


def joined(b, how, claims, school, levels):
    results, claimcare = defaultdict(list), defaultdict(list)
    for r in b["results"]:
        results[r["pupil_id"], r["acad_year_code"]].append(r)
    for c in b["claimcare"]:
        claimcare[c["pupil_id"], c["acad_year_code"]].append(c)
    missing = [{}] if how == "left" else []
    for p in b["pupil"]:
        key = p["pupil_id"], p["acad_year_code"]
        for r in results[key] or missing:
            for c in (claimcare[key] or missing) if claims else [{}]:
                if school:
                    matches = [s for s in b["school"] if s["school_id"] == p["school_id"]] or missing
                else:
                    matches = [
                        g for g in b["geography"]
                        if g["la_new"] == p["la_code_new"] and label("geographic_level", g["geographic_lvl"]) in levels
                    ]
                for m in matches:
                    yield p, r, c, m


PUPIL = {
    "establishment_type_group": "estab_type_group", "sex": "gender", "ethnicity_major": "ethnic_major_group",
    "ethnicity_minor": "ethnic_minor_group", "first_language": "first_lang", "month_of_birth": "birth_month_code",
    "sen_provision": "sen_prov_code", "sen_primary_need": "sen_type_rank",
}
CLAIM = {"disadvantage_status": "claim_type", "fsm_status": "fsm_claim_flag"}
SCHOOL = {
    "establishment_type_group": "estab_type_group", "education_phase": "phase_of_education",
    "school_religious_character": "religious_character", "sex": "gender",
    "country_code": "country_code", "country_name": "country_name",
}
AREA = {
    "geographic_level": "geographic_lvl", "country_code": "country_cd", "country_name": "country_nm",
    "region_code": "gor_code", "region_name": "gor_name", "old_la_code": "la_old", "new_la_code": "la_new",
    "la_name": "la_name_full",
}


def dim(name, p, c, m, school):
    if name == "geographic_level" and school:
        return "National"
    if school:
        source, raw = m, SCHOOL[name]
    elif name in AREA:
        source, raw = m, AREA[name]
    elif name in CLAIM:
        source, raw = c, CLAIM[name]
    else:
        source, raw = p, PUPIL[name]
    if school and not m:
        return None  # the whole school row is missing, so nothing was decoded
    value = source.get(raw)
    return label(name, value) if name in STANDARD_CODES else value


def report(name, b, how="inner", drop_null_groups=True):
    """Rows of a report as tuples in its column order."""
    spec = REPORTS[name]
    school = spec.family == "school"
    claims = spec.family in ("national_pupil", "regional_pupil")
    levels = ("Regional", "Local authority") if spec.family == "regional_pupil" else ("National",)
    groups = defaultdict(list)
    for p, r, c, m in joined(b, how, claims, school, levels):
        if spec.family == "cumulative" and r.get("completion_status") != "C":
            continue
        key = (p["acad_year_code"], "Academic year", *[dim(d, p, c, m, school) for d in spec.dims])
        groups[key].append((p, r))
    out = []
    for key, members in groups.items():
        if spec.family == "cumulative":
            if drop_null_groups and None in key:
                continue
            counts = defaultdict(int)
            for _, r in members:
                counts[r.get("pupil_mark")] += 1
            running = 0
            for score in sorted(counts, key=lambda s: (s is None, -(s or 0))):
                running += counts[score]
                out.append((*key, score, counts[score], running, rounded(running, len(members), 0)))
            continue
        statuses = [r.get("completion_status") for _, r in members]
        marks = [r.get("pupil_mark") for _, r in members]
        v = {
            "establishment_count": len({p["school_id"] for p, _ in members}),
            "eligible_pupil_count": len(members),
            "completed_check_pupil_count": statuses.count("C"),
            "not_completed_check_pupil_count": len(members) - statuses.count("C"),
            "absent_pupil_count": statuses.count("A"),
            "unable_to_participate_pupil_count": statuses.count("U"),
            "working_below_pupil_count": statuses.count("W"),
            "just_arrived_pupil_count": statuses.count("J"),
            "missing_reason_pupil_count": statuses.count("M"),
            "mtc_score_total": sum(m for m in marks if m is not None) if any(m is not None for m in marks) else None,
        }
        done = v["completed_check_pupil_count"]
        v["mtc_score_average"] = rounded(v["mtc_score_total"], done, 1)
        for s in range(26):
            n = sum(1 for st, m in zip(statuses, marks) if st == "C" and m == s)
            v[f"mtc_score_{s}_pupil_count"] = n
            v[f"mtc_score_{s}_pupil_percent"] = rounded(n, done, 0)
        for column in spec.metrics:
            if column.endswith("_percent") and column not in v:
                v[column] = rounded(v[column.replace("_percent", "_count")], len(members), 0)
        out.append((*key, *[v[c] for c in spec.metrics]))
    return sorted(out, key=repr)
