"""Raw tables derived from the generated tables, by the same text in Spark and in the oracle."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from tallyframe.sources.bronze import Bronze

YEARS = ("202122", "202223", "202324", "202425")
_YEARS = "(VALUES ('202122',0),('202223',1),('202324',2),('202425',3)) AS y(acad_year_code, yi)"
_LOADED = "CAST('2025-01-01' AS DATE) AS load_date"
_ESTAB = (
    "CASE c_custkey % 8 WHEN 0 THEN 'AC' WHEN 1 THEN 'AS' WHEN 2 THEN 'FS' WHEN 3 THEN 'LA' WHEN 4 THEN 'AP' "
    "WHEN 5 THEN 'SPEC' WHEN 6 THEN 'QQ' ELSE NULL END AS estab_type_group"
)

SQL: dict[str, str] = {
    "geography": f"""
SELECT 'E06' || lpad(CAST(n_nationkey AS STRING), 6, '0') AS la_new, CAST(800 + n_nationkey AS STRING) AS la_old,
  n_name AS la_name_full, 'E12' || lpad(CAST(r_regionkey AS STRING), 6, '0') AS gor_code, r_name AS gor_name,
  'E92000001' AS country_cd, 'England' AS country_nm, l.geographic_lvl, {_LOADED}
FROM nation JOIN region ON n_regionkey = r_regionkey
CROSS JOIN (VALUES ('LOCAL_AUTHORITY'),('REGIONAL'),('NATIONAL')) AS l(geographic_lvl)""",
    "school": f"""
SELECT CAST(c_custkey AS STRING) AS school_id, 'E06' || lpad(CAST(c_nationkey AS STRING), 6, '0') AS la_code_new,
  CAST(800 + c_nationkey AS STRING) AS la_code_old, 'E92000001' AS country_code, 'England' AS country_name, {_ESTAB},
  CASE c_custkey % 5 WHEN 0 THEN 'PRI' WHEN 1 THEN 'JUN' WHEN 2 THEN 'MID' WHEN 3 THEN 'SEC' ELSE 'ZZ' END
    AS phase_of_education,
  CASE c_custkey % 4 WHEN 0 THEN 'CE' WHEN 1 THEN 'RC' WHEN 2 THEN 'NONE' ELSE NULL END AS religious_character,
  CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'MIXED' END AS gender, {_LOADED}
FROM customer""",
    "pupil": f"""
SELECT CAST(o_orderkey AS STRING) AS pupil_id, y.acad_year_code, CAST(c_custkey AS STRING) AS school_id, {_ESTAB},
  'E06' || lpad(CAST(c_nationkey AS STRING), 6, '0') AS la_code_new, CAST(800 + c_nationkey AS STRING) AS la_code_old,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
  CASE o_orderkey % 3 WHEN 0 THEN 'WHITE' WHEN 1 THEN 'ASIAN' ELSE 'B' END AS ethnic_major_group,
  CASE WHEN o_orderkey % 89 = 0 THEN 'ZZZZ' WHEN o_orderkey % 3 = 0 THEN 'WBRI' WHEN o_orderkey % 3 = 1 THEN 'AIND'
    ELSE 'BAFR' END AS ethnic_minor_group,
  CASE o_orderkey % 4 WHEN 0 THEN 'ENG' WHEN 1 THEN 'OTH' WHEN 2 THEN 'UNK' ELSE 'E' END AS first_lang,
  CASE WHEN o_orderkey % 5 < 2 THEN '1' ELSE '0' END AS disadvantaged_flag,
  CASE WHEN o_orderkey % 4 = 0 THEN 'Y' ELSE 'N' END AS fsm_eligible_flag,
  CASE WHEN o_orderkey % 12 = 8 THEN '09' ELSE CAST(1 + o_orderkey % 12 AS STRING) END AS birth_month_code,
  CASE o_orderkey % 6 WHEN 0 THEN 'E' WHEN 1 THEN 'K' WHEN 2 THEN 'U' ELSE 'N' END AS sen_prov_code,
  CASE o_orderkey % 6 WHEN 0 THEN 'AUT' WHEN 1 THEN 'BESD' ELSE NULL END AS sen_type_rank, {_LOADED}
FROM orders JOIN customer ON o_custkey = c_custkey CROSS JOIN {_YEARS}""",
    "results": f"""
SELECT CAST(o_orderkey AS STRING) AS pupil_id, CAST(o_custkey AS STRING) AS school_id, y.acad_year_code,
  CAST(CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN (o_orderkey + yi) % 23 > 6 THEN (o_orderkey * 5 + yi * 3) % 26
    WHEN (o_orderkey + yi) % 23 = 2 THEN 3 ELSE NULL END AS INT) AS pupil_mark,
  CASE (o_orderkey + yi) % 23 WHEN 0 THEN 'A' WHEN 1 THEN 'U' WHEN 2 THEN 'W' WHEN 3 THEN 'J' WHEN 4 THEN 'M'
    WHEN 5 THEN NULL WHEN 6 THEN 'X' ELSE 'C' END AS completion_status, {_LOADED}
FROM orders CROSS JOIN {_YEARS} WHERE o_orderkey % 50 <> 49""",
    "claimcare": f"""
SELECT CAST(o_orderkey AS STRING) AS pupil_id, y.acad_year_code,
  CASE o_orderkey % 5 WHEN 0 THEN '1' WHEN 1 THEN 'Y' WHEN 2 THEN '0' WHEN 3 THEN 'N' ELSE NULL END AS claim_type,
  CASE o_orderkey % 4 WHEN 0 THEN 'Y' WHEN 1 THEN '0' WHEN 2 THEN 'False' ELSE 'N' END AS fsm_claim_flag,
  '0' AS ever_fsm_6, '0' AS pupil_premium_flag, '0' AS service_child_flag, '0' AS lac_flag, {_LOADED}
FROM orders CROSS JOIN {_YEARS} WHERE o_orderkey % 60 <> 59""",
}

_TABLES = ("nation", "region", "customer", "orders")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _derive(spark: SparkSession, name: str, read: Callable[[str], DataFrame]) -> DataFrame:
    text = SQL[name]
    used = [t for t in _TABLES if re.search(rf"\b(FROM|JOIN) {t}\b", text)]
    for t in used:
        text = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", text)
    return spark.sql(text, **{t: read(t) for t in used})


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One raw table over the files in ``sf_dir``."""
    return _derive(spark, name, lambda t: table(spark, sf_dir, t))


def bronze(spark: SparkSession, sf_dir: str) -> Bronze:
    read = cache(lambda t: table(spark, sf_dir, t))
    return Bronze(**{name: _derive(spark, name, read) for name in SQL})
