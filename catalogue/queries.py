"""The registered queries, each with its oracle SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue import oracle
from catalogue.fixture import YEARS, bronze, derived, table
from tallyframe.functions.codes import STANDARD_CODES
from tallyframe.functions.decode import (
    Labels,
    canonical_columns,
    decode,
    decode_columns,
    decode_with_lookup,
    label_predicate,
)
from tallyframe.functions.metrics import (
    average,
    differs_or_null,
    percent,
    status_counts,
    status_indicators,
    summed,
    wide_distribution,
    wide_percents,
)
from tallyframe.operators.distribution import cumulative, frequencies, group_totals
from tallyframe.operators.periods import (
    compare_periods,
    distinct_periods,
    last_periods,
    period_range,
    union_periods,
)
from tallyframe.operators.shape import rename, round_columns, select_fixed, with_constants, with_time
from tallyframe.plans.incremental import read_report, update_reports
from tallyframe.plans.reports import FILE_NAMES, REGIONAL_AND_LA, REPORTS, area_rows, build_report, scored_pupils
from tallyframe.plans.run import all_reports
from tallyframe.plans.silver import register_views, renamed, silver
from tallyframe.plans.spec import ReportSpec, mapped_columns, profile
from tallyframe.sources.bronze import (
    bronze_from_parquet,
    read_table,
    use_namespace,
    write_bronze_parquet,
    write_bronze_tables,
)
from tallyframe.sources.folders import partition_values
from tallyframe.sources.keyed import absent_rows, insert_if_absent, read_keyed, read_snapshot, write_snapshot
from tallyframe.sources.schemas import BRONZE, PARTITION_COLUMN, PARTITIONED
from tallyframe.sources.sinks import write_csv, write_table, year_suffix
from tallyframe.sources.staging import staging_root

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, query: Query, sql: str | None = None) -> None:
    QUERIES[name] = query
    if sql is not None:
        ORACLES[name] = sql


for _name in oracle.FIXTURE:
    register(
        f"silver_{_name}",
        lambda spark, sf, t=_name: silver(t, derived(spark, sf, t)),
        oracle.with_views(f"v_{_name}", body=f"SELECT * FROM v_{_name}"),
    )

for _name, _sql in oracle.reports().items():
    register(f"report_{_name}", lambda spark, sf, r=_name: build_report(r, bronze(spark, sf)), _sql)


# --- report variants ----------------------------------------------------------

register(
    "report_national_pupil_year",
    lambda spark, sf: build_report("national_pupil", bronze(spark, sf), periods="202324"),
    oracle.pupil_report(
        oracle.characteristics(), oracle.NATIONAL_PUPIL, "'National'", "AND p.time_period = '202324'"
    ),
)

register(
    "report_left_join_variant",
    lambda spark, sf: build_report("national_pupil", bronze(spark, sf), how="left"),
    oracle.pupil_report(oracle.characteristics(), oracle.NATIONAL_PUPIL, "'National'", how="LEFT JOIN"),
)

for _name, _sql in {
    "regional_la_pupil": oracle.pupil_report(
        oracle.characteristics(), oracle.REGIONAL_PUPIL, "'Regional', 'Local authority'", how="LEFT JOIN"
    ),
    "national_school": oracle.school_report(oracle.characteristics(), how="LEFT JOIN"),
    "national_school_scores": oracle.school_report(oracle.scores(), how="LEFT JOIN"),
    "national_pupil_scores": oracle.pupil_report(oracle.scores(), oracle.NATIONAL_PUPIL, "'National'", how="LEFT JOIN"),
    "regional_la_pupil_scores": oracle.pupil_report(
        oracle.scores(), oracle.REGIONAL_PUPIL, "'Regional', 'Local authority'", how="LEFT JOIN"
    ),
    "national_cumulative": ORACLES["report_national_cumulative"],  # without a result nobody has completed
}.items():
    register(f"report_left_{_name}", lambda spark, sf, r=_name: build_report(r, bronze(spark, sf), how="left"), _sql)

for _name, _sql in {
    "national_pupil": oracle.pupil_report(oracle.characteristics(), oracle.NATIONAL_PUPIL, "'National'", default="Total"),
    "national_school": oracle.school_report(oracle.characteristics(), default="Total"),
}.items():
    register(
        f"report_default_total_{_name}",
        lambda spark, sf, r=_name: build_report(r, bronze(spark, sf), default="Total"),
        _sql,
    )

for _name in REPORTS:
    register(
        f"shared_report_{_name}",
        lambda spark, sf, r=_name: all_reports(spark, bronze(spark, sf))[r],
        ORACLES[f"report_{_name}"],
    )

register(
    "report_cumulative_keeping_null_groups",
    lambda spark, sf: build_report("national_cumulative", bronze(spark, sf), drop_null_groups=False),
    oracle.cumulative_report(keep_null_groups=True),
)

register(
    "union_years",
    lambda spark, sf: union_periods(
        lambda year, b=bronze(spark, sf): build_report("national_school", b, periods=year), YEARS
    ),
    ORACLES["report_national_school"],
)

for _order, _name in (
    ("area", "regional_la_pupil"),
    ("establishment", "national_pupil"),
    ("phase", "national_school"),
    ("score", "national_cumulative"),
):
    register(
        f"ordered_report_by_{_order}",
        lambda spark, sf, r=_name: build_report(r, bronze(spark, sf), ordered=True),
        ORACLES[f"report_{_name}"],
    )

register(
    "dimension_filter_preimage",
    lambda spark, sf: build_report(
        "national_pupil",
        bronze(spark, sf),
        filters={"sex": "Girls", "ethnicity_major": "White", "disadvantage_status": "Disadvantaged"},
    ),
    oracle.pupil_report(
        oracle.characteristics(),
        oracle.NATIONAL_PUPIL,
        "'National'",
        "AND p.sex = 'Girls' AND p.ethnicity_major = 'White' AND c.disadvantage_status = 'Disadvantaged'",
    ),
)

register(
    "dimension_filter_region",
    lambda spark, sf: build_report(
        "regional_la_pupil_scores",
        bronze(spark, sf),
        periods=["202324", "202425"],
        filters={"geographic_level": "Regional", "region_name": "EUROPE", "sex": "Total"},
    ),
    oracle.pupil_report(
        oracle.scores(),
        oracle.REGIONAL_PUPIL,
        "'Regional'",
        "AND g.region_name = 'EUROPE' AND p.sex = 'Total' AND p.time_period IN ('202324', '202425')",
    ),
)

register(
    "dimension_filter_phase",
    lambda spark, sf: build_report(
        "national_school", bronze(spark, sf), filters={"education_phase": "Primary", "sex": "Boys"}
    ),
    oracle.school_report(oracle.characteristics(), "WHERE s.education_phase = 'Primary' AND s.sex = 'Boys'"),
)

register(
    "dimension_filter_left",
    lambda spark, sf: build_report(
        "national_pupil", bronze(spark, sf), how="left", filters={"sex": "Girls", "disadvantage_status": "Disadvantaged"}
    ),
    oracle.pupil_report(
        oracle.characteristics(),
        oracle.NATIONAL_PUPIL,
        "'National'",
        "AND p.sex = 'Girls' AND c.disadvantage_status = 'Disadvantaged'",
        how="LEFT JOIN",
    ),
)

_COMPARED = ("eligible_pupil_count", "completed_check_pupil_count", "mtc_score_average")
_SCHOOL_REPORT_DIMS = REPORTS["national_school"].dims
register(
    "compare_periods",
    lambda spark, sf: compare_periods(
        build_report("national_school", bronze(spark, sf), periods=["202324", "202425"]),
        _SCHOOL_REPORT_DIMS,
        _COMPARED,
        "202324",
        "202425",
    ),
    "WITH gold AS (" + ORACLES["report_national_school"] + ")\nSELECT "
    + ", ".join(f"coalesce(a.{d}, b.{d}) AS {d}" for d in _SCHOOL_REPORT_DIMS)
    + ", "
    + ", ".join(
        f"a.{m} AS {m}_before, b.{m} AS {m}_after, b.{m} - a.{m} AS {m}_change, "
        f"round((b.{m} - a.{m}) / nullif(a.{m}, 0) * 100, 1) AS {m}_change_percent"
        for m in _COMPARED
    )
    + "\nFROM (SELECT * FROM gold WHERE time_period = '202324') a"
    + "\nFULL JOIN (SELECT * FROM gold WHERE time_period = '202425') b ON "
    + " AND ".join(f"a.{d} IS NOT DISTINCT FROM b.{d}" for d in _SCHOOL_REPORT_DIMS),
)

# --- decoding -----------------------------------------------------------------

_ORDER_STATUS = {"F": "Filled", "O": "Open"}
_ORDER_STATUS_CASE = "CASE o_orderstatus WHEN 'F' THEN 'Filled' WHEN 'O' THEN 'Open' ELSE {} END AS o_orderstatus"

register(
    "decode_default_total",
    lambda spark, sf: table(spark, sf, "orders").select(
        "o_orderkey", decode("o_orderstatus", _ORDER_STATUS, "Total").alias("o_orderstatus")
    ),
    f"SELECT o_orderkey, {_ORDER_STATUS_CASE.format(chr(39) + 'Total' + chr(39))} FROM orders",
)

register(
    "decode_passthrough",
    lambda spark, sf: table(spark, sf, "orders").select(
        "o_orderkey", decode("o_orderstatus", _ORDER_STATUS).alias("o_orderstatus")
    ),
    f"SELECT o_orderkey, {_ORDER_STATUS_CASE.format('o_orderstatus')} FROM orders",
)


def _decode_join_lookup(spark: SparkSession, sf: str) -> DataFrame:
    lookup = table(spark, sf, "nation").select(
        F.lit("nation").alias("column"), F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("label")
    )
    customers = table(spark, sf, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("string").alias("nation")
    )
    return decode_with_lookup(customers, "nation", lookup.filter("label < 'R'"))


register(
    "decode_join_lookup",
    _decode_join_lookup,
    """SELECT c_custkey, coalesce(n_name, CAST(c_nationkey AS VARCHAR)) AS nation
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND n_name < 'R'""",
)

# Every code of every decoder beside an unknown code and NULL, spread over the orders.
_ALL_CODES = {c: [*codes, "unknown code", None] for c, codes in STANDARD_CODES.items()}


def _every_code(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")

    def pick(codes):
        options = F.array(*[F.lit(c) for c in codes])
        return F.element_at(options, (F.col("o_orderkey") % len(codes) + 1).cast("int"))

    return orders.select("o_orderkey", *[pick(codes).alias(c) for c, codes in _ALL_CODES.items()])


def _every_code_sql(body: str) -> str:
    picks = ", ".join(
        "([" + ", ".join("NULL" if c is None else f"'{c}'" for c in codes) + f"])[o_orderkey % {len(codes)} + 1] AS {column}"
        for column, codes in _ALL_CODES.items()
    )
    return f"WITH {oracle.codes_cte()}, raw AS (SELECT o_orderkey, {picks} FROM orders)\n{body}"


register(
    "decode_every_code",
    lambda spark, sf: decode_columns(_every_code(spark, sf)),
    _every_code_sql(
        "SELECT o_orderkey, " + ", ".join(f"{oracle.label(c, c)} AS {c}" for c in _ALL_CODES) + " FROM raw"
    ),
)

register(
    "decode_every_code_default_total",
    lambda spark, sf: decode_columns(_every_code(spark, sf), default="Total"),
    _every_code_sql(
        "SELECT o_orderkey, "
        + ", ".join(
            f"coalesce((SELECT k.label FROM codes k WHERE k.col = '{c}' AND k.code = {c}), 'Total') AS {c}"
            for c in _ALL_CODES
        )
        + " FROM raw"
    ),
)

_CANONICAL_PAIR = ("ethnicity_minor", "sex")
register(
    "decode_after_grouping",
    lambda spark, sf: decode_columns(
        canonical_columns(_every_code(spark, sf), _CANONICAL_PAIR).groupBy(*_CANONICAL_PAIR).agg(F.count("*").alias("n"))
    ),
    _every_code_sql(
        "SELECT "
        + ", ".join(f"{oracle.label(c, c)} AS {c}" for c in _CANONICAL_PAIR)
        + ", count(*) AS n FROM raw GROUP BY 1, 2"
    ),
)

# --- shape, filters, joins ----------------------------------------------------

register(
    "rename_and_fixed_schema",
    lambda spark, sf: select_fixed(
        round_columns(
            rename(
                table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal"),
                {"c_custkey": "customer_id", "c_name": "customer_name", "c_absent": "absent"},
            ),
            ["c_acctbal", "c_other"],
        ).drop("c_name"),
        {"customer_name": "string", "customer_id": "bigint", "c_acctbal": "double", "region": "string", "visits": "int"},
    ),
    """SELECT c_name AS customer_name, c_custkey AS customer_id, round(c_acctbal, 1) AS c_acctbal,
  CAST(NULL AS VARCHAR) AS region, CAST(NULL AS INTEGER) AS visits FROM customer""",
)

register(
    "constant_columns",
    lambda spark, sf: with_constants(
        with_time(table(spark, sf, "customer").select("c_custkey"), "202122"), geographic_level="National"
    ),
    """SELECT c_custkey, '202122' AS time_period, 'Academic year' AS time_identifier,
  'National' AS geographic_level FROM customer""",
)

register(
    "mapping_table_rename",
    lambda spark, sf: mapped_columns(
        table(spark, sf, "customer"),
        spark.createDataFrame(
            [
                ("balances", "c_custkey", "account"),
                ("balances", "c_acctbal", "balance"),
                ("balances", "c_mktsegment", "segment"),
                ("balances", "c_mktsegment", "market"),
                ("balances", "c_missing", "missing"),
                ("other", "c_custkey", "id"),
            ],
            "report_id string, source_column string, target_column string",
        ),
        "balances",
    ),
    "SELECT c_custkey AS account, c_acctbal AS balance, c_mktsegment AS segment, c_mktsegment AS market FROM customer",
)

register(
    "null_aware_inequality",
    lambda spark, sf: derived(spark, sf, "results").filter(differs_or_null("completion_status", "C")).select(
        "pupil_id", "acad_year_code", "completion_status"
    ),
    oracle.with_tables(
        "results",
        body="SELECT pupil_id, acad_year_code, completion_status FROM results "
        "WHERE completion_status <> 'C' OR completion_status IS NULL",
    ),
)

_LEVEL_DIMS = ("geographic_level", "region_name", "la_name")
register(
    "level_filter_bridge",
    lambda spark, sf: frequencies(
        renamed("pupil", derived(spark, sf, "pupil"), "pupil_id", "new_la_code"), ["new_la_code"], "pupil_rows", "pupil_id"
    )
    .join(
        area_rows(derived(spark, sf, "geography"), REGIONAL_AND_LA, Labels(), "new_la_code", *_LEVEL_DIMS), "new_la_code"
    )
    .groupBy(*_LEVEL_DIMS)
    .agg(*summed(["pupil_rows"])),
    oracle.with_views(
        "v_pupil", "v_geography",
        body="""SELECT g.geographic_level, g.region_name, g.la_name, count(p.pupil_id) AS pupil_rows
FROM v_pupil p JOIN v_geography g USING (new_la_code)
WHERE g.geographic_level <> 'National' GROUP BY ALL""",
    ),
)

register(
    "label_predicate_default_label",
    lambda spark, sf: derived(spark, sf, "pupil").filter(
        label_predicate("gender", "Total", STANDARD_CODES["sex"], "Total")
        | label_predicate("ethnic_minor_group", ["ZZZZ", "Indian"], STANDARD_CODES["ethnicity_minor"])
    ).select("pupil_id", "acad_year_code", "gender", "ethnic_minor_group"),
    oracle.with_views(
        "v_pupil",
        body="""SELECT p.pupil_id, p.acad_year_code, p.gender, p.ethnic_minor_group FROM pupil p
WHERE coalesce(p.gender, '') NOT IN ('M', 'F') OR p.ethnic_minor_group IN ('ZZZZ', 'AIND', 'Indian')""",
    ),
)

# --- aggregates on other tables -----------------------------------------------

_FLAGS = {"A": "accepted_count", "N": "none_count", "R": "returned_count"}


def _status_counts_by_segment(spark: SparkSession, sf: str) -> DataFrame:
    # The dimension sits two joins away, so lines are summed per order and orders per customer first.
    counts = ["line_count", "not_accepted_count", *_FLAGS.values()]
    per_order = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.count("l_linenumber").alias("line_count"),
        F.count_if(differs_or_null("l_returnflag", "A")).alias("not_accepted_count"),
        *status_counts("l_returnflag", _FLAGS),
    )
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    per_customer = (
        per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey").agg(*summed(counts))
    )
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return (
        per_customer.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_mktsegment")
        .agg(*summed(counts))
        .select("*", *[percent(n, "line_count").alias(n.replace("_count", "_percent")) for n in counts[1:]])
    )


_FLAG_SQL = {"not_accepted": "IS DISTINCT FROM 'A'", **{n.removesuffix("_count"): f"= '{c}'" for c, n in _FLAGS.items()}}
register(
    "status_counts_by_segment",
    _status_counts_by_segment,
    "SELECT c_mktsegment, count(l_linenumber) AS line_count, "
    + ", ".join(
        f"count(*) FILTER (WHERE l_returnflag {test}) AS {n}_count, "
        f"round(count(*) FILTER (WHERE l_returnflag {test}) / nullif(count(l_linenumber), 0) * 100, 0) AS {n}_percent"
        for n, test in _FLAG_SQL.items()
    )
    + " FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey GROUP BY c_mktsegment",
)

register(
    "status_indicators",
    lambda spark, sf: table(spark, sf, "lineitem")
    .select("l_orderkey", "l_linenumber", "l_returnflag")
    .withColumns(status_indicators("l_returnflag", {"A": "is_accepted", "R": "is_returned"})),
    """SELECT l_orderkey, l_linenumber, l_returnflag, CAST(l_returnflag IS NOT DISTINCT FROM 'A' AS INTEGER) AS is_accepted,
  CAST(l_returnflag IS NOT DISTINCT FROM 'R' AS INTEGER) AS is_returned FROM lineitem""",
)


def _distinct_and_guarded_average(spark: SparkSession, sf: str) -> DataFrame:
    per_customer = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count("o_orderkey").alias("order_count"),
        F.count_if(F.col("o_orderstatus") == "P").alias("pending_count"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"),
    )
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return (
        per_customer.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey")
        .agg(
            F.countDistinct("c_custkey").alias("customer_count"),
            *summed(["order_count", "pending_count"]),
            F.sum("total").cast("double").alias("price_total"),
        )
        .withColumn("price_per_pending", average("price_total", "pending_count"))
    )


register(
    "distinct_and_guarded_average",
    _distinct_and_guarded_average,
    """SELECT c_nationkey, count(DISTINCT c_custkey) AS customer_count, count(o_orderkey) AS order_count,
  count(*) FILTER (WHERE o_orderstatus = 'P') AS pending_count,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS price_total,
  round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE)
    / nullif(count(*) FILTER (WHERE o_orderstatus = 'P'), 0), 1) AS price_per_pending
FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY c_nationkey""",
)

_QUANTITIES = range(50, 0, -1)
register(
    "wide_quantity_distribution",
    lambda spark, sf: table(spark, sf, "lineitem")
    .groupBy("l_linestatus")
    .agg(
        F.count_if(F.col("l_returnflag") != "N").alias("settled_count"),
        *wide_distribution("l_quantity", _QUANTITIES, "quantity_{}_count", when="l_returnflag <> 'N'"),
    )
    .select(
        "*", *wide_percents(_QUANTITIES, "quantity_{}_count", "settled_count", "quantity_{}_percent")
    ),
    "SELECT l_linestatus, count(*) FILTER (WHERE l_returnflag <> 'N') AS settled_count, "
    + ", ".join(
        f"count(*) FILTER (WHERE l_returnflag <> 'N' AND l_quantity = {q}) AS quantity_{q}_count, "
        f"round(count(*) FILTER (WHERE l_returnflag <> 'N' AND l_quantity = {q}) "
        f"/ nullif(count(*) FILTER (WHERE l_returnflag <> 'N'), 0) * 100, 0) AS quantity_{q}_percent"
        for q in _QUANTITIES
    )
    + " FROM lineitem GROUP BY l_linestatus",
)

def _cumulative_quantity(spark: SparkSession, sf: str, descending: bool = True) -> DataFrame:
    counts = frequencies(
        table(spark, sf, "lineitem").withColumn("l_quantity", F.col("l_quantity").cast("int")),
        ["l_returnflag", "l_quantity"],
        "line_count",
    )
    return cumulative(
        counts, ["l_returnflag"], "l_quantity", "line_count", "running_count", "running_percent", descending
    )


def _cumulative_quantity_sql(direction: str) -> str:
    return f"""WITH n AS (SELECT l_returnflag, CAST(l_quantity AS INTEGER) AS l_quantity, count(*) AS line_count
  FROM lineitem GROUP BY ALL)
SELECT l_returnflag, l_quantity, line_count,
  CAST(sum(line_count) OVER w AS BIGINT) AS running_count,
  round(sum(line_count) OVER w / sum(line_count) OVER (PARTITION BY l_returnflag) * 100, 0) AS running_percent
FROM n WINDOW w AS (PARTITION BY l_returnflag ORDER BY l_quantity {direction} ROWS UNBOUNDED PRECEDING)"""


register("cumulative_quantity", _cumulative_quantity, _cumulative_quantity_sql("DESC"))
register(
    "cumulative_quantity_ascending",
    lambda spark, sf: _cumulative_quantity(spark, sf, descending=False),
    _cumulative_quantity_sql("ASC"),
)


def _cumulative_without_null_groups(spark: SparkSession, sf: str) -> DataFrame:
    counts = frequencies(
        scored_pupils(bronze(spark, sf), "establishment_type_group", "sex"),
        ["time_period", "establishment_type_group", "sex", "mtc_score"],
        "pupil_count",
    )
    return cumulative(
        counts, ["time_period", "establishment_type_group", "sex"], "mtc_score", "pupil_count",
        "running_count", "running_percent", drop_null_groups=True,
    )


_RAW_SCORES = """n AS (SELECT p.acad_year_code AS time_period, estab_type_group AS establishment_type_group,
    gender AS sex, pupil_mark AS mtc_score, count(*) AS pupil_count
  FROM pupil p JOIN results r ON r.pupil_id = p.pupil_id AND r.acad_year_code = p.acad_year_code GROUP BY ALL)"""
register(
    "cumulative_without_null_groups",
    _cumulative_without_null_groups,
    oracle.with_tables(
        "pupil", "results",
        body="SELECT * FROM (WITH " + _RAW_SCORES + """,
t AS (SELECT time_period, establishment_type_group, sex, sum(pupil_count) AS total FROM n GROUP BY ALL)
SELECT time_period, establishment_type_group, sex, mtc_score, pupil_count,
  CAST(sum(pupil_count) OVER w AS BIGINT) AS running_count,
  round(sum(pupil_count) OVER w / nullif(total, 0) * 100, 0) AS running_percent
FROM n JOIN t USING (time_period, establishment_type_group, sex)
WINDOW w AS (PARTITION BY time_period, establishment_type_group, sex ORDER BY mtc_score DESC NULLS LAST
  ROWS UNBOUNDED PRECEDING))""",
    ),
)

register(
    "frequency_totals",
    lambda spark, sf: group_totals(
        frequencies(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus", "l_quantity"], "line_count"),
        ["l_returnflag", "l_linestatus"], "line_count", "total_lines",
    ),
    "SELECT l_returnflag, l_linestatus, count(*) AS total_lines FROM lineitem GROUP BY ALL",
)

# --- described reports --------------------------------------------------------

SPEC = ReportSpec(
    base="customer",
    joins={"orders": ("c_custkey", "o_custkey")},
    columns={
        "segment": "customer.c_mktsegment",
        "nation": "customer.c_nationkey",
        "customers": "count(DISTINCT customer.c_custkey)",
        "orders": "count(orders.o_orderkey)",
        "open_orders": "count_if(orders.o_orderstatus = 'O')",
        "first_order": "min(orders.o_orderkey)",
    },
    filters=("customer.c_acctbal > 0", "orders.o_orderpriority IS NULL OR orders.o_orderpriority <> '5-LOW'"),
    group_by=("segment", "nation"),
    order_by=("segment", "orders DESC"),
)
_SPEC_ROWS = """FROM customer LEFT JOIN orders ON c_custkey = o_custkey
WHERE c_acctbal > 0 AND (o_orderpriority IS NULL OR o_orderpriority <> '5-LOW')"""

_DETAIL_SPEC = ReportSpec(
    base="customer",
    joins={"orders": ("c_custkey", "o_custkey")},
    columns={"customer": "customer.c_custkey", "order": "orders.o_orderkey", "status": "lower(orders.o_orderstatus)"},
)


def _spec_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {t: table(spark, sf, t) for t in ("customer", "orders")}


register(
    "spec_report",
    lambda spark, sf: SPEC.build(_spec_tables(spark, sf)),
    f"""SELECT c_mktsegment AS segment, c_nationkey AS nation, count(DISTINCT c_custkey) AS customers,
  count(o_orderkey) AS orders, count(*) FILTER (WHERE o_orderstatus = 'O') AS open_orders, min(o_orderkey) AS first_order
{_SPEC_ROWS} GROUP BY ALL""",
)

register(
    "spec_report_without_groups",
    lambda spark, sf: _DETAIL_SPEC.build(_spec_tables(spark, sf)),
    """SELECT c_custkey AS customer, o_orderkey AS "order", lower(o_orderstatus) AS status
FROM customer LEFT JOIN orders ON c_custkey = o_custkey""",
)

register(
    "spec_validation",
    lambda spark, sf: profile(_DETAIL_SPEC.build(_spec_tables(spark, sf))),
    "\nUNION ALL\n".join(
        f"SELECT '{name}' AS column_name, count(*) AS row_count, count({col}) AS value_count, "
        f"count(*) - count({col}) AS null_count FROM customer LEFT JOIN orders ON c_custkey = o_custkey"
        for name, col in (("customer", "c_custkey"), ("order", "o_orderkey"), ("status", "o_orderstatus"))
    ),
)

# --- periods ------------------------------------------------------------------

register(
    "distinct_periods",
    lambda spark, sf: distinct_periods(derived(spark, sf, "pupil"), "acad_year_code"),
    oracle.with_tables("pupil", body="SELECT DISTINCT acad_year_code FROM pupil"),
)

register(
    "last_n_periods",
    lambda spark, sf: last_periods(derived(spark, sf, "pupil"), 3, "acad_year_code").select(
        "pupil_id", "acad_year_code", "school_id"
    ),
    oracle.with_tables(
        "pupil",
        body="SELECT pupil_id, acad_year_code, school_id FROM pupil WHERE acad_year_code IN "
        "(SELECT DISTINCT acad_year_code FROM pupil ORDER BY 1 DESC LIMIT 3)",
    ),
)

register(
    "latest_period",
    lambda spark, sf: last_periods(derived(spark, sf, "results"), column="acad_year_code").select("pupil_id", "pupil_mark"),
    oracle.with_tables(
        "results",
        body="SELECT pupil_id, pupil_mark FROM results WHERE acad_year_code = (SELECT max(acad_year_code) FROM results)",
    ),
)

register(
    "period_range",
    lambda spark, sf: period_range(derived(spark, sf, "pupil"), "202223", "202324", "acad_year_code").select(
        "pupil_id", "acad_year_code"
    ),
    oracle.with_tables(
        "pupil",
        body="SELECT pupil_id, acad_year_code FROM pupil WHERE acad_year_code IN ('202223', '202324')",
    ),
)

# --- stored results -----------------------------------------------------------


def _folder(spark: SparkSession, name: str) -> str:
    return f"{staging_root(spark)}/rows-{name}-{uuid.uuid4().hex}"


def _snapshot_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    stamped = F.expr("timestamp_micros(cast(pupil_id AS bigint) * 86400123457)")
    pupils = derived(spark, sf, "pupil").withColumn("stamped", stamped)
    path, taken_at = _folder(spark, "snapshot"), datetime(2025, 1, 1)
    write_snapshot(pupils.limit(0), path, "PUPILS_V1", datetime(2024, 1, 1))
    write_snapshot(pupils, path, "PUPILS_V1", taken_at)
    back = read_snapshot(spark, path, "PUPILS_V1", pupils.schema)
    return back.withColumns(
        {"load_date": F.col("load_date").cast("string"), "stamped": F.unix_micros("stamped")}
    )


register(
    "snapshot_roundtrip",
    _snapshot_roundtrip,
    oracle.with_tables(
        "pupil",
        body="SELECT * EXCLUDE (load_date), CAST(load_date AS VARCHAR) AS load_date, "
        "CAST(pupil_id AS BIGINT) * 86400123457 AS stamped FROM pupil",
    ),
)


def _declared(spark: SparkSession, sf: str, name: str) -> DataFrame:
    root = _folder(spark, "bronze")
    write_bronze_parquet({name: derived(spark, sf, name)}, root)
    stored = spark.read.schema(BRONZE[name]).parquet(f"{root}/{name}")
    return stored.withColumn("load_date", F.col("load_date").cast("string"))


for _name in BRONZE:
    register(
        f"declared_table_{_name}",
        lambda spark, sf, t=_name: _declared(spark, sf, t),
        oracle.with_tables(
            _name, body=f"SELECT * EXCLUDE (load_date), CAST(load_date AS VARCHAR) AS load_date FROM {_name}"
        ),
    )


def _catalog_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    schema = f"rows_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {schema}")
    write_bronze_tables({"results": derived(spark, sf, "results")}, schema, buckets=4)
    stored = read_table(spark, "results", schema)
    return stored.select("pupil_id", "school_id", "acad_year_code", "pupil_mark", "completion_status")


register(
    "catalog_table_roundtrip",
    _catalog_roundtrip,
    oracle.with_tables(
        "results", body="SELECT pupil_id, school_id, acad_year_code, pupil_mark, completion_status FROM results"
    ),
)


def _gold_table(spark: SparkSession, sf: str) -> DataFrame:
    schema = f"rows_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {schema}")
    write_table(build_report("national_school", bronze(spark, sf)), "gold", schema)
    return read_table(spark, "gold", schema)


register("gold_table_roundtrip", _gold_table, ORACLES["report_national_school"])


def _csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    report, path = REPORTS["national_cumulative"], _folder(spark, "csv")
    write_csv(build_report("national_cumulative", bronze(spark, sf)), path, 3, report.sort_keys())
    return spark.read.option("header", True).schema(report.schema).csv(path)


register("csv_roundtrip", _csv_roundtrip, ORACLES["report_national_cumulative"])


def _views_from_sql(spark: SparkSession, sf: str) -> DataFrame:
    register_views(bronze(spark, sf))
    return spark.sql(
        "SELECT p.sex, s.education_phase, count(*) AS pupils, sum(r.mtc_score) AS marks FROM v_pupil p "
        "JOIN v_results r USING (pupil_id, time_period) JOIN v_school s ON s.school_id = p.school_id GROUP BY ALL"
    )


register(
    "views_from_sql",
    _views_from_sql,
    oracle.with_views(
        "v_pupil", "v_results", "v_school",
        body="SELECT p.sex, s.education_phase, count(*) AS pupils, CAST(sum(r.mtc_score) AS BIGINT) AS marks FROM v_pupil p "
        "JOIN v_results r USING (pupil_id, time_period) JOIN v_school s ON s.school_id = p.school_id GROUP BY ALL",
    ),
)


def _insert_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    keys = ["pupil_id", "acad_year_code"]
    new = (
        derived(spark, sf, "pupil").select(*keys, F.lit("pupil").alias("origin"))
        .unionByName(derived(spark, sf, "claimcare").select(*keys, F.lit("claimcare").alias("origin")))
    )
    return absent_rows(derived(spark, sf, "results"), new, keys)


register(
    "insert_if_absent",
    _insert_if_absent,
    oracle.with_tables(
        "pupil", "claimcare", "results",
        body="""SELECT pupil_id, acad_year_code, min(origin) AS origin FROM (
  SELECT pupil_id, acad_year_code, 'pupil' AS origin FROM pupil
  UNION ALL SELECT pupil_id, acad_year_code, 'claimcare' FROM claimcare) n
WHERE NOT EXISTS (SELECT 1 FROM results r WHERE r.pupil_id = n.pupil_id AND r.acad_year_code = n.acad_year_code)
GROUP BY ALL""",
    ),
)


def _insert_if_absent_null_keys(spark: SparkSession, sf: str) -> DataFrame:
    keys = ["completion_status", "pupil_mark"]
    results = derived(spark, sf, "results")
    existing = results.filter("pupil_mark < 20 OR pupil_mark IS NULL AND completion_status = 'A'").select(*keys)
    new = results.select(*keys, "pupil_id")
    path = _folder(spark, "absent")
    for _ in range(2):
        insert_if_absent(spark, path, absent_rows(existing, new, keys), keys)
    return spark.read.parquet(path)


register(
    "insert_if_absent_null_keys",
    _insert_if_absent_null_keys,
    oracle.with_tables(
        "results",
        body="""SELECT completion_status, pupil_mark, min(pupil_id) AS pupil_id FROM results n
WHERE NOT EXISTS (SELECT 1 FROM results r WHERE (r.pupil_mark < 20 OR r.pupil_mark IS NULL AND r.completion_status = 'A')
  AND r.completion_status IS NOT DISTINCT FROM n.completion_status AND r.pupil_mark IS NOT DISTINCT FROM n.pupil_mark)
GROUP BY ALL""",
    ),
)


# --- stored tables ------------------------------------------------------------


def _stored_bronze(spark: SparkSession, sf: str, *names: str) -> str:
    root = _folder(spark, "stored")
    write_bronze_parquet({n: derived(spark, sf, n) for n in names or BRONZE}, root)
    return root


def _listed_periods(spark: SparkSession, sf: str) -> DataFrame:
    root = _stored_bronze(spark, sf, "pupil")
    years = partition_values(spark, f"{root}/pupil", PARTITION_COLUMN)
    return spark.createDataFrame([(y,) for y in years], "acad_year_code string")


register("listed_periods", _listed_periods, ORACLES["distinct_periods"])


def _stored_last_periods(spark: SparkSession, sf: str) -> DataFrame:
    root = _stored_bronze(spark, sf, "pupil")
    pupils = spark.read.schema(BRONZE["pupil"]).parquet(f"{root}/pupil")
    years = partition_values(spark, f"{root}/pupil", PARTITION_COLUMN)
    return last_periods(pupils, 3, PARTITION_COLUMN, years).select("pupil_id", "acad_year_code", "school_id")


register("stored_last_periods", _stored_last_periods, ORACLES["last_n_periods"])


def _updated_by_year(spark: SparkSession, sf: str) -> DataFrame:
    """Reports of three years, then the fourth year's raw rows, then of what is new."""
    root, out = _folder(spark, "stored"), _folder(spark, "updated")
    tables = {n: derived(spark, sf, n) for n in BRONZE}
    late = F.col(PARTITION_COLUMN) == YEARS[-1]
    write_bronze_parquet({n: df.filter(~late) if n in PARTITIONED else df for n, df in tables.items()}, root)
    update_reports(spark, root, out)
    write_bronze_parquet({n: tables[n].filter(late) for n in PARTITIONED}, root, mode="append")
    if update_reports(spark, root, out) != [YEARS[-1]]:
        raise AssertionError("a year without changes was made again")
    return read_report(spark, out, "national_school")


register("reports_updated_by_year", _updated_by_year, ORACLES["report_national_school"])


def _replaced_table(spark: SparkSession, sf: str) -> DataFrame:
    """A gold table that is replaced, through a write that fails."""
    schema = f"rows_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {schema}")
    report = build_report("national_school", bronze(spark, sf))
    write_table(report.filter("time_period < '202324'"), "gold", schema)
    write_table(report, "gold", schema)
    broken = report.withColumn("sex", F.when(F.col("sex") < "\uffff", F.raise_error("broken").cast("string")))
    try:
        write_table(broken, "gold", schema)
    except Exception as e:  # noqa: BLE001
        if "broken" not in str(e):
            raise
    return read_table(spark, "gold", schema)


register("gold_table_replaced", _replaced_table, ORACLES["report_national_school"])


def _keyed_inserts(spark: SparkSession, sf: str) -> DataFrame:
    """Three inserts, the last one twice, into a table laid out by key."""
    keys, path = ["pupil_id", "acad_year_code"], _folder(spark, "keyed")
    for name in ("results", "claimcare", "pupil", "pupil"):
        new = derived(spark, sf, name).select(*keys, F.lit(name).alias("origin"))
        insert_if_absent(spark, path, new, keys, buckets=16)
    return read_keyed(spark, path, new.schema)


register(
    "insert_if_absent_by_key_bucket",
    _keyed_inserts,
    oracle.with_tables(
        "pupil", "claimcare", "results",
        body="""SELECT pupil_id, acad_year_code, max(origin) AS origin FROM (
  SELECT pupil_id, acad_year_code, 'pupil' AS origin FROM pupil p
  WHERE NOT EXISTS (SELECT 1 FROM claimcare c WHERE c.pupil_id = p.pupil_id AND c.acad_year_code = p.acad_year_code)
    AND NOT EXISTS (SELECT 1 FROM results r WHERE r.pupil_id = p.pupil_id AND r.acad_year_code = p.acad_year_code)
  UNION ALL SELECT pupil_id, acad_year_code, 'claimcare' FROM claimcare
  UNION ALL SELECT pupil_id, acad_year_code, 'results' FROM results) n
GROUP BY ALL""",
    ),
)


def _named_by_years(spark: SparkSession, sf: str) -> DataFrame:
    """A CSV folder with its published name, found again by that name."""
    report, root = REPORTS["national_cumulative"], _folder(spark, "named")
    name = FILE_NAMES["national_cumulative"].format(years=year_suffix(YEARS))
    write_csv(build_report("national_cumulative", bronze(spark, sf)), f"{root}/{name}", 3, report.sort_keys())
    stored = spark.read.option("header", True).schema(report.schema)
    return stored.csv(f"{root}/mtc_national_cumulative_score_distribution_2022_to_2025")


register("csv_named_by_years", _named_by_years, ORACLES["report_national_cumulative"])


def _namespace(spark: SparkSession, sf: str) -> DataFrame:
    """A table by its bare name in the schema that is current."""
    schema, before = f"rows_{uuid.uuid4().hex}", spark.catalog.currentDatabase()
    spark.sql(f"CREATE DATABASE {schema}")
    write_bronze_tables({"results": derived(spark, sf, "results")}, schema)
    use_namespace(spark, schema=schema)
    try:
        stored = read_table(spark, "results")
    finally:
        use_namespace(spark, schema=before)
    return stored.select("pupil_id", "school_id", "acad_year_code", "pupil_mark", "completion_status")


register("namespace_selection", _namespace, ORACLES["catalog_table_roundtrip"])

register(
    "report_with_bridge_check",
    lambda spark, sf: build_report("national_pupil", bronze(spark, sf), check_bridge=True),
    ORACLES["report_national_pupil"],
)


def _checked_bronze(spark: SparkSession, sf: str) -> DataFrame:
    stored = bronze_from_parquet(spark, _stored_bronze(spark, sf), check=True)
    return stored.results.groupBy("acad_year_code").agg(F.count(F.lit(1)).alias("rows"), F.sum("pupil_mark").alias("marks"))


register(
    "checked_schemas",
    _checked_bronze,
    oracle.with_tables(
        "results",
        body="SELECT acad_year_code, count(*) AS rows, CAST(sum(pupil_mark) AS BIGINT) AS marks FROM results GROUP BY ALL",
    ),
)
