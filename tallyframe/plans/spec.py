"""Reports described as data: columns, joins, filters, groups and order."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.operators.shape import all_of


@dataclass(frozen=True)
class ReportSpec:
    """``columns`` maps each output column to a source column (``table.column``) or a SQL expression.

    The base table is left-joined to each table of ``joins`` (table -> key column, or (base column, table
    column)). ``filters`` are SQL conditions that must all hold. With ``group_by``, a list of output
    columns, all other columns must be aggregate expressions. ``order_by`` takes output columns, with an
    optional `` DESC``.
    """

    base: str
    columns: Mapping[str, str]
    joins: Mapping[str, str | tuple[str, str]] = field(default_factory=dict)
    filters: tuple[str, ...] = ()
    group_by: tuple[str, ...] = ()
    order_by: tuple[str, ...] = ()

    def tables(self) -> tuple[str, ...]:
        return (self.base, *self.joins)

    def build(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        unknown = [c for c in self.group_by if c not in self.columns]
        if unknown:
            raise ValueError(f"group_by columns without a definition: {unknown}")
        rows = tables[self.base].alias(self.base)
        for table, key in self.joins.items():
            left, right = (key, key) if isinstance(key, str) else key
            on = F.col(f"{self.base}.{left}") == F.col(f"{table}.{right}")
            rows = rows.join(tables[table].alias(table), on, "left")
        if self.filters:
            rows = rows.filter(all_of(F.expr(f) for f in self.filters))
        outputs = {name: F.expr(e).alias(name) for name, e in self.columns.items()}
        if self.group_by:
            keys = [outputs[c] for c in self.group_by]
            values = [c for name, c in outputs.items() if name not in self.group_by]
            grouped = rows.groupBy(*keys)
            result = (grouped.agg(*values) if values else rows.select(*keys).distinct()).select(*self.columns)
        else:
            result = rows.select(*outputs.values())
        if self.order_by:
            result = result.orderBy(*[self._sort_key(o) for o in self.order_by])
        return result

    @staticmethod
    def _sort_key(item: str):
        name, direction = re.fullmatch(r"(.*?)(?:\s+(ASC|DESC))?\s*", item, re.IGNORECASE | re.DOTALL).groups()
        column = F.col("`" + name.replace("`", "``") + "`")
        return column.desc() if (direction or "").upper() == "DESC" else column.asc()


@dataclass(frozen=True)
class Validation:
    """Outcome of checking a spec against data."""

    valid: bool
    row_count: int
    columns: tuple[str, ...]
    warnings: tuple[str, ...]
    errors: tuple[str, ...]


def profile(df: DataFrame) -> DataFrame:
    """One row per column: rows, NULLs and non-NULLs, from a single aggregation over ``df``."""
    counts = df.agg(F.count("*").alias("n"), *[F.count(F.col(c)).alias(f"v_{i}") for i, c in enumerate(df.columns)])
    entries = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"v_{i}").alias("value_count")) for i, c in enumerate(df.columns)]
    )
    return counts.select("n", F.explode(entries).alias("e")).select(
        F.col("e.column_name"),
        F.col("n").alias("row_count"),
        F.col("e.value_count"),
        (F.col("n") - F.col("e.value_count")).alias("null_count"),
    )


def hash_sample(df: DataFrame, rows: int) -> DataFrame:
    """``rows`` rows of ``df`` (all, if it has no more), the same ones however the rows are dealt and ordered.

    Those with the smallest hashes of all their columns, for which each task hands on ``rows`` rows at most. Columns of maps, which
    have no hash, don't count. The table is read once.
    """
    hashed = [F.col("`" + f.name.replace("`", "``") + "`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    if not hashed:
        return df.limit(rows)
    return df.orderBy(F.xxhash64(*hashed), F.xxhash64(F.lit(1), *hashed)).limit(rows)


def validate(
    spec: ReportSpec,
    tables: Mapping[str, DataFrame],
    expected: T.StructType | None = None,
    sample_rows: int | None = None,
) -> Validation:
    """Build a spec, compare its columns with an expected schema and count its rows and NULLs.

    ``sample_rows`` runs it over that many rows of the base table instead of all of them, a sample by hash that is the
    same in every run. Only one row per output column reaches the driver.
    """
    missing = [t for t in spec.tables() if t not in tables]
    if missing:
        return Validation(False, 0, (), (), tuple(f"no table {t}" for t in missing))
    if sample_rows is not None:
        tables = {**tables, spec.base: hash_sample(tables[spec.base], sample_rows)}
    try:
        df = spec.build(tables)
        schema = df.schema
    except (AnalysisException, ValueError) as e:
        return Validation(False, 0, (), (), (str(e).splitlines()[0],))
    errors: list[str] = []
    warnings: list[str] = []
    if expected is not None:
        found = {f.name: f.dataType for f in schema.fields}
        for f in expected.fields:
            if f.name not in found:
                errors.append(f"no column {f.name}")
            elif found[f.name] != f.dataType:
                errors.append(
                    f"column {f.name} is {found[f.name].simpleString()}, not {f.dataType.simpleString()}"
                )
        warnings += [f"column {n} is not expected" for n in found if n not in expected.fieldNames()]
    counted = profile(df).collect()
    rows = counted[0]["row_count"] if counted else 0
    if rows == 0:
        warnings.append("no rows")
    else:
        warnings += [f"column {r['column_name']} is always NULL" for r in counted if r["value_count"] == 0]
    return Validation(not errors, rows, tuple(df.columns), tuple(warnings), tuple(errors))


def mapped_columns(df: DataFrame, mapping: DataFrame, report_id: str) -> DataFrame:
    """Project ``df`` by a table of (report_id, source_column, target_column).

    Only entries for columns of ``df`` are fetched, so their number follows the width of ``df``. A source
    column may feed several targets; columns without an entry are left out.
    """
    entries = (
        mapping.filter((F.col("report_id") == report_id) & F.col("source_column").isin(df.columns))
        .select("source_column", "target_column")
        .distinct()
        .collect()
    )
    position = {c: i for i, c in enumerate(df.columns)}
    ordered = sorted(entries, key=lambda e: (position[e["source_column"]], e["target_column"]))
    targets = [e["target_column"] for e in ordered]
    if len(set(targets)) < len(targets):
        raise ValueError(f"several source columns for one target in {sorted(targets)}")
    return df.select(*[F.col(e["source_column"]).alias(e["target_column"]) for e in ordered])
