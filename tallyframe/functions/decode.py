"""Turning category codes into labels, and label predicates back into code predicates.

Everything here returns plain Column expressions, so decoding stays inside whole-stage codegen and a
label filter reaches the Parquet scan as a filter on the raw code.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.codes import DEFAULT_LABELS, STANDARD_CODES
from tallyframe.functions.sqltext import literal

#: Default policy: codes missing from the mapping keep their raw value, NULL stays NULL.
PASSTHROUGH = object()


def _fallback(raw: Column, default) -> Column:
    return raw if default is PASSTHROUGH else F.lit(default)


def _lookup(raw: Column, mapping: Mapping[str, str], missing: Column) -> Column:
    """Value of ``raw`` in a constant map, or ``missing``.

    The map folds to one literal. A CASE with a branch per code costs several hundred bytes of generated
    code for each column, and a stage that decodes ten columns beside forty aggregates then passes the
    size up to which the JVM compiles a method at all.
    """
    if not mapping:
        return missing
    # as one parsed expression: column calls for every code would dominate the time to build a plan
    table = F.expr("map(" + ", ".join(literal(text) for pair in mapping.items() for text in pair) + ")")
    return F.coalesce(F.try_element_at(table, raw), missing)


def decode(column: str | Column, mapping: Mapping[str, str], default=PASSTHROUGH) -> Column:
    """Label of a code.

    ``default`` is the label of NULL and of codes missing from ``mapping``; by default they pass through.
    """
    raw = F.col(column) if isinstance(column, str) else column
    return _lookup(raw, mapping, _fallback(raw, default))


def canonical_code(column: str | Column, mapping: Mapping[str, str], default=PASSTHROUGH) -> Column:
    """One short code per label, such that ``decode(canonical_code(x)) == decode(x)`` for every x.

    Grouping by it gives the same groups as grouping by the label, but the rows that are shuffled carry
    one short code instead of a long label; the label is put in on the grouped rows.
    """
    raw = F.col(column) if isinstance(column, str) else column
    short_of: dict[str, str] = {}
    for code, label in mapping.items():
        if label not in short_of or len(code) < len(short_of[label]):
            short_of[label] = code
    replaced = {code: short_of[label] for code, label in mapping.items()}
    if default is PASSTHROUGH:
        # a raw value may already be the label; codes that stand for themselves pass through anyway
        replaced |= {label: short for label, short in short_of.items() if label not in mapping}
        return _lookup(raw, {code: short for code, short in replaced.items() if code != short}, raw)
    # a default label without a code of its own is reached through NULL
    return _lookup(raw, replaced, F.lit(short_of.get(default)).cast("string"))


def label_predicate(
    column: str | Column,
    labels: str | Iterable[str],
    mapping: Mapping[str, str],
    default=PASSTHROUGH,
) -> Column:
    """``decode(column) IN labels`` as a predicate on the raw code, which the scan can push down."""
    raw = F.col(column) if isinstance(column, str) else column
    wanted = {labels} if isinstance(labels, str) else set(labels)
    codes = [code for code, label in mapping.items() if label in wanted]
    if default is PASSTHROUGH:
        codes += sorted(label for label in wanted if label not in mapping)
        return raw.isin(codes)
    hit = raw.isin(codes) if codes else F.lit(False)
    if default in wanted:
        hit = hit | raw.isNull() | ~raw.isin(list(mapping))
    return hit


def _policy(column: str, defaults: Mapping[str, str]):
    return defaults.get(column, PASSTHROUGH)


def decode_columns(
    df: DataFrame,
    columns: Iterable[str] | None = None,
    codes: Mapping[str, Mapping[str, str]] = STANDARD_CODES,
    defaults: Mapping[str, str] = DEFAULT_LABELS,
    default=None,
) -> DataFrame:
    """Decode every known column that ``df`` has (or just ``columns``), in one projection.

    ``default`` sets one fixed label for the unknown codes of all columns, in place of ``defaults``.
    """
    present = [c for c in (df.columns if columns is None else columns) if c in codes and c in df.columns]
    return df.withColumns(
        {c: decode(c, codes[c], _policy(c, defaults) if default is None else default) for c in present}
    )


def canonical_columns(
    df: DataFrame,
    columns: Iterable[str],
    codes: Mapping[str, Mapping[str, str]] = STANDARD_CODES,
    defaults: Mapping[str, str] = DEFAULT_LABELS,
) -> DataFrame:
    """Replace codes by their canonical code in every known column among ``columns``."""
    present = [c for c in columns if c in codes and c in df.columns]
    return df.withColumns({c: canonical_code(c, codes[c], _policy(c, defaults)) for c in present})


@dataclass(frozen=True)
class Labels:
    """Code tables with what unknown codes and NULL become: by column (``defaults``), or one label for all."""

    codes: Mapping[str, Mapping[str, str]] = field(default_factory=lambda: STANDARD_CODES)
    defaults: Mapping[str, str] = field(default_factory=lambda: DEFAULT_LABELS)
    default: str | None = None

    def policy(self, column: str):
        return _policy(column, self.defaults) if self.default is None else self.default

    def decode(self, df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
        return decode_columns(df, columns, self.codes, self.defaults, self.default)

    def canonical(self, df: DataFrame, columns: Iterable[str]) -> DataFrame:
        present = [c for c in columns if c in self.codes and c in df.columns]
        return df.withColumns({c: canonical_code(c, self.codes[c], self.policy(c)) for c in present})

    def predicate(self, raw: str, column: str, labels: str | Iterable[str]) -> Column:
        """``column`` decoded from ``raw`` has one of the labels, on the raw code."""
        return label_predicate(raw, labels, self.codes[column], self.policy(column))


def decode_with_lookup(
    df: DataFrame, column: str, lookup: DataFrame, default=PASSTHROUGH, output: str | None = None
) -> DataFrame:
    """Decode through a lookup DataFrame (``column``, ``code``, ``label``) instead of a dictionary.

    The lookup is brought to one row per code first, so the join never multiplies rows. No broadcast is
    forced: Spark broadcasts the lookup when its measured size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, where AQE splits hot codes.
    """
    labels = (
        lookup.filter((F.col("column") == column) & F.col("code").isNotNull())
        .groupBy(F.col("code").alias("__code"))
        .agg(F.min("label").alias("__label"))
    )
    joined = df.join(labels, F.col(column) == F.col("__code"), "left")
    label = F.coalesce(F.col("__label"), _fallback(F.col(column), default))
    return joined.withColumn(output or column, label).drop("__code", "__label")
