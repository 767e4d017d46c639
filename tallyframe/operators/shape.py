"""Renaming, fixed output schemas and constant columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions.metrics import percent


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns that are there; names of absent columns are ignored."""
    return df.withColumnsRenamed(dict(names))


def renamed_select(df: DataFrame, names: Mapping[str, str], columns: Iterable[str]) -> DataFrame:
    """Only ``columns`` (output names) of ``df``, read from their raw names.

    Used on every input before a join, so no two inputs bring the same column into it.
    """
    raw_of = {out: raw for raw, out in names.items() if raw in df.columns}
    return df.select(*[F.col(raw_of.get(c, c)).alias(c) for c in columns])


def select_fixed(df: DataFrame, schema: T.StructType | Mapping[str, str | T.DataType]) -> DataFrame:
    """Exactly the columns of ``schema`` in its order, cast to its types; absent ones are typed NULLs."""
    if not isinstance(schema, T.StructType):
        schema = T.StructType.fromDDL(", ".join(f"`{n}` {_ddl(t)}" for n, t in schema.items()))
    found = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[
            f.name
            if found.get(f.name) == f.dataType
            else (F.col(f.name) if f.name in found else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def _ddl(data_type: str | T.DataType) -> str:
    return data_type if isinstance(data_type, str) else data_type.simpleString()


def with_constants(df: DataFrame, **values) -> DataFrame:
    """Add or overwrite literal columns."""
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def with_time(df: DataFrame, time_period: str, time_identifier: str = "Academic year") -> DataFrame:
    """Stamp a literal period on every row. It does not filter: see ``operators.periods`` for that."""
    return with_constants(df, time_period=time_period, time_identifier=time_identifier)


def round_columns(df: DataFrame, columns: Iterable[str], scale: int = 1) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), scale) for c in columns if c in df.columns})


def with_percent(df: DataFrame, numerator: str, denominator: str, output: str, scale: int = 0) -> DataFrame:
    return df.withColumn(output, percent(numerator, denominator, scale))


def all_of(conditions: Iterable[Column]) -> Column:
    """AND of the conditions; true when there are none."""
    result = F.lit(True)
    for condition in conditions:
        result = result & condition
    return result
