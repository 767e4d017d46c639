"""Writing finished reports."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from tallyframe.sources.bronze import qualified
from tallyframe.sources.folders import delete, entries, exists


def year_suffix(periods: Iterable[str]) -> str:
    """``2022_to_2025`` for 202122 ... 202425: from the end of the first year to the end of the last."""
    ordered = sorted(periods)
    if not ordered:
        raise ValueError("no periods given")

    def end_year(period: str) -> str:
        century = int(period[:2]) + (period[4:] == "00")  # 199900 ends in 2000
        return f"{century}{period[4:]}"

    return f"{end_year(ordered[0])}_to_{end_year(ordered[-1])}"


def write_csv(df: DataFrame, path: str, parts: int | None = None, order: Sequence[str | Column] = ()) -> None:
    """Write a report as a folder of CSV parts with headers, replacing what was there.

    By default every partition writes its own part. ``parts=1`` gives the one-file form for reports that
    are known to be small; the rows then all pass through one task, after the parallel part of the job.
    With ``order`` the parts, read in name order, are in that order: rows are dealt to them by range.
    """
    if parts is not None:
        df = df.repartitionByRange(parts, *order).sortWithinPartitions(*order) if order else df.coalesce(parts)
    elif order:
        df = df.orderBy(*order)
    df.write.mode("overwrite").option("header", True).csv(path)


#: folder, beside a table's first location, of the versions that replaced it
_VERSIONS = "__versions"


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    names = [r.col_name for r in rows]
    return {r.col_name: r.data_type for r in rows[names.index("# Detailed Table Information") + 1 :]}


def write_table(df: DataFrame, table: str, schema: str | None = None, catalog: str | None = None) -> None:
    """Create or replace a table with the rows of ``df``; readers see the old table or the new one, whole.

    A table that is there keeps its rows while the new ones are written to a folder of their own; then its location
    is set to that folder, one step in the catalog. A write that fails changes nothing. The version
    before stays on disk for readers that have begun, and goes with the next write. If the columns change, or the table
    is partitioned, bucketed or of another format, the new table is made under another name and the two names are exchanged, so that for a moment there is none.
    Catalogs other than the session's replace tables in one step by themselves.
    """
    spark, name = df.sparkSession, qualified(table, schema, catalog)
    if catalog not in (None, "spark_catalog"):
        df.writeTo(name).createOrReplace()
        return
    if not spark.catalog.tableExists(name):
        df.write.format("parquet").saveAsTable(name)
        return
    known = _described(spark, name)
    old = known["Location"].rstrip("/")
    plain = known.get("Provider") == "parquet" and not any(c.isPartition or c.isBucket for c in spark.catalog.listColumns(name))
    if not plain or spark.table(name).schema.simpleString() != df.schema.simpleString():
        _exchange(df, name, qualified(f"{table}__{uuid.uuid4().hex}", schema, catalog))
        return
    folder, _, last = old.rpartition("/")
    if not folder.endswith(_VERSIONS):
        folder = f"{old}{_VERSIONS}"
    new = f"{folder}/{uuid.uuid4().hex}"
    try:
        df.write.parquet(new)
    except BaseException:
        delete(spark, new)
        raise
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{new}'")
    spark.catalog.refreshTable(name)
    for entry in entries(spark, folder):
        if entry.name not in (last, new.rpartition("/")[2]):
            delete(spark, entry.path)
    if f"{folder}/{last}" == old and exists(spark, first := folder.removesuffix(_VERSIONS)):
        delete(spark, first)


def _exchange(df: DataFrame, name: str, new_name: str) -> None:
    spark, old_name = df.sparkSession, new_name[:-1] + "_old`"
    df.write.format("parquet").saveAsTable(new_name)
    spark.sql(f"ALTER TABLE {name} RENAME TO {old_name}")
    try:
        spark.sql(f"ALTER TABLE {new_name} RENAME TO {name}")
    except BaseException:
        spark.sql(f"ALTER TABLE {old_name} RENAME TO {name}")
        raise
    spark.sql(f"DROP TABLE {old_name}")


def drop_table(spark: SparkSession, table: str, schema: str | None = None, catalog: str | None = None) -> None:
    """Drop a table and all versions of it that ``write_table`` keeps."""
    name = qualified(table, schema, catalog)
    location = _described(spark, name).get("Location", "").rstrip("/")
    spark.sql(f"DROP TABLE {name}")
    folder = location.rpartition("/")[0]
    if folder.endswith(_VERSIONS):
        delete(spark, folder)
        delete(spark, folder.removesuffix(_VERSIONS))


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)
