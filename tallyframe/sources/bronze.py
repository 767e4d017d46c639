"""Reading and writing the raw tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.operators.periods import as_periods, only_periods
from tallyframe.sources.folders import HIDDEN, entries, partition_values
from tallyframe.sources.schemas import BRONZE, PARTITION_COLUMN, PARTITIONED
from tallyframe.sources.staging import run_together


@dataclass(frozen=True)
class Bronze:
    """The five raw tables as lazy DataFrames.

    ``listed`` gives the years of a stored fact table from what its storage lists, or None where that doesn't tell.
    """

    pupil: DataFrame
    school: DataFrame
    results: DataFrame
    claimcare: DataFrame
    geography: DataFrame
    listed: Callable[[str], list[str] | None] = field(default=lambda table: None, compare=False)

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in BRONZE}

    def map(self, change: Callable[[str, DataFrame], DataFrame]) -> Bronze:
        return replace(self, **{name: change(name, df) for name, df in self.tables().items()})

    def with_tables(self, **changed: DataFrame) -> Bronze:
        """The same with other tables; what storage lists no longer holds for these."""
        known = self.listed
        return replace(self, **changed, listed=lambda table: None if table in changed else known(table))

    def periods(self, table: str = "pupil") -> list[str]:
        """Years of a fact table, in order: from its partitions where it is stored by year, else by reading that column."""
        found = self.listed(table)
        if found is None:
            years = getattr(self, table).select(PARTITION_COLUMN).distinct().collect()
            found = [r[0] for r in years if r[0] is not None]
        return sorted(found)

    def for_periods(self, periods: str | Iterable[str] | None) -> Bronze:
        """Only the given years of every fact table: a partition filter on each of the three scans."""
        periods = as_periods(periods)
        if periods is None:
            return self
        known = self.listed
        chosen = self.map(
            lambda name, df: only_periods(df, periods, PARTITION_COLUMN) if name in PARTITIONED else df
        )

        def listed(table: str) -> list[str] | None:
            found = known(table)
            return found and [p for p in found if p in periods]

        return replace(chosen, listed=listed)


def qualified(table: str, schema: str | None = None, catalog: str | None = None) -> str:
    """``catalog.schema.table`` with the given parts, quoted."""
    return ".".join(f"`{part}`" for part in (catalog, schema, table) if part)


def use_namespace(spark: SparkSession, catalog: str | None = None, schema: str | None = None) -> None:
    """Make a catalog and schema current for unqualified names."""
    if catalog:
        spark.catalog.setCurrentCatalog(catalog)
    if schema:
        spark.catalog.setCurrentDatabase(schema)


def read_table(
    spark: SparkSession, table: str, schema: str | None = None, catalog: str | None = None
) -> DataFrame:
    return spark.read.table(qualified(table, schema, catalog))


def bronze_from_catalog(spark: SparkSession, schema: str | None = None, catalog: str | None = None) -> Bronze:
    """The five tables of a catalog. Years are the partitions that the catalog names."""

    def listed(table: str) -> list[str] | None:
        return table_partitions(spark, qualified(table, schema, catalog), PARTITION_COLUMN)

    return Bronze(**{name: read_table(spark, name, schema, catalog) for name in BRONZE}, listed=listed)


def table_partitions(spark: SparkSession, table: str, column: str) -> list[str] | None:
    """The values of a partition column of a catalog table, in order, from the catalog alone; None if it is not partitioned by it.

    A partition without data files has no rows and doesn't count. NULL is no value.
    """
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    names = [r.col_name for r in described]
    if "# Partition Information" not in names:
        return None
    parts = names[names.index("# Partition Information") + 1 :]
    parts = [n for n in parts[: parts.index("") if "" in parts else len(parts)] if not n.startswith("#")]
    if parts != [column]:
        return None
    location = next((r.data_type for r in described if r.col_name == "Location"), None)
    return None if location is None else partition_values(spark, location, column)


class SchemaDrift(ValueError):
    """Stored files that do not have the declared columns; ``findings`` has one line each."""

    def __init__(self, findings: list[str]) -> None:
        super().__init__("stored tables differ from their declared schemas:\n" + "\n".join(findings))
        self.findings = findings


def schema_drift(spark: SparkSession, root: str, tables: Iterable[str] = tuple(BRONZE)) -> list[str]:
    """How the Parquet files below ``root`` differ from the declared schemas, from their footers alone.

    Each folder of a table (one per year, or the table itself) is looked at by itself. A declared column that is in none of
    its files, one of another type, and files that disagree about a type are told; so is a table that is not there.
    Columns beyond the declared ones are no drift. Spark reads the footers of a folder in parallel, the folders at the
    same time; a column that only some files of a folder have is not told.
    """
    folders: list[tuple[str, str]] = []
    findings: list[str] = []
    for table in tables:
        inside = list(entries(spark, f"{root}/{table}"))
        years = [e.path for e in inside if e.is_folder and e.name.startswith(f"{PARTITION_COLUMN}=")]
        data = [e for e in inside if not e.name.startswith(HIDDEN)]
        if not data:
            findings.append(f"{table}: no files")
        for path in years if table in PARTITIONED and years else [f"{root}/{table}"] if data else []:
            folders.append((table, path))

    def look(table: str, path: str) -> None:
        where = table if path == f"{root}/{table}" else f"{table}/{path.rstrip('/').rpartition('/')[2]}"
        try:
            found = {f.name: f.dataType for f in spark.read.option("mergeSchema", True).parquet(path).schema.fields}
        except (PySparkException, Py4JJavaError) as e:
            if "UNABLE_TO_INFER_SCHEMA" in str(e):
                return  # a folder without files has nothing that could differ
            if "CANNOT_MERGE" not in str(e):
                raise
            findings.append(f"{where}: files that differ in the type of a column")
            return
        for f in BRONZE[table].fields:
            if f.name == PARTITION_COLUMN and where != table:
                continue
            if f.name not in found:
                findings.append(f"{where}: no column {f.name}")
            elif found[f.name] != f.dataType:
                findings.append(f"{where}: column {f.name} is {found[f.name].simpleString()}, not {f.dataType.simpleString()}")

    run_together(spark, [lambda t=t, p=p: look(t, p) for t, p in folders])
    return sorted(findings)


def bronze_from_parquet(spark: SparkSession, root: str, check: bool = False) -> Bronze:
    """Tables under ``root/<name>``, read with their declared schemas: no inference, years stay strings.

    Years are the names of the folders of a fact table, where it is stored by year. A declared column that a file
    does not have reads as NULL; with ``check`` the footers are compared with the declared schemas first, and a
    difference raises ``SchemaDrift``.
    """
    if check and (findings := schema_drift(spark, root)):
        raise SchemaDrift(findings)

    def listed(table: str) -> list[str] | None:
        return partition_values(spark, f"{root}/{table}", PARTITION_COLUMN) or None

    return Bronze(**{name: spark.read.schema(s).parquet(f"{root}/{name}") for name, s in BRONZE.items()}, listed=listed)


def conform(df: DataFrame, table: str) -> DataFrame:
    """Cast ``df`` to the declared columns of a raw table; fails on an absent column."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in BRONZE[table].fields])


def write_bronze_parquet(tables: Mapping[str, DataFrame] | Bronze, root: str, mode: str = "overwrite") -> None:
    """Write raw tables under ``root``, the fact tables partitioned by year."""
    for name, df in (tables.tables() if isinstance(tables, Bronze) else tables).items():
        writer = conform(df, name).write.mode(mode)
        if name in PARTITIONED:
            writer = writer.partitionBy(PARTITION_COLUMN)
        writer.parquet(f"{root}/{name}")


def write_bronze_tables(
    tables: Mapping[str, DataFrame] | Bronze,
    schema: str | None = None,
    catalog: str | None = None,
    mode: str = "overwrite",
    buckets: int | None = None,
) -> None:
    """Save raw tables in the catalog.

    ``buckets`` also buckets and sorts the fact tables by pupil, so that their joins, which all use the
    pupil and the year, can run without shuffling any of them. Spark has to be allowed to join on part of
    the key for that (``spark.sql.requireAllClusterKeysForCoPartition=false``).
    """
    for name, df in (tables.tables() if isinstance(tables, Bronze) else tables).items():
        df = conform(df, name)
        writer = df.write.mode(mode).format("parquet")
        if name in PARTITIONED:
            if buckets:
                # the hash that buckets go by; a task holds few buckets of few years, so it writes few files
                dealt = df.withColumn("__bucket", F.pmod(F.hash("pupil_id"), F.lit(buckets)))
                df = dealt.hint("rebalance", F.col("__bucket"), F.col(PARTITION_COLUMN)).drop("__bucket")
                writer = df.write.mode(mode).format("parquet").bucketBy(buckets, "pupil_id").sortBy("pupil_id")
            writer = writer.partitionBy(PARTITION_COLUMN)
        writer.saveAsTable(qualified(name, schema, catalog))
