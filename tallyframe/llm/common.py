"""What several operators share: text as columns, checkpoints, keeping rows."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.sources.folders import delete
from tallyframe.sources.staging import staging_root

#: ASCII white space; nothing else separates words or is stripped
SPACE_CHARS = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def text_of(column: str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is. Texts of ASCII alone take the faster built-in."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows stored once in the shared folder of ``spark.checkpoint.dir``; the lineage ends there.

    Shuffle files of steps that are over stay on the executors' disks until the driver collects its garbage,
    which may take long. It does so before each step, so that an operator of many steps holds the files of one.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(staging_root(df.sparkSession))
    context._jvm.System.gc()
    return df.checkpoint()


class Steps:
    """Results of an operator's steps, each written once to the shared folder and read back from there.

    A written table cuts the lineage as a checkpoint does, takes a fraction of its space, and can be removed as soon as
    no later step reads it.
    """

    def __init__(self, spark: SparkSession) -> None:
        self._spark, self._root = spark, f"{staging_root(spark)}/steps-{uuid.uuid4().hex}"
        self._paths: list[tuple[DataFrame, str]] = []

    def stored(self, df: DataFrame) -> DataFrame:
        # the driver lets go of finished shuffles when it collects its garbage, which may take long
        self._spark.sparkContext._jvm.System.gc()
        path = f"{self._root}/{len(self._paths)}"
        df.write.parquet(path)
        back = self._spark.read.schema(df.schema).parquet(path)
        self._paths.append((back, path))
        return back

    def remove(self, *frames: DataFrame) -> None:
        """Delete what these frames read."""
        for back, path in self._paths:
            if any(back is df for df in frames):
                delete(self._spark, path)


def join_ids(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join on columns in which nulls are equal; the right side's copies of them are dropped."""
    other = right.withColumnsRenamed({c: f"_right_{c}" for c in on})
    condition = F.lit(True)
    for c in on:
        condition = condition & F.col(c).eqNullSafe(F.col(f"_right_{c}"))
    return left.join(other, condition, how).drop(*[f"_right_{c}" for c in on])


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows as structs ``row`` beside their ``id`` and ``text_hash``, so that no column's name can clash.

    The hash tells apart rows of one id while decisions about them are applied.
    """
    row = F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns])
    return docs.select(
        row.alias("row"), F.col(id_col).alias("id"), text_of(text_col).alias("text")
    ).select("row", "id", F.xxhash64("text").alias("text_hash"))


def keep_packed(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """The packed rows that have the id and text hash of some row of ``kept`` (two columns), as they were."""
    return join_ids(rows, kept.toDF("id", "text_hash"), ["id", "text_hash"], "left_semi").select("row.*")


def keep_one_each(docs: DataFrame, decisions: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that decisions (doc_id, text_hash, kept) keep, one for each kept decision.

    Rows that repeat both id and text are one kept row: the one with the least values, column by column.
    """
    rows = packed(docs, id_col, text_col)
    kept = decisions.filter("kept").select("doc_id", "text_hash")
    repeats = decisions.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n"), F.max("kept").alias("kept"))
    repeats = repeats.filter("kept AND n > 1").select("doc_id", "text_hash")
    if repeats.isEmpty():
        return keep_packed(rows, kept)
    repeats = repeats.toDF("id", "text_hash")
    others = join_ids(rows, repeats, ["id", "text_hash"], "left_anti")
    again = join_ids(rows, repeats, ["id", "text_hash"], "left_semi")
    again = again.groupBy("id", "text_hash").agg(F.min("row").alias("row")).select("row.*")
    return keep_packed(others, kept).unionAll(again)
