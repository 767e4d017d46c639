"""Exact dedup: a tree-merge of digest runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import SPACES, checkpointed, keep_one_each, text_of

#: runs merged into one at each level
FAN_IN = 16

_KEY = ("digest", "n_norm", "proof")



def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = FAN_IN
) -> DataFrame:
    """For every row the row that stays of its group of equal texts. Ids are integers of any width.

    Texts are equal when they are the same without ASCII white space. The longest original text stays (in code
    points), of those the smallest id, then the first row of the table. Each input partition gives a run of
    (digest, best row, count), grouped by digest and with one entry per digest. At level r the ``fan_in`` runs
    whose numbers agree after their last r digits are merged by digest, so log(partitions) levels are
    left with one run. A run is spread by digest over all tasks at every level, so no task ever holds a whole
    run, and a digest that a third of all rows share arrives once per run. Beside the SHA-256 digest, entries
    are merged only if the length and an independent 64-bit hash of the text agree too.

    The way back is the same tree: winners meet the first runs by digest, and rows their own run's entries.

    Null texts are empty texts, and all empty texts are one group. A null id loses to any other and otherwise
    counts as an id. Rows that repeat an id are rows of their own: one of them stays. An empty table gives no
    rows. Other columns are not read, whatever their names. Text length is bounded by one row's memory only.

    Columns: doc_id, keep_id, group_size, kept, text_sha256, n_chars, text_hash (of the original text).
    """
    source = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    texts = source.select(
        "doc_id",
        F.length("text").alias("n_chars"),
        F.xxhash64("text").alias("text_hash"),
        F.regexp_replace("text", SPACES, "").alias("norm"),
    )
    rows = checkpointed(
        texts.select(
            "doc_id",
            "n_chars",
            "text_hash",
            F.unhex(F.sha2("norm", 256)).alias("digest"),
            F.octet_length("norm").alias("n_norm"),
            F.xxhash64("norm").alias("proof"),
            F.spark_partition_id().alias("run"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    # the larger struct is the better row: bitwise not turns ids round without overflow, null is the smallest
    best = F.struct("n_chars", F.bitwise_not("doc_id").alias("id_down"), F.bitwise_not("row").alias("row_down"))
    runs = rows.groupBy("run", *_KEY).agg(F.count(F.lit(1)).alias("n"), F.max(best).alias("best"))
    merged, left = runs, (rows.agg(F.max("run")).first()[0] or 0) + 1
    while left > 1:
        up = merged.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
        merged = up.groupBy("run", *_KEY).agg(F.sum("n").alias("n"), F.max("best").alias("best"))
        left = -(-left // fan_in)
    winners = merged.select(*_KEY, "n", "best")
    in_runs = runs.select("run", *_KEY).join(winners, list(_KEY))
    return rows.join(in_runs, ["run", *_KEY]).select(
        "doc_id",
        F.bitwise_not("best.id_down").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.bitwise_not("best.row_down") == F.col("row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "n_chars",
        "text_hash",
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, one of each group of equal texts."""
    decisions = checkpointed(exact_duplicates(docs, id_col, text_col).select("doc_id", "text_hash", "kept"))
    return keep_one_each(docs, decisions, id_col, text_col)
