"""Line dedup: drop the lines that many documents have."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import SPACE_CHARS, ascii_lower, checkpointed, join_ids, text_of

#: a key on more than one in HEAVY_SHARE of all lines is broadcast; no more than HEAVY_SHARE keys can be
HEAVY_SHARE = 1000


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACE_CHARS)))


def line_hashes(text: Column, min_chars: int) -> Column:
    """For every line 128 bits of its key's SHA-256, null for keys of fewer than ``min_chars`` code points."""
    digest = lambda key: F.unhex(F.left(F.sha2(key, 256), F.lit(32)))
    return F.transform(
        F.split(text, "\n"), lambda line: F.when(F.length(line_key(line)) >= min_chars, digest(line_key(line)))
    )


def repeated_lines(
    docs: DataFrame, threshold: int = 10, min_chars: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every text without the lines whose key at least ``threshold`` documents have.

    Line keys are hashed, the hashes exploded once per document and counted. Keys of fewer than ``min_chars`` code
    points are left alone. Hashes over the threshold find their lines again by a join: those on more than a
    thousandth of all lines, of which there are a thousand at most, are broadcast; the others are joined by
    shuffle, where no hash has more than that share. Texts then meet the positions of their dropped lines, and
    the lines that stay are put together in order.

    Null texts are empty; an empty text is one empty line. Every row is a document, so rows that repeat an id
    count apart; rows of equal id and text get equal results. Null is an id like others. An empty table gives no
    rows. Other columns are not read, whatever their names.

    Columns: doc_id, n_lines, n_dropped, kept_text.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    texts = texts.withColumn("text_hash", F.xxhash64("text"))
    hashed = checkpointed(texts.select("doc_id", "text_hash", line_hashes(F.col("text"), min_chars).alias("hashes")))
    once = hashed.select(F.explode(F.array_distinct("hashes")).alias("hash")).filter("hash IS NOT NULL")
    repeated = checkpointed(once.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= threshold))
    n_lines = hashed.agg(F.sum(F.size("hashes"))).first()[0] or 0
    heavy = F.broadcast(repeated.filter(F.col("n") * HEAVY_SHARE > n_lines).select("hash"))
    light = repeated.filter(F.col("n") * HEAVY_SHARE <= n_lines).select("hash")
    lines = hashed.select("doc_id", "text_hash", F.posexplode("hashes").alias("pos", "hash")).filter("hash IS NOT NULL")
    gone = lines.join(heavy, "hash", "left_semi").unionAll(
        lines.join(heavy, "hash", "left_anti").join(light, "hash", "left_semi")
    )
    gone = gone.groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("gone"))
    split = join_ids(texts, gone, ["doc_id", "text_hash"], "left").select(
        "doc_id",
        F.split("text", "\n").alias("lines"),
        F.coalesce("gone", F.array().cast("array<int>")).alias("gone"),
    )
    return split.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.size("gone").cast("long").alias("n_dropped"),
        F.array_join(
            F.transform(
                F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone"), lambda i: F.get("lines", i)
            ),
            "\n",
        ).alias("kept_text"),
    )
