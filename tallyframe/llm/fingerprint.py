"""Document fingerprints: bottom-k sketches of word shingle hashes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import SPACE_CHARS, SPACES, join_ids, text_of

#: hashes that a sketch keeps, and words in a shingle
K = 256
SHINGLE = 5
#: shingles that are hashed and sorted at once; the sketches of such parts of a text are merged
PART = 2048
#: hashes have this many bits
BITS = 48
#: documents of neighbouring ids that one window sees, and most windows
BLOCK_ROWS = 1000
MOST_BLOCKS = 20_000
#: ids a block that its bounds are found from
SAMPLED = 20

_EMPTY = "array<bigint>"


def word_hashes(text: Column) -> Column:
    """A hash per word; ASCII white space parts words."""
    parts = F.split(F.btrim(text, F.lit(SPACE_CHARS)), SPACES)
    return F.when(F.btrim(text, F.lit(SPACE_CHARS)) == "", F.array().cast(_EMPTY)).otherwise(
        F.transform(parts, lambda w: F.xxhash64(w))
    )


def smallest(hashes: Column, k: int) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of what two sketches stand for."""
    return smallest(F.concat(a, b), k)


def sketch(hashed_words: Column, k: int = K, size: int = SHINGLE) -> Column:
    """The ``k`` smallest distinct hashes of ``size``-word shingles, ascending; fewer words are one shingle.

    Part after part of the shingles is sketched and merged, so a long text needs little beyond its word hashes.
    """
    last = F.greatest(F.size(hashed_words) - size, F.lit(0))

    def shingle(i: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(*[F.get(hashed_words, i + j) for j in range(size)]), 64 - BITS)

    def part(start: Column) -> Column:
        return smallest(F.transform(F.sequence(start, F.least(start + (PART - 1), last)), shingle), k)

    merged = F.aggregate(
        F.sequence(F.lit(0), last, F.lit(PART)),
        F.array().cast(_EMPTY),
        lambda done, start: merge(done, part(start), k),
    )
    return F.when(F.size(hashed_words) == 0, F.array().cast(_EMPTY)).otherwise(merged)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of two sketches' shingle sets; exact if both are whole. 1 for two empty ones."""
    union = merge(a, b, k)
    both = F.size(F.array_intersect(F.array_intersect(a, b), union))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: how densely the smallest hashes lie. Exact below ``k``."""
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(
        F.lit(float(k - 1)) * float(1 << BITS) / F.element_at(a, -1)
    )


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has too; 1 for an empty a."""
    likeness, n_a, n_b = resemblance(a, b, k), distinct_shingles(a, k), distinct_shingles(b, k)
    both = likeness / (1 + likeness) * (n_a + n_b)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), both / n_a))


def as_text(a: Column) -> Column:
    """A sketch as base64 of its hashes, six bytes each."""
    digits = F.transform(a, lambda h: F.lpad(F.hex(h), BITS // 4, "0"))
    return F.replace(F.base64(F.unhex(F.array_join(digits, ""))), F.lit("\r\n"), F.lit(""))


def fingerprints(
    docs: DataFrame, k: int = K, size: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The sketch of every text. Columns: doc_id, n_chars, sketch, n_shingles (estimated).

    Null and empty texts have empty sketches. Null ids and repeated rows pass through; equal texts have equal
    sketches. An empty table gives no rows. Other columns are not read, whatever their names.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    hashed = texts.select("doc_id", F.length("text").alias("n_chars"), word_hashes(F.col("text")).alias("words"))
    sketched = hashed.select("doc_id", "n_chars", sketch(F.col("words"), k, size).alias("sketch"))
    return sketched.withColumn("n_shingles", distinct_shingles(F.col("sketch"), k))


def _in_blocks(texts: DataFrame) -> DataFrame:
    """``texts`` with their block and text_hash. Blocks rise with the ids; those of null ids fall from -1 with the hash."""
    ids = texts.select(F.col("doc_id").cast("long").alias("id"))
    n, nulls = ids.agg(F.count("id"), F.count_if(F.col("id").isNull())).first()
    blocks, null_blocks = (min(MOST_BLOCKS, max(1, -(-count // BLOCK_ROWS))) for count in (n, nulls))
    every = max(1, n // (blocks * SAMPLED))
    sample = ids.filter(F.pmod(F.xxhash64("id"), F.lit(every)) == 0).filter("id IS NOT NULL")
    sample = np.sort(sample.toArrow().column("id").to_numpy())
    bounds = np.unique(sample[np.arange(1, blocks) * len(sample) // blocks]) if len(sample) else sample
    # a block's number is how many bounds its ids reach, found by halving
    listed = F.split(F.lit(",".join(map(str, bounds)) or "0"), ",").cast("array<bigint>")
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(bounds).bit_length()))])
    reached = lambda at, step: F.get(listed, at + step - 1) <= F.col("doc_id").cast("long")
    block = F.aggregate(steps, F.lit(0), lambda at, step: F.when(reached(at, step), at + step).otherwise(at))
    block = block if len(bounds) else F.lit(0)
    place = F.shiftright("text_hash", 40) + F.lit(1 << 23)
    null_block = -1 - F.floor(place * null_blocks / F.lit(1 << 24)).cast("int")
    hashed = texts.withColumn("text_hash", F.xxhash64("text"))
    return hashed.withColumn("block", F.when(F.col("doc_id").isNull(), null_block).otherwise(block))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document with the one of the next smaller id; the last is followed by the first. Ids are integers.

    Ids are dealt to blocks between quantiles, about a thousand documents each and 20,000 blocks at most. A window
    orders each block, and its last document takes the first one of the next block that has any: block
    heads, one row per block, are all that is ordered in one place. The quantiles are those of a sample of ids, which
    changes the sizes of blocks and nothing else. Rows that repeat one id share a block, null ids are dealt by text hash.

    Null ids come last. Rows that repeat an id are in order of a hash of their texts; equal rows are
    interchangeable.

    Columns: doc_id, text, next_text.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    rows = _in_blocks(texts)

    first = F.struct("doc_id", F.bitwise_not("text_hash").alias("hash_down"))
    heads = rows.groupBy("block").agg(F.max(first).alias("head"))
    down = Window.orderBy(F.col("block").desc())
    top = F.first("head").over(down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.select("block", F.coalesce(F.lead("head").over(down), top).alias("head")).select(
        F.col("block").alias("for_block"),
        F.col("head.doc_id").alias("doc_id"),
        F.bitwise_not("head.hash_down").alias("text_hash"),
    )
    after = join_ids(rows.select("doc_id", "text_hash", "text"), F.broadcast(heads), ["doc_id", "text_hash"])
    after = after.groupBy(F.col("for_block").alias("block")).agg(F.first("text").alias("after_block"))

    order = Window.partitionBy("block").orderBy(F.col("doc_id").desc_nulls_last(), "text_hash")
    led = rows.repartition("block").withColumn("led", F.lead("text").over(order))
    return led.join(after, "block", "left").select("doc_id", "text", F.coalesce("led", "after_block").alias("next_text"))
