"""Target-distribution importance resampling: gains of hashed n-grams, gathered through an open-addressed table."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.arrow import in_steps, text_bytes
from tallyframe.llm.common import checkpointed, keep_packed, packed, text_of

#: buckets that n-grams are counted in
BUCKETS = 10_000
#: least and most words of an n-gram
SIZES = (1, 1)
#: documents of fewer words are never drawn
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
#: text bytes whose n-grams one table holds; a longer single text comes alone
STEP = 1 << 20

#: byte to what n-grams have of it: A-Z lower-cased, digits, letters and all of non-ASCII kept, the rest a space
_BYTES = np.full(256, 0x20, np.uint8)
for _kept in (range(0x30, 0x3A), range(0x61, 0x7B), range(0x80, 0x100)):
    _BYTES[_kept.start : _kept.stop] = _kept
_BYTES[0x41:0x5B] = _BYTES[0x61:0x7B]

# fixed values: the primes of xxHash64
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p)
    for p in (
        11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261,
    )
)


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


class Ngrams:
    """The n-grams of some texts as spans of one buffer in which words stand one space apart.

    ``data`` is that buffer, ``lanes[i]`` its eight bytes from i on as a number. ``starts`` and ``lengths`` are the
    spans, text after text for each number of words; ``parts`` tells how many each text has, by number of words.
    """

    def __init__(self, texts: list[bytes], sizes: tuple[int, int] = SIZES) -> None:
        joined = _BYTES[np.frombuffer(b" ".join([*texts, b""]), np.uint8)]
        begins = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)))
        inside = joined != 0x20
        after = np.zeros(len(inside), bool)
        after[1:] = inside[:-1]
        self.words = np.diff(np.searchsorted(np.flatnonzero(inside & ~after), begins))
        kept = joined[inside | after]
        inside = kept != 0x20
        ends = np.flatnonzero(~inside)
        starts = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
        self.data = np.concatenate((kept, np.zeros(8, np.uint8)))
        self.lanes = np.lib.stride_tricks.as_strided(
            self.data[:8].view("<u8"), (len(kept) + 1,), (1,), writeable=False
        ).astype(np.uint64)
        first = np.concatenate(([0], np.cumsum(self.words)))
        of = np.repeat(np.arange(len(texts)), self.words)
        left = first[of + 1] - np.arange(len(of))
        spans, self.parts = [], []
        for n in range(sizes[0], sizes[1] + 1):
            at = np.flatnonzero(left >= n)
            spans.append((starts[at], ends[at + n - 1]))
            self.parts.append(np.maximum(self.words - n + 1, 0))
        self.starts = np.concatenate([s for s, _ in spans])
        self.lengths = np.concatenate([e for _, e in spans]) - self.starts

    def raw(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.starts[i] + self.lengths[i]].tobytes()

    def keys(self) -> np.ndarray:
        """The xxHash64 of every n-gram, by groups of one length; those of 32 bytes and more one by one."""
        out = np.empty(len(self.starts), np.uint64)
        order = np.argsort(np.minimum(self.lengths, 32).astype(np.int16), kind="stable")
        bounds = np.searchsorted(self.lengths[order], np.arange(33)) if len(order) else np.zeros(33, np.int64)
        for length in range(1, 32):
            group = order[bounds[length] : bounds[length + 1]]
            if not len(group):
                continue
            at, value = self.starts[group], np.full(len(group), _P5 + np.uint64(length), np.uint64)
            done = 0
            while done + 8 <= length:
                lane = _turned(self.lanes[at + done] * _P2, 31) * _P1
                value = _turned(value ^ lane, 27) * _P1 + _P4
                done += 8
            if done + 4 <= length:
                lane = (self.lanes[at + done] & np.uint64(0xFFFFFFFF)) * _P1
                value = _turned(value ^ lane, 23) * _P2 + _P3
                done += 4
            for place in range(done, length):
                value = _turned(value ^ (self.data[at + place].astype(np.uint64) * _P5), 11) * _P1
            value = (value ^ (value >> np.uint64(33))) * _P2
            value = (value ^ (value >> np.uint64(29))) * _P3
            out[group] = value ^ (value >> np.uint64(32))
        for i in order[bounds[32] :]:
            out[i] = xxhash.xxh64_intdigest(self.raw(i))
        return out

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the bytes of n-grams ``a`` and ``b`` are the same, eight at a time."""
        size, same = self.lengths[a], self.lengths[a] == self.lengths[b]
        rest = np.uint64(8) * (np.uint64(8) - np.minimum(size, 8).astype(np.uint64))
        same &= ((self.lanes[self.starts[a]] ^ self.lanes[self.starts[b]]) << rest) == 0
        more, done = np.flatnonzero(same & (size > 8)), 8
        while len(more):
            # the last eight bytes end with the n-gram, so that none beyond it is looked at
            at = np.minimum(size[more] - 8, done)
            hit = self.lanes[self.starts[a[more]] + at] == self.lanes[self.starts[b[more]] + at]
            same[more[~hit]] = False
            done += 8
            more = more[hit & (size[more] > done)]
        return same


class Interned:
    """The distinct n-grams of a batch in an open-addressed table with linear probing.

    ``slot_of`` has the slot of every occurrence; ``bucket`` and ``count`` are what the slots hold. The table has at
    least twice as many slots as there are occurrences, so it never fills up. Equal keys count as one n-gram only if
    their bytes are equal too.
    """

    def __init__(self, ngrams: Ngrams, buckets: int) -> None:
        keys = ngrams.keys()
        size = 1 << (2 * len(keys) + 1).bit_length()
        holder, place = np.full(size, -1, np.int64), (keys & np.uint64(size - 1)).astype(np.int64)
        self.slot_of = np.empty(len(keys), np.int64)
        left = np.arange(len(keys))
        while len(left):
            at = place[left]
            free = holder[at] < 0
            holder[at[free]] = left[free]  # one of those that meet in a free slot gets it
            other = holder[at]
            same = keys[other] == keys[left]
            same[same] = ngrams.equal(left[same], other[same])
            self.slot_of[left[same]] = at[same]
            left = left[~same]
            place[left] = (place[left] + 1) & (size - 1)
        self.used = np.flatnonzero(holder >= 0)
        self.bucket = np.zeros(size, np.int32)
        self.bucket[self.used] = [zlib.crc32(ngrams.raw(i)) % buckets for i in holder[self.used]]
        self.count = np.bincount(self.slot_of, minlength=size)

    def counts(self, buckets: int) -> np.ndarray:
        """N-grams by bucket."""
        return np.bincount(self.bucket[self.used], self.count[self.used], buckets).astype(np.int64)


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What an n-gram of each bucket adds to a text's weight: a thousand times the log of the smoothed likelihood ratio."""
    n, s, t = len(own), own.astype(float), target.astype(float)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def bucket_counts(texts: DataFrame, sizes: tuple[int, int] = SIZES, buckets: int = BUCKETS) -> np.ndarray:
    """How many n-grams of a column of texts fall in each bucket.

    Each task adds up its own batches, so a task gives at most one row per bucket; the driver gets one per bucket.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in in_steps(batch, "text", STEP, 1 << 14):
                total += Interned(Ngrams(text_bytes(part.column("text")), sizes), buckets).counts(buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["bucket", "n"])

    found = texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


def _weighing(sizes: tuple[int, int], gain: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        for batch in batches:
            for part in in_steps(batch, "text", STEP, 1 << 14):
                ngrams = Ngrams(text_bytes(part.column("text")), sizes)
                table = Interned(ngrams, len(gain))
                sums = np.concatenate(([0], np.cumsum(gain[table.bucket][table.slot_of])))
                weight, features = np.zeros(len(ngrams.words), np.int64), np.zeros(len(ngrams.words), np.int64)
                at = 0
                for own in ngrams.parts:
                    ends = at + np.cumsum(own)
                    weight += sums[ends] - sums[ends - own]
                    features += own
                    at += int(own.sum())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(ngrams.words), pa.array(features), pa.array(weight)],
                    ["doc_id", "n_words", "n_features", "weight"],
                )

    return run


def luck(id_text: Column, seed: int | str = SEED) -> Column:
    """A Gumbel number of a thousand steps to one, made of a hash of seed and id."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), id_text), 256), 1, 8)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(uniform))).cast("long")


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every row with its task and its place among the task's rows."""
    from pyspark import TaskContext

    task, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        place = pa.array(np.arange(at, at + len(batch)))
        at += len(batch)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(batch), task)), place], [*batch.schema.names, "task", "place"]
        )


def resampled(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    sizes: tuple[int, int] = SIZES,
    buckets: int = BUCKETS,
    seed: int | str = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
) -> DataFrame:
    """Weight, score and rank of every document of a draw that follows the words of ``target``.

    Words are runs of digits, a-z (A-Z lower-cased) and all characters beyond ASCII; features are all runs of
    ``sizes[0]`` to ``sizes[1]`` words of a text, repeats counted. Features fall in ``buckets`` buckets by their
    crc32. A bucket's gain compares its share of the target's features with its share of the documents' (each
    with one more feature), a document's weight is the sum of its features' gains. The score adds luck
    (Gumbel numbers), so that the highest scores are a draw without replacement by odds that follow the weights.
    Of the N documents of at least ``least_words`` words the highest floor(percent * N / 100) are drawn and ranked from 1.

    In the tasks a batch's n-grams are interned in an open-addressed table of their xxHash64, equal bytes verified; its
    slots hold bucket and count, and occurrences gather their gains by slot. The table is as large as one batch of texts asks for.
    All texts are read twice: for the counts, of which the driver sees one per bucket, and for the weights. Scores
    are then sorted by range, numbered within each task and given the rows of the tasks before.

    Null texts have no features, no words and weight 0. A null id is hashed as empty text and comes last among
    equals. Rows that repeat an id are documents of their own, in any order among equals. An empty target gives
    gains from the documents alone; an empty table of documents gives no rows. Other columns are not read, whatever
    their names.

    Columns: doc_id, n_words, n_features, weight, score, rank (null if not drawn), text_hash.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    wanted = target.select(text_of(target_text_col).alias("text"))
    gain = gains(bucket_counts(source.select("text"), sizes, buckets), bucket_counts(wanted, sizes, buckets))
    id_type = source.schema["doc_id"].dataType.simpleString()
    keyed = source.select(F.struct("doc_id", F.xxhash64("text").alias("text_hash")).alias("doc_id"), "text")
    schema = f"doc_id struct<doc_id:{id_type},text_hash:long>, n_words long, n_features long, weight long"
    # stored, as the sort by range reads its input twice
    weighed = checkpointed(keyed.mapInArrow(_weighing(sizes, gain), schema))
    weighed = weighed.select("doc_id.*", "n_words", "n_features", "weight")
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    scored = weighed.withColumn("score", F.col("weight") + luck(name, seed))
    scored = scored.withColumn("able", F.col("n_words") >= least_words)
    order = [F.col("able").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("text_hash")]
    ranged = scored.repartitionByRange(*order).sortWithinPartitions(*order)
    fields = f"doc_id {id_type}, text_hash long, n_words long, n_features long, weight long, score long, able boolean"
    numbered = checkpointed(ranged.mapInArrow(_numbered, f"{fields}, task long, place long"))
    tasks = numbered.groupBy("task").agg(F.count(F.lit(1)).alias("n"), F.count_if("able").alias("able"))
    tasks = sorted((t.task, t.n, t.able) for t in tasks.collect())
    drawn = percent * sum(able for _, _, able in tasks) // 100
    firsts = np.cumsum([0, *(n for _, n, _ in tasks)]).tolist()
    starts = docs.sparkSession.createDataFrame(
        [(task, first) for (task, _, _), first in zip(tasks, firsts)], "task long, first long"
    )
    rank = F.col("first") + F.col("place") + 1
    # one row per task of the sort
    return numbered.join(F.broadcast(starts), "task").select(
        "doc_id", "n_words", "n_features", "weight", "score",
        F.when(F.col("able") & (rank <= drawn), rank).alias("rank"), "text_hash",
    )


def take_resampled(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns. Of rows that repeat id and text all are taken if one is drawn."""
    found = resampled(docs, target, id_col=id_col, text_col=text_col, **how).filter("rank IS NOT NULL")
    return keep_packed(packed(docs, id_col, text_col), found.select("doc_id", "text_hash").distinct())
