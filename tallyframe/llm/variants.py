"""Spelling variants: words one edit apart, found by dynamic programming down sorted lists."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import ascii_lower, checkpointed, text_of

#: runs that words are taken from
RUN = "[A-Za-zÀ-ÿ]+"
LEAST_LENGTH, LEAST_COUNT = 6, 5
#: a form occurs at least so many times as often as its variant
RATIO = 5
#: every so many-th occurrence, by hash, loses a code point; None leaves texts as they are
MISSPELT = None
#: words of one list; larger lists are split by where the edit lies
LIST = 1000


def occurrences(
    docs: DataFrame, least_length: int = 1, misspelt: int | None = MISSPELT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every run of at least ``least_length`` letters in every text, A-Z lower-cased: one column, word.

    With ``misspelt``, the runs whose crc32 of ``<doc_id>:<run>`` is divisible by it lose the code point at that
    hash modulo their length: known errors, on which a grouping can be measured.
    """
    texts = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("doc_id"), ascii_lower(text_of(text_col)).alias("text")
    )
    runs = texts.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.filter(F.length("run") >= least_length)
    if misspelt is None:
        return runs.select(F.col("run").alias("word"))
    hashed = runs.withColumn("h", F.crc32(F.concat("doc_id", F.lit(":"), "run")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return hashed.select(F.when(F.col("h") % misspelt == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """Distinct words of enough code points and occurrences: word, n. Counted in the tasks before the shuffle."""
    long = words.filter(F.length("word") >= least_length)
    return long.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


def _ends(word: Column, size: Column, low: Column, high: Column) -> list[Column]:
    """What two words share whose edit lies at ``low`` or after and before ``high``: their starts and their ends."""
    shared_end = F.greatest(size - high, F.lit(0))
    return [
        F.substring(word, F.lit(1), low).alias("start"),
        F.substring(word, F.length(word) - shared_end + 1, shared_end).alias("end"),
    ]


def _listed(words: DataFrame) -> DataFrame:
    """Every word in the lists in which it meets the words one edit away.

    A list is for pairs of which the shorter has ``size`` code points, so a word is in the lists of its own length and
    of one less. The edit of a pair is in the first half, and the rest of both is equal, or it's in the second half, and
    what is before that is equal: lists are by these equal parts.
    """
    sized = words.withColumn("size", F.explode(F.array(F.length("word"), F.length("word") - 1)))
    half = F.floor(F.col("size") / 2).cast("int")
    sides = F.array(
        F.struct(F.lit(0).alias("low"), half.alias("high")), F.struct(half.alias("low"), (F.col("size") + 1).alias("high"))
    )
    dealt = sized.withColumn("side", F.explode(sides)).select("word", "n", "size", "side.low", "side.high")
    return dealt.select("*", *_ends(F.col("word"), F.col("size"), F.col("low"), F.col("high")))


def _split(rows: DataFrame) -> DataFrame:
    """The words of lists in lists of half the places that the edit can be at."""
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    halves = F.array(
        F.struct(F.col("low"), middle.alias("high")), F.struct(middle.alias("low"), F.col("high"))
    )
    dealt = rows.withColumn("side", F.explode(halves)).select("word", "n", "size", "side.low", "side.high")
    return dealt.select("*", *_ends(F.col("word"), F.col("size"), F.col("low"), F.col("high")))


_LIST = ["size", "low", "high", "start", "end"]


def bounded_lists(words: DataFrame, most: int = LIST) -> list[DataFrame]:
    """``_listed`` with every list of more than ``most`` words split until it has fewer or the edit's place is fixed.

    With its place fixed, a list's words differ in one code point or two, so no list is longer than the alphabet
    allows; a start or an end that very many words share is no list of very many words.
    """
    done, rows = [], checkpointed(_listed(words))
    while True:
        wide = rows.filter(F.col("high") - F.col("low") > 1).groupBy(*_LIST).count().filter(F.col("count") > most)
        wide = checkpointed(wide.drop("count"))
        if wide.isEmpty():
            return [*done, rows]
        done.append(rows.join(wide, _LIST, "left_anti"))
        rows = checkpointed(_split(rows.join(wide, _LIST, "left_semi")))


def near_in_list(words: list[str], rows: list[int]) -> Iterator[tuple[int, int]]:
    """Pairs (i, j) of places in a sorted list such that ``words[j]`` is one edit from ``words[i]``, i from ``rows``.

    The list is gone through once for each word i, as the rows of its edit matrix with the words of the list. A row
    stands for a start of a word and is a band of three numbers, the edits between that start and the starts of i's
    word that are one shorter, as long and one longer. The next word of the list takes over the rows of the start that
    it shares with the one before. Where all three numbers of a row exceed one, every word with that start is too far,
    and the list goes on after them.
    """
    n, far = len(words), 2
    shared = [0] * n
    for j in range(1, n):
        a, b = words[j - 1], words[j]
        most, k = min(len(a), len(b)), 0
        while k < most and a[k] == b[k]:
            k += 1
        shared[j] = k
    for i in rows:
        own = words[i]
        size = len(own)
        band = [(far, 0, 1 if size else far)]
        j = 0
        while j < n:
            other = words[j]
            depth = min(shared[j], len(band) - 1)
            del band[depth + 1 :]
            less, same, more = band[depth]
            dead = False
            while depth < len(other):
                c = other[depth]
                # the band of the start of depth + 1 code points, from that of depth
                new_less = min(
                    less + (own[depth - 1] != c) if 0 < depth <= size else far,
                    same + 1 if depth <= size else far,
                )
                new_same = min(
                    same + (own[depth] != c) if depth < size else far,
                    more + 1 if depth < size else far,
                    new_less + 1 if depth < size else far,
                )
                new_more = (
                    min(more + (own[depth + 1] != c), new_same + 1) if depth + 1 < size else far
                )
                less, same, more = new_less, new_same, new_more
                depth += 1
                if less > 1 and same > 1 and more > 1:
                    dead = True
                    break
                band.append((less, same, more))
            if dead:
                # all words that share this start are as far
                j += 1
                while j < n and shared[j] >= depth:
                    j += 1
                continue
            gap = size - len(other)
            if j != i and (same if gap == 0 else more if gap == 1 else less if gap == -1 else far) == 1:
                yield i, j
            j += 1


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of lists that arrive one after the other: both words and their counts, in both directions."""

    def pairs(key: tuple, held: list[tuple[str, str, int]], out: list[list]) -> None:
        size, start, end = key
        if len(held) < 2:
            return
        held.sort()
        middles = [m for m, _, _ in held]
        # pairs of two longer words are those of another list
        rows = [i for i, (_, w, _) in enumerate(held) if len(w) == size]
        for i, j in near_in_list(middles, rows):
            (_, a, n_a), (_, b, n_b) = held[i], held[j]
            both = ((a, n_a, b, n_b),) if len(b) == size else ((a, n_a, b, n_b), (b, n_b, a, n_a))
            for pair in both:
                for column, value in zip(out, pair, strict=True):
                    column.append(value)

    def batch_of(out: list[list]) -> pa.RecordBatch:
        types = (pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(out, types, strict=True)], ["word", "n", "near", "near_n"]
        )

    last, held, out = None, [], [[], [], [], []]
    for batch in batches:
        for word, n, size, low, high, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            key = (size, low, high, start, end)
            if key != last:
                if last is not None:
                    pairs((last[0], last[3], last[4]), held, out)
                last, held = key, []
                if len(out[0]) >= 1 << 14:
                    yield batch_of(out)
                    out = [[], [], [], []]
            # lists share their starts and ends, which are no part of the matrix
            held.append((word[len(start) : len(word) - len(end)], word, n))
    if last is not None:
        pairs((last[0], last[3], last[4]), held, out)
    yield batch_of(out)


def near_words(words: DataFrame, most: int = LIST) -> DataFrame:
    """All pairs of words exactly one inserted, deleted or replaced code point apart, in both directions.

    ``words``: word, n, with distinct words. Lists of words that share one half are dealt over the cluster and sorted;
    a task holds one list at a time. They are dealt by a hash of their key: Spark takes a dealing by the key itself out of the
    plan after a join on it, and may cut that join's skewed partitions, and so lists, in parts.

    Columns: word, n, near, near_n.
    """
    found = None
    for rows in bounded_lists(words, most):
        rows = rows.select("word", "n", *_LIST).repartition(F.xxhash64(*_LIST)).sortWithinPartitions(*_LIST)
        pairs = rows.mapInArrow(_scanned, "word string, n long, near string, near_n long")
        found = pairs if found is None else found.unionAll(pairs)
    return found.distinct()


def roots(forms: DataFrame) -> DataFrame:
    """The last form of every word that has one: word, root. ``forms``: word, form, without cycles.

    Each round replaces a root by its own root, so paths are halved; a word that many others lead to is the key of
    one row on one side of the join.
    """
    done = checkpointed(forms.select("word", F.col("form").alias("root")))
    while True:
        next_root = done.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = done.join(next_root, "root", "left")
        moved = checkpointed(joined.select("word", F.coalesce("further", "root").alias("root"), "further"))
        if moved.filter("further IS NOT NULL").isEmpty():
            return moved.select("word", "root")
        done = moved.select("word", "root")


def spelling_variants(
    docs: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    ratio: int = RATIO,
    misspelt: int | None = MISSPELT,
    most: int = LIST,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The words of all texts, each with the more usual word that it is a variant of.

    Words are runs of letters up to U+00FF, A-Z lower-cased, of at least ``least_length`` code points and ``least_count``
    occurrences. Near words are exactly one inserted, deleted or replaced code point apart. A word's form is its most
    frequent near word (of equals the first in code-point order), if that occurs ``ratio`` times as often as the word
    at least; its root is where the forms lead in the end.

    Words are counted where their texts are. Lists of words with an equal half meet in the tasks, where each is scanned in
    order with the rows of an edit matrix (``near_in_list``); lists too long for that are split by the place of
    the edit (``bounded_lists``), which loses no pair. So no list or task grows with the vocabulary.

    Null texts have no words; a null id is hashed as empty text. Repeated rows count as often as they come. An empty table
    gives no rows. Other columns are not read, whatever their names.

    Columns: word, form, root, n, n_near, form_n (form and form_n null where there is none).
    """
    # no word is longer than its run
    words = occurrences(docs, least_length, misspelt, id_col, text_col)
    words = checkpointed(vocabulary(words, least_length, least_count))
    near = near_words(words, most).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("down"), "near")).alias("best")
    )
    joined = words.join(near, "word", "left")
    form_n = -F.col("best.down")
    usual = form_n >= F.lit(ratio) * F.col("n")
    formed = checkpointed(
        joined.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(usual, F.col("best.near")).alias("form"),
            F.when(usual, form_n).alias("form_n"),
        )
    )
    found = roots(formed.filter("form IS NOT NULL"))
    return formed.join(found, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
