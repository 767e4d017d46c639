"""N-gram Jaccard join: parity sketches, joined by pigeonhole, then verified."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.arrow import Step, buffers, map_texts
from tallyframe.llm.common import Steps, checkpointed, keep_one_each, text_of
from tallyframe.llm.components import components
from tallyframe.llm.words import mix, shingles, words

#: sizes of a band go from its least size to GROWTH times that
GROWTH = 1.4
#: blocks a document shows to find its easy neighbours before the full join
FIRST_BLOCKS = 16
#: most bits of the filter that tells which sets are needed
FILTER_BITS = 1 << 26
#: shingles in about so many sets are left out of sketches, counted on every SAMPLEth set; MOST_COMMON at most
COMMON, SAMPLE, MOST_COMMON = 256, 16, 1 << 22
#: larger buckets are compared by bit sketches, in tiles of so many sets
SMALL_BUCKET, TILE = 12, 512
#: buckets of so many classes by a count on every HOT_SAMPLEth class are looked through by many tasks
HOT, HOT_SAMPLE = 16_384, 64
#: text bytes that a step sees at once
STEP = 1 << 20


class Bands:
    """Size bands and their sketches for a similarity of ``percent`` in a hundred.

    Two linked sets of sizes a <= b have b <= a * 100 / percent. Band g is joined with itself and with all larger
    sets that its sets could link to, up to ``tops[g]``. Such a pair differs by at most ``limits[g]`` shingles.
    Each shingle falls in one block of a sketch and flips one of its bits, so the pair's sketches differ in no more
    blocks than that: of ``blocks[g] = limits[g] + 1 + spares[g]`` blocks at least ``spares[g] + 1`` agree, and a
    set with no more than ``spares[g]`` empty blocks need not show these. All this holds as well if some shingles
    are left out of every sketch. Where the limit is 0, only equal sets link.
    """

    def __init__(self, percent: int, largest: int = 1 << 40) -> None:
        self.lows, self.tops, self.limits, self.spares = [], [], [], []
        low = 1
        while low <= largest:
            after = max(low + 1, int(low * GROWTH))
            top = (after - 1) * 100 // percent
            limit = (after - 1 + top) * (100 - percent) // (100 + percent)
            self.lows.append(low)
            self.tops.append(top)
            self.limits.append(limit)
            self.spares.append(-(-(limit + 1) // 4))
            low = after
        self.blocks = np.array(self.limits) + 1 + np.array(self.spares)
        self._lows, self._tops, self._limits = np.array(self.lows), np.array(self.tops), np.array(self.limits)

    def of(self, sizes: np.ndarray) -> list[np.ndarray]:
        """The bands that each set is in: its own first, then those that it joins as a larger set; -1 for none."""
        own = np.searchsorted(self._lows, sizes, "right") - 1
        found, back = [], 0
        while back < len(self.lows):
            band = own - back
            fits = (band >= 0) & (sizes > 0) & (sizes <= self._tops[np.maximum(band, 0)])
            if back and not fits.any():
                break
            found.append(np.where(fits & (self._limits[np.maximum(band, 0)] > 0), band, -1))
            back += 1
        return found


class Blocks:
    """The blocks of many sets' sketches, one after the other.

    A block's key stands for the bits that its shingles leave set: the exclusive or of a code per bit.
    """

    def __init__(self, values: np.ndarray, counts: np.ndarray, bands: Bands, band: np.ndarray, family: int) -> None:
        blocks = np.where(band >= 0, bands.blocks[np.maximum(band, 0)], 0)
        firsts = np.concatenate(([0], np.cumsum(blocks)))
        of = np.repeat(np.arange(len(counts)), counts)
        inside = (band >= 0)[of]
        values, of = values[inside], of[inside]
        spread = mix(values ^ np.uint64(0x5851F42D4C957F2D)) % np.maximum(blocks, 1)[of].astype(np.uint64)
        place = firsts[of] + spread.astype(np.int64)
        parity = np.zeros(firsts[-1], np.uint64)
        np.bitwise_xor.at(parity, place, values)
        self.empty = np.bincount(place, minlength=firsts[-1]) == 0
        self.owner = np.repeat(np.arange(len(counts)), blocks)
        self.number = np.arange(firsts[-1]) - firsts[self.owner]
        label = (band[self.owner] * 2 + family).astype(np.uint64) << np.uint64(40)
        self.keys = mix(parity ^ mix(label + self.number.astype(np.uint64)))
        empties = np.bincount(self.owner[self.empty], minlength=len(counts))
        self.thin = empties > np.array(bands.spares)[np.maximum(band, 0)]

    def shown(self, show: np.ndarray, sets: int) -> tuple[np.ndarray, np.ndarray]:
        return self.keys[show], np.bincount(self.owner[show], minlength=sets)


def first_keys(values: np.ndarray, counts: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    blocks = Blocks(values, counts, bands, bands.of(counts)[0], 1)
    return blocks.shown(~blocks.empty & (blocks.number < FIRST_BLOCKS), len(counts))


def all_keys(values: np.ndarray, counts: np.ndarray, bands: Bands, common: np.ndarray):
    """Keys by which linked sets meet, in parts: of sketches without common shingles, and for sets of which too
    little is left then, of whole sketches, in which they meet each other."""
    rare = ~common[(values % np.uint64(len(common))).astype(np.int64)]
    of = np.repeat(np.arange(len(counts)), counts)
    left = np.bincount(of[rare], minlength=len(counts))
    parts = []
    for band in bands.of(counts):
        blocks = Blocks(values[rare], left, bands, band, 0)
        parts.append(blocks.shown(~blocks.empty, len(counts)))
        whole = Blocks(values, counts, bands, np.where(blocks.thin, band, -1), 1)
        parts.append(whole.shown(~whole.empty | whole.thin[whole.owner], len(counts)))
    return parts


def _lists(values: list[np.ndarray], counts: list[np.ndarray]) -> pa.Array:
    """One list per set from parts that each have some values per set."""
    order = np.argsort(np.concatenate([np.repeat(np.arange(len(c)), c) for c in counts]), kind="stable")
    offsets = np.concatenate(([0], np.cumsum(sum(counts)))).astype(np.int32)
    flat = np.concatenate(values)[order].view(np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _sets(batch: pa.RecordBatch, size: int):
    values, counts = shingles(*words(*buffers(batch.column("text"))), size)
    ends = np.concatenate(([0], np.cumsum(counts)))
    raw = [values[ends[i] : ends[i + 1]].tobytes() for i in range(len(counts))]
    return values, counts, raw, [hashlib.blake2b(r, digest_size=16).digest() for r in raw]


def _slots(digests: list[bytes]) -> np.ndarray:
    return np.array([int.from_bytes(d[:4], "little") for d in digests], np.int64)


def _describe(size: int, bands: Bands) -> Step:
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        values, counts, _, digests = _sets(batch, size)
        keys, shown = first_keys(values, counts, bands)
        slots = _slots(digests)
        sampled = np.where(slots % SAMPLE == 0, counts, 0)
        members = values[np.repeat(sampled > 0, counts)]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), pa.array(digests, pa.binary()), pa.array(slots),
                pa.array(counts.astype(np.int64)), _lists([keys], [shown]), _lists([members], [sampled]),
            ],
            ["doc_id", "digest", "slot", "n_shingles", "keys", "sample"],
        )

    return step


def _show_all(size: int, bands: Bands, common) -> Step:
    common = _bits(common)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        values, counts, _, digests = _sets(batch, size)
        parts = all_keys(values, counts, bands, common)
        keys = _lists([p[0] for p in parts], [p[1] for p in parts])
        return pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), keys], ["digest", "keys"])

    return step


def _some_sets(size: int, needed) -> Step:
    needed = _bits(needed)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        values, counts, _, digests = _sets(batch, size)
        keep = needed[_slots(digests) % len(needed)] if digests else np.zeros(0, bool)
        of = np.repeat(np.arange(len(counts)), counts)
        members = _lists([values[keep[of]]], [counts[keep]])
        return pa.RecordBatch.from_arrays(
            [pa.array([d for d, k in zip(digests, keep, strict=True) if k], pa.binary()), members],
            ["digest", "members"],
        )

    return step


def _some_sketches(size: int, needed) -> Step:
    """Bit sketches of about 8 bits a shingle or more: every shingle flips one."""
    needed = _bits(needed)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        values, counts, _, digests = _sets(batch, size)
        ends = np.concatenate(([0], np.cumsum(counts)))
        keep = np.flatnonzero(needed[_slots(digests) % len(needed)]) if digests else np.zeros(0, np.int64)
        sketches = []
        for i in keep:
            members = values[ends[i] : ends[i + 1]]
            length = 1 << max(0, (len(members) // 8).bit_length())
            sketch, at = np.zeros(length, np.uint64), mix(members)
            # low bits choose the word and the highest its bit, so halves of a sketch make the shorter one
            word = (at & np.uint64(length - 1)).astype(np.int64)
            np.bitwise_xor.at(sketch, word, np.uint64(1) << (at >> np.uint64(58)))
            sketches.append(sketch.tobytes())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([digests[i] for i in keep], pa.binary()), pa.array(counts[keep].astype(np.int64)),
                pa.array(sketches, pa.binary()),
            ],
            ["digest", "n_shingles", "sketch"],
        )

    return step


def _bits(packed) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed.value, np.uint8), bitorder="little").astype(bool)


def _bitmap(numbers: DataFrame, count: int) -> bytes:
    """A bitmap of a column of numbers modulo its length: 8 bits for each of ``count``, FILTER_BITS at most.

    It is put together by ranges of its bits, of which there are no more than a 32nd of its length.
    """
    bits = min(FILTER_BITS, 1 << max(6, (8 * count - 1).bit_length()))
    # numbers are 64-bit patterns, so bits is a power of two
    at = numbers.toDF("number").select(F.col("number").bitwiseAND(F.lit(bits - 1)).alias("bit"))
    cells = at.groupBy(F.floor(F.col("bit") / 32).alias("cell")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit % 32 AS int))")).alias("mask")
    )
    out, found = np.zeros(bits // 32, np.uint32), cells.toArrow()
    out[found.column("cell").to_numpy()] = found.column("mask").to_numpy().astype(np.uint32)
    return out.tobytes()


def _sets_of(texts: DataFrame, size: int, sent) -> DataFrame:
    """The distinct sets whose digest's slot is in the bitmap that was sent: digest, members."""
    found = map_texts(texts, lambda: _some_sets(size, sent), "digest binary, members array<long>", step_bytes=STEP)
    return found.groupBy("digest").agg(F.first("members").alias("members"))


def _common_shingles(classes: DataFrame) -> bytes:
    """A bitmap of shingles that very many sets have, counted on a fixed share of all sets, those that have a sample.

    Which shingles are common only decides how many sets meet in a block. So they can be taken from
    a sample, and others with the same bit may count as common. The threshold rises until at most MOST_COMMON are left.
    """
    sampled = classes.select(F.explode("sample").alias("shingle"))
    counts = checkpointed(sampled.groupBy("shingle").count().filter(F.col("count") >= COMMON // SAMPLE))
    steps = F.floor(F.log2(F.col("count"))).cast("int")
    above, threshold = 0, COMMON // SAMPLE
    for row in counts.groupBy(steps.alias("step")).count().orderBy(F.desc("step")).collect():
        above += row["count"]
        if above > MOST_COMMON:
            threshold = max(threshold, 2 << row["step"])
            break
    common = counts.filter(F.col("count") >= threshold).select("shingle")
    return _bitmap(common, common.count())


def _links(steps: Steps, pairs: DataFrame, classes: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) of class numbers whose sets are similar enough."""
    pairs = steps.stored(pairs.distinct())
    wanted = pairs.select(F.col("a").alias("cid")).unionAll(pairs.select(F.col("b").alias("cid"))).distinct()
    wanted = steps.stored(classes.select("cid", "digest", "slot").join(wanted, "cid", "left_semi"))
    sent = texts.sparkSession.sparkContext.broadcast(_bitmap(wanted.select("slot"), wanted.count()))
    sets = steps.stored(wanted.join(_sets_of(texts, size, sent), "digest").select("cid", "members"))
    sent.destroy()
    with_b = pairs.join(sets.select(F.col("cid").alias("b"), F.col("members").alias("set_b")), "b")
    with_a = with_b.join(sets.select(F.col("cid").alias("a"), F.col("members").alias("set_a")), "a")
    both = F.size(F.array_intersect("set_a", "set_b"))
    measured = with_a.select("a", "b", both.alias("both"), (F.size("set_a") + F.size("set_b")).alias("sizes"))
    linked = steps.stored(
        measured.filter(F.col("both") * 100 >= percent * (F.col("sizes") - F.col("both"))).select("a", "b")
    )
    steps.remove(pairs, wanted, sets)
    return linked


def _hot_buckets(rows: DataFrame) -> DataFrame:
    """Keys of buckets that very many classes share, as a sample of classes tells: key.

    Which they are decides only by how many tasks a bucket is looked through.
    """
    sampled = rows.filter(F.pmod(F.xxhash64("cid"), F.lit(HOT_SAMPLE)) == 0)
    return sampled.groupBy("key").count().filter(F.col("count") >= HOT // HOT_SAMPLE).select("key")


def _star_pairs(steps: Steps, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """In every bucket the pairs of its best-connected class with the others, and the stored rows that they are made of.

    ``rows``: key, cid, group. Buckets are counted in the tasks first and joined back, so that one of very many
    classes is no single task.
    """
    sizes = rows.groupBy("key").agg((F.count(F.lit(1)) - 1).alias("more")).filter("more > 0")
    shared = steps.stored(rows.join(sizes, "key"))
    degrees = shared.groupBy("cid").agg(F.sum("more").alias("degree"))
    ranked = shared.join(degrees, "cid")
    centers = ranked.groupBy("key").agg(F.max(F.struct("degree", "cid", "group")).alias("center"))
    met = shared.join(centers, "key").filter(F.col("group") != F.col("center.group"))
    return met.select(F.col("center.cid").alias("a"), F.col("cid").alias("b")), shared


def _across(steps: Steps, rows: DataFrame) -> DataFrame:
    """The rows of buckets in which different groups meet, with the number of rows of their bucket.

    Most buckets have one row or a few: these are looked through where they are, by windows after one shuffle. The
    few of very many classes are counted in the tasks first, and their rows joined with those counts.
    """
    hot = steps.stored(_hot_buckets(rows))
    bucket = Window.partitionBy("key")
    told = {
        "n_rows": F.count(F.lit(1)).over(bucket), "least": F.min("group").over(bucket), "most": F.max("group").over(bucket),
    }
    found_hot = not hot.isEmpty()
    others = rows.join(hot, "key", "left_anti") if found_hot else rows
    # most classes are their own group, which needs no bytes in the shuffle
    dealt = others.select("key", "cid", F.nullif("group", "cid").alias("group")).repartition("key")
    every = dealt.select("key", "cid", F.coalesce("group", "cid").alias("group")).withColumns(told)
    if found_hot:
        crowded = rows.join(hot, "key", "left_semi")
        counted = crowded.groupBy("key").agg(
            F.count(F.lit(1)).alias("n_rows"), F.min("group").alias("least"), F.max("group").alias("most")
        )
        every = every.unionByName(crowded.join(counted, "key"))
    return steps.stored(every.filter("least != most").select("key", "cid", "group", "n_rows"))


def _cross_pairs(rows: DataFrame) -> DataFrame:
    """In every bucket the pairs of classes of different groups. ``rows``: key, cid, group."""
    other = rows.select("key", F.col("cid").alias("b"), F.col("group").alias("group_b"))
    met = rows.join(other, "key").filter(F.col("group") < F.col("group_b"))
    return met.select(F.least("cid", "b").alias("a"), F.greatest("cid", "b").alias("b"))


def _folded(sketches: list[bytes]) -> np.ndarray:
    """Bit sketches as rows of 64-bit words, all as long as the shortest: halves of a longer one are put together."""
    width = min(map(len, sketches))
    out = np.empty((len(sketches), width // 8), np.uint64)
    for i, raw in enumerate(sketches):
        words = np.frombuffer(raw, np.uint64)
        out[i] = np.bitwise_xor.reduce(words.reshape(-1, width // 8), axis=0)
    return out


def _compared(percent: int):
    """Pairs of a tile of a bucket that are of different groups and near enough by their sketches."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("tile")
        bits = _folded(rows.column("sketch").to_pylist())
        cid, group, sizes, tile = (rows.column(c).to_numpy() for c in ("cid", "group", "n_shingles", "tile"))
        # against the other tile, or in one tile against those that follow
        begin = int(np.searchsorted(tile, tile[0], "right")) if tile[0] != tile[-1] else None
        found_a, found_b = [], []
        for i in range(len(cid) if begin is None else begin):
            to = slice(i + 1 if begin is None else begin, None)
            apart = np.bitwise_count(bits[to] ^ bits[i]).sum(axis=1, dtype=np.int64)
            near = apart * (100 + percent) <= (sizes[to] + sizes[i]) * (100 - percent)
            hits = np.flatnonzero(near & (group[to] != group[i])) + to.start
            found_a.append(np.full(len(hits), cid[i]))
            found_b.append(cid[hits])
        a, b = np.concatenate(found_a or [cid[:0]]), np.concatenate(found_b or [cid[:0]])
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return run


def _near_pairs(rows: DataFrame, wanted: DataFrame, needed, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs of different groups in large buckets whose sketches' Hamming distance admits a link.

    A bucket is dealt to tiles of about TILE sets, and every pair of tiles compares its sketches where it is; only
    pairs that are near enough come out. ``rows``: key, cid, group, n_rows; ``wanted``: cid, digest of their classes,
    whose slots are in the bitmap ``needed``.
    """
    schema = "digest binary, n_shingles long, sketch binary"
    found = map_texts(texts, lambda: _some_sketches(size, needed), schema, step_bytes=STEP)
    found = found.groupBy("digest", "n_shingles").agg(F.first("sketch").alias("sketch"))
    sketches = wanted.join(found, "digest").select("cid", "n_shingles", "sketch")
    tiles = F.ceil(F.col("n_rows") / TILE).cast("int")
    dealt = rows.withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("cid"), "tiles").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    dealt = dealt.select(
        "key", "cid", "group", "tile", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high")
    )
    met = dealt.join(sketches, "cid").groupBy("key", "low", "high")
    return met.applyInArrow(_compared(percent), "a long, b long")


def similar_documents(
    docs: DataFrame, percent: int = 80, size: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Component of every document under links of Jaccard similarity ``percent`` in a hundred or more.

    A document's set has its distinct ``size``-word shingles (ASCII white space parts words, A-Z are lower-cased); a text of
    fewer words is one shingle, and a text without words has none and links with nothing.

    1. Equal sets are one class from here on, merged within partitions before the shuffle.
    2. Classes that share one of their first few blocks meet in stars around the best-connected class, are
       verified on their whole sets, and form groups.
    3. All blocks of all classes are joined by band (see ``Bands``). Buckets within one group say nothing new and
       are dropped where they are; in the others classes of different groups are compared. The pigeonhole
       makes this complete: two linked classes of different groups share a bucket, so no link is lost. Shingles of
       very many sets are left out of these sketches, so that a passage that many documents share does not bring
       them together; sets of little else meet each other by their whole sketches. Pairs of small buckets are
       verified; in large ones, of near copies that fall short of a link, longer bit sketches are compared
       in tiles, and only pairs whose Hamming distance admits a link are.
    4. Components of the links of both steps.

    So a group of near copies of one document costs one pair per copy. Shingle sets are not kept: those that a
    verification needs are made again from the texts, told by a bitmap of bounded size. Shingles are compared as 64-bit
    hashes, sets as 128-bit digests.

    Null texts are empty. Null ids never name a component unless all its ids are null. Rows that repeat an id are
    documents of their own. An empty table gives no rows. Other columns are not read, whatever their names.

    Columns: doc_id, n_shingles, component_id (the smallest id of the component), class_size (documents with this set).
    """
    spark, bands = docs.sparkSession, Bands(percent)
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    id_type = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, digest binary, slot long, n_shingles long, keys array<long>, sample array<long>"
    described = map_texts(texts, lambda: _describe(size, bands), schema, step_bytes=STEP)
    steps = Steps(spark)
    described = steps.stored(described.withColumn("run", F.spark_partition_id()))
    # the run deals a class of very many documents over tasks, here and on the way back
    local = described.groupBy("run", "digest", "n_shingles").agg(
        F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n"),
        F.first(F.struct("slot", "keys", "sample")).alias("shown"),
    )
    classes = local.groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"), F.sum("n").alias("class_size"), F.first("shown").alias("shown"),
        F.max("n_shingles").alias("n_shingles"),
    )
    classes = steps.stored(
        classes.select(
            "digest", "doc_id", "class_size", "n_shingles", "shown.*", F.monotonically_increasing_id().alias("cid")
        )
    )
    # from here on without what only the first steps need
    wide, described = described, steps.stored(described.select("run", "digest", "doc_id"))
    steps.remove(wide)
    only_texts = texts.select("text")
    common = spark.sparkContext.broadcast(_common_shingles(classes))
    first = classes.select("cid", F.col("cid").alias("group"), F.explode("keys").alias("key"))
    pairs, shared = _star_pairs(steps, first)
    wide, classes = classes, steps.stored(classes.drop("keys", "sample"))
    steps.remove(wide)
    easy = _links(steps, pairs, classes, only_texts, size, percent)
    steps.remove(shared)
    groups = components(easy)

    numbered = classes.filter("n_shingles > 0").select("digest", "cid").join(
        groups.withColumnRenamed("node", "cid"), "cid", "left"
    ).select("digest", "cid", F.coalesce("root", "cid").alias("group"))
    schema = "digest binary, keys array<long>"
    shown = map_texts(only_texts, lambda: _show_all(size, bands, common), schema, step_bytes=STEP)
    shown = shown.groupBy("digest").agg(F.first("keys").alias("keys")).join(numbered, "digest")
    shown = steps.stored(shown.select("cid", "group", "keys"))
    common.destroy()
    sized = _across(steps, shown.select("cid", "group", F.explode("keys").alias("key")))
    steps.remove(shown)
    small = _cross_pairs(sized.filter(F.col("n_rows") <= SMALL_BUCKET).drop("n_rows"))
    crowded = sized.filter(F.col("n_rows") > SMALL_BUCKET)
    wanted = classes.join(crowded.select("cid").distinct(), "cid", "left_semi").select("cid", "digest", "slot")
    wanted = steps.stored(wanted)
    needed = spark.sparkContext.broadcast(_bitmap(wanted.select("slot"), wanted.count()))
    large = _near_pairs(crowded, wanted, needed, only_texts, size, percent)
    links = easy.unionAll(_links(steps, small.unionAll(large), classes, only_texts, size, percent))
    needed.destroy()
    steps.remove(sized, wanted)

    roots = components(links).withColumnRenamed("node", "cid")
    rooted = classes.join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    names = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = rooted.join(names, "root").select("digest", "component_id", "class_size", "n_shingles")
    in_runs = described.select("run", "digest").distinct().join(named, "digest")
    # sets that are empty are no class: each such document stands for itself
    return described.select("run", "digest", "doc_id").join(in_runs, ["run", "digest"]).select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n_shingles") > 0, F.col("class_size")).otherwise(1).alias("class_size"),
    )


def drop_similar(
    docs: DataFrame, percent: int = 80, size: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` with the smallest id of each component, with all their columns.

    Of a component's rows with that id the one of the smallest text hash stays. Texts without words all stay.
    """
    # null ids come after all others
    key = F.struct(
        F.col(id_col).isNull().alias("unnamed"), F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("text_hash")
    )
    similar = similar_documents(docs.select(key.alias("doc_id"), F.col(text_col).alias("text")), percent, size)
    decisions = similar.select(
        F.col("doc_id.id").alias("doc_id"),
        F.col("doc_id.text_hash").alias("text_hash"),
        (F.col("doc_id") == F.col("component_id")).alias("kept"),
    )
    return keep_one_each(docs, checkpointed(decisions), id_col, text_col)
