"""Mixing sources to target weights: certain whole copies, then a Pareto order sample of the rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import WORD, checkpointed, join_ids, packed, text_of

#: slices of the sampling order per source; the sample is cut inside one of them
SLICES = 4096
#: copies of a source's row that its documents are dealt over, so that a large source is no single key
SALTS = 32
SEED = 20240501


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """Target words of each source: in proportion to its weight, at most ``cap`` times its size.

    ``sizes``: source, source_size. What capped sources leave is shared again by weight until none is above its cap.
    The end of that is a water level: with sources in order of cap / weight, all up to some place are capped and
    the others get level x weight. One row per source is all that these windows see.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_fill = Window.orderBy("fill", F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    ranked = sizes.withColumn("place", F.row_number().over(by_name) - 1).withColumn("weight", weight)
    caps = ranked.withColumn("most", F.col("source_size") * float(cap)).withColumn("fill", F.col("most") / F.col("weight"))
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    from_here = by_fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    levels = caps.withColumn("total", F.sum("source_size").over(everything) * float(share)).withColumn(
        "level",
        (F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(from_here),
    )
    # the first source that the water does not fill (of equal ones, by name) fixes the level; if it fills all, the caps are the targets
    level = F.min_by(
        F.when(F.col("level") <= F.col("fill"), F.col("level")),
        F.when(F.col("level") <= F.col("fill"), F.struct("fill", "place")),
    ).over(everything)
    return levels.withColumn("level", level).select(
        "source", "source_size", F.coalesce(F.least("most", F.col("level") * F.col("weight")), "most").alias("target")
    )


def rounded(importance: Column) -> Column:
    """A positive number to three digits; what is null, not positive or not finite is 1. So few values are distinct."""
    usable = importance.isNotNull() & (importance > 0) & (importance < float("inf"))
    scale = F.pow(F.lit(10.0), F.floor(F.log10(importance)) - 2)
    return F.when(usable, F.greatest(F.round(importance / scale) * scale, F.lit(1e-300))).otherwise(F.lit(1.0))


def inclusion_levels(sized: DataFrame, wanted: DataFrame) -> DataFrame:
    """For each source the level c at which documents of inclusion probability min(1, c * importance) have the wanted words.

    ``sized``: source, size, importance; ``wanted``: source, wanted (words, fewer than the source has). Documents that
    are sure to be taken are the most important ones, as many values of importance as it needs until c * importance
    is at most 1 for the next value: what they have is taken off the wanted words, and c shared among the rest.
    A source's rows here are its distinct values of importance. Columns: source, level (null where nothing is wanted).
    """
    values = sized.groupBy("source", "importance").agg(
        F.sum("size").alias("words"), F.sum(F.col("size") * F.col("importance")).alias("mass")
    )
    order = Window.partitionBy("source").orderBy(F.col("importance").desc())
    above = order.rowsBetween(Window.unboundedPreceding, -1)
    from_here = order.rowsBetween(0, Window.unboundedFollowing)
    steps = join_ids(values, wanted, ["source"]).select(
        "source",
        "importance",
        ((F.col("wanted") - F.coalesce(F.sum("words").over(above), F.lit(0))) / F.nullif(F.sum("mass").over(from_here), F.lit(0.0))).alias("c"),
    )
    # the first value, from the top, whose own documents are not sure
    fits = steps.filter((F.col("c") > 0) & (F.col("c") * F.col("importance") <= 1 + 1e-9))
    return fits.groupBy("source").agg(F.max_by("c", "importance").alias("level"))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    cap: float = 2.0,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    importance_col: str | None = None,
    by_words: bool = True,
) -> DataFrame:
    """How often the mix takes each document.

    Sources in order of their names (null last) weigh ``weights``, repeating. A source is to give target / size
    copies of each of its documents: the whole part of that is certain for all, and of the documents the fraction is
    sampled once more, without replacement and by unequal probabilities. A document's inclusion probability is
    min(1, c * importance), with the c of its source at which the words of the sample are expected to be those wanted
    (``inclusion_levels``). Its importance is ``importance_col``, or with ``by_words`` its number of words, else 1;
    to three digits. Documents get odds from a hash of seed, id and text, divided by the odds of their inclusion, and the
    smallest are taken (Pareto order sampling). The sample's size is fixed in words: it ends where taking or leaving
    the next document is as near to the target as possible. No document is taken more than ceil(target / size)
    times, so never above ``cap``, if that is whole.

    The cut is found without sorting a source: words per slice of the order are summed first, and only the
    slice with the cut, about 1/4096 of a source, is sorted. Reruns agree.

    Null and empty texts have size 0 and ride along with the order. Null is a source and an id like others. Rows that repeat
    an id are documents of their own; equal ones are interchangeable. An importance that is null, not positive or not
    finite counts as 1. An empty table gives no rows. Other columns are not read, whatever their names.

    Columns: doc_id, text_hash, size, source, source_size, target, copies, taken.
    """
    given = F.col(importance_col) if importance_col else F.lit(None)
    read = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), text_of(text_col).alias("text"),
        given.cast("double").alias("given"),
    )
    words = word_count(F.col("text"))
    importance = F.col("given") if importance_col else words.cast("double") if by_words else F.lit(1.0)
    sized = checkpointed(
        read.select(
            "doc_id",
            "source",
            words.alias("size"),
            F.xxhash64("text").alias("text_hash"),
            rounded(importance).alias("importance"),
            F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")).alias("u"),
        )
    )
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = (
        source_targets(sizes, weights, share, cap)
        .withColumn("rate", rate)
        .withColumn("whole", F.floor("rate"))
        .withColumn("rest", F.col("rate") - F.col("whole"))
    )
    wanted = targets.select("source", (F.col("rest") * F.col("source_size")).alias("wanted"))
    levels = inclusion_levels(sized, wanted)
    targets = checkpointed(join_ids(targets, levels, ["source"], "left"))
    wanted = targets.select("source", (F.col("rest") * F.col("source_size")).alias("wanted"))

    salt = F.pmod(F.col("u"), F.lit(SALTS)).cast("int")
    dealt = targets.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = join_ids(sized.withColumn("salt", salt), dealt, ["source", "salt"])
    # u is uniform in (0, 1); q / (1 + q) puts the Pareto order on (0, 1) too, where it is cut to slices
    uniform = (F.shiftrightunsigned("u", 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    ordered = rows.withColumn("p", F.coalesce(F.col("level") * F.col("importance"), F.lit(0.0)))
    q = uniform / (1 - uniform) * (1 - F.col("p")) / F.col("p")
    ordered = ordered.withColumn("order", F.when(F.col("p") >= 1, 0.0).when(F.col("p") > 0, q / (1 + q)).otherwise(1.0))
    # documents that are sure are a slice before all others
    slice_of = F.least(F.floor(F.col("order") * SLICES), F.lit(SLICES - 1)).cast("int")
    ordered = ordered.withColumn("slice", F.when(F.col("p") >= 1, -1).otherwise(slice_of)).drop("p", "level")

    slices = ordered.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    running = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)))
    slices = join_ids(slices, wanted, ["source"])
    # the last slice that begins below the wanted words holds the cut
    cuts = slices.filter((F.col("slice") >= 0) & (F.col("before") < F.col("wanted"))).groupBy("source").agg(
        F.max("slice").alias("cut"), F.max_by("before", "slice").alias("before"), F.max("wanted").alias("wanted")
    )
    cuts = cuts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    near = join_ids(ordered, cuts, ["source", "salt"], "left").fillna(-2, ["cut"])
    taken = (F.col("slice") < 0) | (F.col("slice") < F.col("cut"))
    clear = near.filter(F.col("slice") != F.col("cut")).withColumn("extra", taken.cast("int"))
    order = Window.partitionBy("source").orderBy("order", "u", "doc_id", "text_hash")
    through = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) + F.col("before")
    split = near.filter(F.col("slice") == F.col("cut")).withColumn("through", through)
    # taken while the middle of the document lies below the wanted words
    split = split.withColumn("extra", (F.col("through") - F.col("size") / 2 <= F.col("wanted")).cast("int"))
    return clear.unionByName(split.drop("through")).select(
        "doc_id", "text_hash", "size", "source", "source_size", "target",
        (F.col("whole") + F.col("extra")).alias("copies"),
        ((F.col("whole") + F.col("extra")) * F.col("size")).alias("taken"),
    )


def take_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The mix itself: each row of ``docs`` as many times as it is taken, with all its columns.

    Of rows that repeat id and text, each appears as often as all of them are taken on average, rounded down for
    some and up for others.
    """
    mixed = mix(docs, id_col=id_col, text_col=text_col, **how)
    per_text = mixed.groupBy("doc_id", "text_hash").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows"))
    per_text = per_text.filter("copies > 0").withColumnRenamed("doc_id", "id")
    joined = join_ids(packed(docs, id_col, text_col), per_text, ["id", "text_hash"])
    once = joined.filter("rows = 1").select("row", F.col("copies").alias("times"))
    # repeats of one row are interchangeable: one row of each task stands for all of its repeats
    again = joined.filter("rows > 1").groupBy("id", "text_hash", "row").agg(
        F.count(F.lit(1)).alias("n"), F.min("copies").alias("copies"), F.min("rows").alias("rows")
    )
    before = F.sum("n").over(
        Window.partitionBy("id", "text_hash").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    )
    again = again.withColumn("before", F.coalesce(before, F.lit(0)))
    # the first copies % rows of an id and text's rows are taken once more than the others
    more = F.greatest(F.least(F.col("n"), F.col("copies") % F.col("rows") - F.col("before")), F.lit(0))
    again = again.select("row", (F.floor(F.col("copies") / F.col("rows")) * F.col("n") + more).alias("times"))
    return (
        once.unionAll(again)
        .filter("times > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times").cast("long"))))
        .select("row.*")
    )
