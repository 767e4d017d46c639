"""Targets, sampling and repetition of the mix."""

import random
from collections import Counter

import pytest

from pyspark.sql import functions as F

from tallyframe.llm.mixing import mix, take_mix
from tests.conftest import plan


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left = {}, share * sum(sizes.values())
    free = set(names)
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > cap * sizes[s]}
        if not over:
            target |= {s: left * weight[s] / total for s in free}
            break
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
        free -= over
    return target


def documents(spark, rows, schema="doc_id long, source string, text string"):
    return spark.createDataFrame(rows, schema).repartition(4)


@pytest.fixture(scope="module")
def many():
    rnd = random.Random(5)
    sources = ["a"] * 900 + ["b"] * 300 + ["ü", "z", None, "B", "c"] * 40 + ["tiny"]
    return [(i, s, "w " * rnd.choice([1, 3, 20, 60])) for i, s in enumerate(sources)]


def test_targets_and_sizes(spark, many):
    rows = [*many, (None, "a", None), (-1, "empty", ""), (-2, "empty", " \n")]
    got = mix(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, s, t in rows:
        sizes[s] += len((t or "").split())
    target = brute_targets(dict(sizes))
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source]
        assert abs(r.target - target[r.source]) < 1e-6 * max(1, target[r.source])
        assert 0 <= r.taken == r.copies * r.size <= 2 * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 30, s


def test_targets_of_sources_that_fill_alike(spark):
    rows = [(i, s, "w " * 10) for i, s in enumerate("abcdef" * 5)]
    for weights, share in (((1,), 0.7), ((1,), 1.5), ((1,), 2.5), ((2, 1), 1.4), ((5, 2, 1), 1.5)):
        got = mix(documents(spark, rows), weights=weights, share=share).collect()
        target = brute_targets(dict.fromkeys("abcdef", 50), weights, share)
        assert all(abs(r.target - target[r.source]) < 1e-9 for r in got)


def test_reruns_agree_and_seeds_differ(spark, many):
    docs = documents(spark, many)
    first = sorted((r.doc_id, r.copies) for r in mix(docs).collect())
    assert first == sorted((r.doc_id, r.copies) for r in mix(docs.repartition(7)).collect())
    assert first != sorted((r.doc_id, r.copies) for r in mix(docs, seed=1).collect())


def test_importance_raises_inclusion(spark):
    rows = [(i, "s", "w w", 8.0 if i % 2 else 1.0) for i in range(2000)] + [(9000, "s", "w w", None), (9001, "s", "w w", -1.0)]
    docs = documents(spark, rows, "doc_id long, source string, text string, copies double")
    got = mix(docs, share=0.5, importance_col="copies").collect()
    kept = Counter(r.doc_id % 2 for r in got if r.copies)
    assert kept[1] > 2 * kept[0] > 0
    assert abs(sum(r.taken for r in got) - got[0].target) <= 2


def inclusions(sizes, importances, wanted):
    """min(1, c * importance) with the wanted words, the sure documents found one after the other."""
    sure, left = set(), set(range(len(sizes)))
    while True:
        c = (wanted - sum(sizes[i] for i in sure)) / sum(sizes[i] * importances[i] for i in left)
        more = {i for i in left if c * importances[i] > 1}
        if not more:
            return [1.0 if i in sure else c * importances[i] for i in range(len(sizes))]
        sure, left = sure | more, left - more


@pytest.mark.parametrize("by", ["words", "column"])
def test_inclusion_frequencies(spark, by):
    """Four hundred sources of the same documents are four hundred independent samples."""
    rnd = random.Random(8)
    n, draws, share = 60, 400, 0.75
    sizes = [rnd.choice([1, 2, 3, 5, 8, 40]) for _ in range(n)]
    given = [float(rnd.choice([1, 2, 4, 100])) for _ in range(n)]
    one = spark.createDataFrame([(i, "w " * sizes[i], given[i]) for i in range(n)], "i long, text string, given double")
    docs = one.crossJoin(spark.range(draws).withColumnRenamed("id", "draw")).select(
        (F.col("draw") * n + F.col("i")).alias("doc_id"), F.format_string("s%03d", "draw").alias("source"), "text", "given"
    )
    got = mix(docs, weights=(1,), share=share, importance_col="given" if by == "column" else None).collect()
    p = inclusions(sizes, given if by == "column" else [float(x) for x in sizes], share * sum(sizes))
    assert max(p) == 1 and min(p) < 0.4
    taken = Counter(r.doc_id % n for r in got if r.copies)
    for i in range(n):
        # four standard deviations, and a little for the last document of each sample
        assert abs(taken[i] / draws - p[i]) < 4 * (p[i] * (1 - p[i]) / draws) ** 0.5 + 0.03, (i, sizes[i], p[i])
    words = Counter()
    for r in got:
        words[r.source] += r.taken
    assert all(abs(w - got[0].target) <= max(sizes) / 2 + 1 for w in words.values())


def test_half_of_a_source_nine_times_as_important(spark):
    rows = [(i, "s", "w w", 9.0 if i % 2 else 1.0) for i in range(4000)]
    docs = documents(spark, rows, "doc_id long, source string, text string, importance double")
    kept = Counter(r.doc_id % 2 for r in mix(docs, share=0.5, importance_col="importance").collect() if r.copies)
    assert abs(kept[1] / 2000 - 0.9) < 0.03 and abs(kept[0] / 2000 - 0.1) < 0.03


def test_equal_odds_and_odd_importances(spark):
    odd = [None, -1.0, 0.0, float("nan"), float("inf"), 1.0]
    docs = documents(spark, [(i, "s", "w", odd[i % 6]) for i in range(3000)], "doc_id long, source string, text string, x double")
    for how in ({"importance_col": "x"}, {"by_words": False}):
        kept = Counter(r.doc_id % 6 for r in mix(docs, share=0.5, **how).collect() if r.copies)
        assert sum(kept.values()) == 1500 and all(abs(k - 250) < 60 for k in kept.values())


def test_whole_targets_and_sources_of_empty_texts(spark):
    rows = [(i, "a", "w " * (i % 3)) for i in range(30)] + [(100 + i, "b", "") for i in range(5)]
    for share in (1.0, 2.0):
        got = mix(documents(spark, rows), weights=(1,), share=share).collect()
        assert sum(r.taken for r in got) == share * 30 and len(got) == 35


NAMES = ["row", "id", "text_hash", "copies", "rows", "times", "copy", "n", "before", "_right_id", "_llm_text_hash", "_rows", "_copies", "_mix_id"]


def test_clashing_columns_stay(spark):
    schema = "doc_id long, source string, text string, " + ", ".join(f"`{n}` string" for n in NAMES) + ", `a.b``c` int"
    rows = [(i, "s", "w " * (1 + i % 4), *[f"{n}{i}" for n in NAMES], i) for i in range(40)] * 2
    docs = documents(spark, rows, schema)
    got = take_mix(docs)
    assert got.columns == docs.columns
    found = got.collect()
    assert found and all(tuple(r) in set(rows) for r in found)


def test_take_repeats_rows(spark, many):
    rows = [*many, (5000, "a", "same"), (5000, "a", "same"), (None, None, None)]
    docs = documents(spark, rows)
    wanted = Counter()
    for r in mix(docs).collect():
        wanted[r.doc_id] += r.copies
    taken = take_mix(docs)
    assert taken.columns == docs.columns
    got = Counter(r.doc_id for r in taken.collect())
    assert got == Counter({k: v for k, v in wanted.items() if v})


def test_odd_tables(spark):
    assert mix(documents(spark, [])).collect() == []
    assert take_mix(documents(spark, [])).collect() == []
    assert [r.taken for r in mix(documents(spark, [(1, None, None), (2, "a", "")])).collect()] == [0, 0]
    assert "Python" not in plan(mix(documents(spark, [(1, "a", "b c")])))
