"""Bottom-k sketches against exact sets."""

import random
import re

from pyspark.sql import functions as F

from tallyframe.llm import fingerprint as fp
from tests.conftest import plan


def exact(text, size=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def sketched(spark, pairs):
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    hashed = rows.select("i", *[fp.word_hashes(F.coalesce(F.col(c), F.lit(""))).alias(c) for c in "ab"])
    return hashed.select("i", *[fp.sketch(F.col(c)).alias(c) for c in "ab"])


def test_small_sets_are_exact(spark):
    words = "one two three four five six seven eight nine ten".split()
    rnd = random.Random(1)
    pairs = [(" ".join(rnd.choices(words, k=rnd.randint(0, 20))), " ".join(rnd.choices(words, k=rnd.randint(0, 20)))) for _ in range(80)]
    pairs += [("", ""), (None, "a"), ("a b", "a b"), ("a b", "b a"), (" a\n b ", "a b"), (pairs[0][0] or "x",) * 2]
    out = sketched(spark, pairs).select(
        "i", fp.resemblance(F.col("a"), F.col("b")).alias("j"), fp.distinct_shingles(F.col("a")).alias("n"),
        fp.containment(F.col("a"), F.col("b")).alias("c"), "a", "b",
    )
    for r in out.collect():
        a, b = map(exact, pairs[r.i])
        assert r.n == len(a)
        assert abs(r.j - (len(a & b) / len(a | b) if a | b else 1)) < 1e-12
        assert abs(r.c - (len(a & b) / len(a) if a else 1)) < 1e-9


def test_large_sets_and_merging(spark):
    rnd = random.Random(2)
    base = [str(rnd.random()) for _ in range(9000)]
    pairs = [(" ".join(base[:6000]), " ".join(base[3000:])), (" ".join(base[:8000]), " ".join(base[:7000]))]
    out = sketched(spark, pairs)
    for r in out.select("i", "a", fp.resemblance(F.col("a"), F.col("b")).alias("j"), fp.distinct_shingles(F.col("a")).alias("n")).collect():
        a, b = map(exact, pairs[r.i])
        assert len(r.a) == fp.K and r.a == sorted(set(r.a))
        assert abs(r.j - len(a & b) / len(a | b)) < 0.1
        assert abs(r.n / len(a) - 1) < 0.2
    # the sketch of a whole is the merged sketch of its parts
    parts = sketched(spark, [(" ".join(base[:5000]), " ".join(base[4996:]))])
    whole = sketched(spark, [(" ".join(base), "")]).select("a").first().a
    assert parts.select(fp.merge(F.col("a"), F.col("b"))).first()[0] == whole


def brute_next(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    return {r[0]: order[(i + 1) % len(order)][1] or "" for i, r in enumerate(order)}


def test_next_document(spark, monkeypatch):
    monkeypatch.setattr(fp, "BLOCK_ROWS", 3)
    rnd = random.Random(3)
    for ids in ([5], [1, 2], [0, 10**18, -(10**18), 7, 8, 9], rnd.sample(range(10**6), 60), [*range(40), 10**9, None]):
        rows = [(i, f"text {i}" if i != 8 else None) for i in ids]
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        got = fp.with_next(docs).collect()
        assert len(got) == len(rows)
        assert {r.doc_id: r.next_text for r in got} == brute_next(rows)


def test_odd_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, block int")
    assert fp.with_next(docs).collect() == [] and fp.fingerprints(docs).collect() == []
    rows = [(1, "a", 1), (1, "a", 2), (None, None, 3), (None, "b", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, block int")
    assert len(fp.with_next(docs).collect()) == 4
    got = fp.fingerprints(docs).collect()
    assert sorted(len(r.sketch) for r in got) == [0, 1, 1, 1]
    text = fp.fingerprints(docs).select("n_chars", fp.as_text(F.col("sketch")).alias("f"))
    assert sorted({tuple(r) for r in text.collect()})[0] == (0, "")
    assert "Python" not in plan(text) and "Arrow" not in plan(text)
