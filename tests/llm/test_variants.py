"""Spelling variants against comparing all words with all."""

import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyframe.llm.variants import bounded_lists, near_in_list, near_words, roots, spelling_variants
from tests.conftest import plan, rows


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(docs, least=5, misspelt=199, length=6, ratio=5):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if misspelt and h % misspelt == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += len(run) >= length
    n = {w: c for w, c in n.items() if c >= least}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted(((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n), key=repr)


def test_list_scan():
    rnd = random.Random(2)
    for alphabet, longest in (("ab", 5), ("abcé", 4), ("a", 9), ("xyz", 2)):
        for _ in range(60):
            words = sorted({"".join(rnd.choices(alphabet, k=rnd.randint(0, longest))) for _ in range(rnd.randint(1, 40))})
            got = sorted(near_in_list(words, range(len(words))))
            assert got == [(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if one_edit(a, b)]


@pytest.mark.parametrize("most", [1, 4, 1000])
def test_near_words_with_split_lists(spark, most):
    rnd = random.Random(4)
    # one start and one end that most words share, so that lists have to be split
    words = {"".join(rnd.choices("abé", k=rnd.randint(6, 8))) for _ in range(150)}
    words |= {"prefix" + "".join(rnd.choices("ab", k=5)) for _ in range(100)} | {"".join(rnd.choices("ab", k=5)) + "suffix" for _ in range(100)}
    table = spark.createDataFrame([(w, len(w)) for w in words], "word string, n long")
    if most == 4:
        longest = [d.filter("high - low > 1").groupBy("size", "low", "high", "start", "end").count() for d in bounded_lists(table, most)]
        assert max(r["count"] for d in longest for r in d.collect()) <= most
    got = sorted((r.word, r.near) for r in near_words(table, most).collect())
    assert got == sorted((a, b) for a in words for b in words if one_edit(a, b))


def test_lists_are_dealt_after_joins(spark):
    # Spark splits skewed partitions of a join, and lists with them, unless they are dealt by themselves
    words = ["".join(w) for w in itertools.product("abc", repeat=6)]
    table = spark.createDataFrame([(w, 1) for w in words], "word string, n long").repartition(8)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        text = plan(near_words(table, 30))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.count("LeftAnti") > 0
    assert text.count("REPARTITION_BY_COL") == text.count("MapInArrow")


def test_against_brute_force(spark):
    rnd = random.Random(6)
    stems = ["nation", "Station", "stations", "éclair", "eclairs", "ÉCLAIRS", "working", "workings", "worlings", "xworking", "cafétier", "quoique"]
    docs = [(i, " ".join(rnd.choices(stems, weights=[rnd.choice([1, 9, 80]) for _ in stems], k=120)) + " a-b×c÷dddddd 123") for i in range(60)]
    docs += [(None, "working " * 40), (70, None), (71, ""), (72, "nations " * 6), (72, "nations " * 6), (73, "workin " * 200_00)]
    table = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, word string, n int").repartition(4)
    got = spelling_variants(table, misspelt=199)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert rows(got) == brute(docs)
    assert rows(spelling_variants(table, misspelt=7, least_count=2, ratio=2)) == brute(docs, least=2, misspelt=7, ratio=2)
    assert rows(spelling_variants(table)) == brute(docs, misspelt=None)


def test_chains_and_empty_tables(spark):
    chain = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(21)] + [("v", "w3")], "word string, form string")
    assert {r.root for r in roots(chain).collect()} == {"w21"}
    assert spelling_variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    alone = spark.createDataFrame([(1, "lonely " * 5)], "doc_id long, text string")
    assert rows(spelling_variants(alone)) == [("lonely", None, "lonely", 5, 0, None)]
    assert alone.select(F.lit(1)).count() == 1
