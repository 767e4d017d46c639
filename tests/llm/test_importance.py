"""Resampling towards a target, against counting and scoring in plain Python."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from tallyframe.llm.importance import Interned, Ngrams, bucket_counts, resampled, take_resampled
from tests.conftest import rows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, sizes):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(low)
    return len(words), [" ".join(words[i : i + n]) for n in range(sizes[0], sizes[1] + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, sizes=(1, 1), buckets=10_000, percent=10, least=20):
    at = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for counts, texts in ((s, [d[1] for d in docs]), (t, target)):
        for text in texts:
            for f in features(text, sizes)[1]:
                counts[at(f)] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    out = []
    for doc_id, text in docs:
        n_words, found = features(text, sizes)
        weight = sum(gain[at(f)] for f in found)
        name = "" if doc_id is None else doc_id
        h = int(hashlib.sha256(f"2024:{name}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words])
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = {id(r): i + 1 for i, r in enumerate(able[: percent * len(able) // 100])}
    return sorted(((*r[:4], ranks.get(id(r))) for r in out), key=repr)


@pytest.fixture(scope="module")
def many():
    rnd = random.Random(3)
    words = ["the", "Of", "ÀÉ", "straße", "ÄB", "don't", "a-b", "x1", "日本語", "w" * 31, "w" * 32, "w" * 40, "w" * 39 + "v", "12345678", "123456789"]
    docs = [(i, " ".join(rnd.choices(words, k=rnd.choice([0, 1, 19, 20, 60])))) for i in range(300)]
    docs += [(300, None), (301, ""), (302, " \n\t.,"), (None, "null id " * 15), (303, "long " * 60_000), (304, "z" * 200_000), (-7, "tie " * 30)]
    return docs, ["the straße 日本語 of", None, "x1 don't " * 9, "w" * 40]


@pytest.mark.parametrize(("sizes", "percent"), [((1, 1), 10), ((1, 3), 37), ((2, 2), 100)])
def test_against_brute_force(spark, many, sizes, percent):
    docs, target = many
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = resampled(table, spark.createDataFrame([(t,) for t in target], "text string"), percent=percent, sizes=sizes)
    assert rows(got.select("doc_id", "n_features", "weight", "score", "rank")) == brute(docs, target, sizes, percent=percent)


def test_keys_and_slots():
    rnd = random.Random(1)
    texts = [" ".join("".join(rnd.choices("abcdé9", k=rnd.randint(1, 70))) for _ in range(200)).encode() for _ in range(20)]
    ngrams = Ngrams([*texts, b"", texts[0]], (1, 2))
    raws = [ngrams.raw(i) for i in range(len(ngrams.starts))]
    assert ngrams.keys().tolist() == [xxhash.xxh64_intdigest(r) for r in raws]
    assert sorted(r.decode() for r in raws) == sorted(f for t in [*texts, texts[0]] for f in features(t.decode(), (1, 2))[1])
    table = Interned(ngrams, 50)
    assert len(table.used) == len(set(raws))
    for i, slot in enumerate(table.slot_of):
        assert table.bucket[slot] == zlib.crc32(raws[i]) % 50
    assert sorted(table.count[table.used]) == sorted(np.unique(np.array(raws, object), return_counts=True)[1])


def test_equal_keys_of_other_bytes_are_kept_apart(monkeypatch):
    monkeypatch.setattr(Ngrams, "keys", lambda self: np.zeros(len(self.starts), np.uint64))
    ngrams = Ngrams([b"a b a abcdefgh abcdefgi abcdefghi abcdefghj a b " + b"q" * 64 + b" " + b"q" * 63 + b"r"])
    table = Interned(ngrams, 1000)
    assert len(table.used) == 8 and sorted(table.count[table.used].tolist()) == [1, 1, 1, 1, 1, 1, 2, 3]


def test_odd_tables(spark, many):
    schema = "doc_id string, text string, task int, place int, `row` int, score int, id int"
    docs = spark.createDataFrame([(f"d{i}", "a b c " * 10, 1, 2, i, 4, 5) for i in range(30)] + [("d1", "a b c " * 10, 1, 2, 3, 4, 5)] * 9, schema)
    target = spark.createDataFrame([("a",)], "text string")
    got = resampled(docs, target).collect()
    assert len(got) == 39 and sorted(r["rank"] for r in got if r["rank"]) == [1, 2, 3]
    drawn = take_resampled(docs, target)
    assert drawn.columns == docs.columns and {r.doc_id for r in drawn.collect()} == {r.doc_id for r in got if r["rank"]}
    assert resampled(docs.limit(0), target).collect() == []
    assert {r.weight for r in resampled(docs, target.limit(0)).collect()} != {0}
    assert bucket_counts(target.limit(0)).sum() == 0
    one = resampled(docs.limit(1), target, percent=100).collect()
    assert [r["rank"] for r in one] == [1]
