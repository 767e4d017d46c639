"""The similarity join and components against all pairs."""

import random
import re

import numpy as np
import pytest

from tallyframe.llm import jaccard_join as jj
from tallyframe.llm.components import components
from tallyframe.llm.words import shingles, words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def roots(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return [find(i) for i in range(n)]


def brute(rows, percent, size):
    found = [sets(t, size) for _, t in rows]
    links = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if found[i] and found[j] and 100 * len(found[i] & found[j]) >= percent * len(found[i] | found[j])
    ]
    root = roots(len(rows), links)
    smallest = {}
    for (i, _), r in zip(rows, root, strict=True):
        smallest[r] = min((x for x in (smallest.get(r), i) if x is not None), default=None)
    return sorted(((i, len(s), smallest[r]) for (i, _), s, r in zip(rows, found, root, strict=True)), key=repr)


def copies(rnd, text, n, edits):
    for _ in range(n):
        w = text.split()
        for _ in range(rnd.randint(0, edits)):
            w[rnd.randrange(len(w))] = f"new{rnd.randrange(1000)}"
        yield " ".join(w)


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choices("abcdefgh", k=rnd.randint(2, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage = text(60)
    texts = [text(rnd.randint(1, 300)) for _ in range(60)]
    texts += [f"{text(rnd.randint(1, 80))} {passage}" for _ in range(120)]
    for n, edits in ((150, 12), (80, 30), (40, 3), (10, 1)):
        texts += copies(rnd, text(n), 70, edits)
    texts += copies(rnd, text(2500), 6, 60)
    texts += ["A b c d", "a B c d", "a b c", "a b c", "", " \n", None, "x", "x", text(20_000)]
    rnd.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("percent", "size"), [(85, 4), (80, 5), (60, 2)])
def test_components(spark, corpus, percent, size):
    docs = spark.createDataFrame(corpus, "doc_id long, text string").repartition(5)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jj.similar_documents(docs, percent, size).collect()]
    assert sorted(got, key=repr) == brute(corpus, percent, size)


@pytest.mark.parametrize(("first", "common", "small", "tile"), [(1, 16, 12, 512), (0, 64, 2, 4), (2, 1 << 40, 10**9, 512)])
def test_every_path_is_complete(spark, corpus, monkeypatch, first, common, small, tile):
    monkeypatch.setattr(jj, "FIRST_BLOCKS", first)
    monkeypatch.setattr(jj, "COMMON", common)
    monkeypatch.setattr(jj, "SAMPLE", 1 if common < 1 << 40 else 16)
    monkeypatch.setattr(jj, "SMALL_BUCKET", small)
    monkeypatch.setattr(jj, "TILE", tile)
    if small == 2:  # most buckets count as hot
        monkeypatch.setattr(jj, "HOT", 4)
        monkeypatch.setattr(jj, "HOT_SAMPLE", 2)
    docs = spark.createDataFrame(corpus, "doc_id long, text string").repartition(3)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jj.similar_documents(docs, 85, 4).collect()]
    assert sorted(got, key=repr) == brute(corpus, 85, 4)


def test_linked_sets_always_share_a_key():
    rng = np.random.default_rng(3)
    for percent in (60, 85, 95):
        bands, common = jj.Bands(percent), rng.random(1 << 12) < 0.2
        for _ in range(300):
            n = int(rng.integers(2, 400))
            a = rng.integers(0, 1 << 63, n).astype(np.uint64)
            drop = rng.integers(0, n // 6 + 1)
            b = np.concatenate((a[drop:], rng.integers(0, 1 << 63, int(rng.integers(0, n // 6 + 1))).astype(np.uint64)))
            both = n - drop
            if 100 * both < percent * (n + len(b) - both) or not len(b) or both == n == len(b):
                continue
            parts = jj.all_keys(np.concatenate((a, b)), np.array([n, len(b)]), bands, common)
            shown = [set(), set()]
            for keys, counts in parts:
                shown[0] |= set(keys[: counts[0]].tolist())
                shown[1] |= set(keys[counts[0] :].tolist())
            assert shown[0] & shown[1]


def test_repeats_nulls_and_other_columns(spark):
    t = " ".join(f"w{i}" for i in range(40))
    rows = [(1, t, "x"), (1, t, "x"), (None, t + " end", "y"), (3, None, "z"), (3, "", "z"), (7, t + " END", "k"), (5, "q r", None)]
    names = ["digest", "row", "id", "text_hash", "unnamed", "kept", "_llm_text_hash", "_right_doc_id", "_llm_row", "n"]
    rows = [(i, t, *[None if v is None else f"{v}{n}" for n in names]) for i, t, v in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    got = sorted((tuple(r)[:3] for r in jj.similar_documents(docs, 80, 5).collect()), key=repr)
    assert got == brute([r[:2] for r in rows], 80, 5)
    kept = jj.drop_similar(docs, 80, 5)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.filter("text != ''").collect()) == [1, 5]
    assert all(tuple(r) in set(rows) for r in kept.collect())
    assert kept.filter("coalesce(text, '') = ''").count() == 1  # one id and text
    assert jj.similar_documents(docs.limit(0)).collect() == [] and jj.drop_similar(docs.limit(0)).collect() == []


def test_components_of_links(spark):
    rnd = random.Random(2)
    links = [(i, i + 1) for i in range(40)] + [(100 + rnd.randrange(60), 100 + rnd.randrange(60)) for _ in range(50)]
    links += [(300, 300 + i) for i in range(50)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "x long, y long")).collect()}
    root = roots(400, links)
    assert got == {i: root[i] for link in links for i in link if link[0] != link[1]}


def test_words_and_shingles(monkeypatch):
    from tallyframe.llm import words as module

    monkeypatch.setattr(module, "_PIECE", 50)
    rnd = random.Random(9)
    texts = ["", "a", " a", "a b", "É é", "x" * 500 + " y", *["".join(rnd.choices("ab \n\té", k=rnd.randint(0, 300))) for _ in range(60)]]
    data = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, data)])
    hashes, counts = words(np.frombuffer(b"".join(data), np.uint8), offsets)
    assert counts.tolist() == [len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in texts]
    flat = [w for t in texts for w in re.findall(r"[^\x20\x09-\x0D]+", t)]
    assert len(set(flat)) == len(set(hashes.tolist())) == len(set(zip(flat, hashes.tolist(), strict=True)))
    for size in (1, 4):
        assert shingles(hashes, counts, size)[1].tolist() == [len(sets(t, size)) for t in texts]
