"""The registered queries without SQL, as registered, against second implementations."""

import base64
import hashlib
import html
import re
import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from tallyframe.llm.queries import QUERIES
from tests.llm.test_mixing import brute_targets

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


def run(spark, name):
    rows = QUERIES[name](spark, SMALL).collect()
    return {r[0]: r for r in rows}, len(rows)


def sketch(text, k=256, size=5):
    """Bottom-k of hashed shingles, by the xxhash library: a row's hash is each column's, seeded by the one before."""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    signed = [struct.pack("<Q", xxhash.xxh64_intdigest(w.encode(), 42)) for w in words]
    found = set()
    for i in range(max(1, len(words) - size + 1) if words else 0):
        h = 42
        for part in signed[i : i + size]:
            h = xxhash.xxh64_intdigest(part, h)
        found.add(h >> 16)
    return sorted(found)[:k]


def likeness(a, b, k=256):
    union = sorted(set(a) | set(b))[:k]
    return len(set(a) & set(b) & set(union)) / len(union) if union else 1.0


def test_op2_fingerprints(spark, documents):
    got, n = run(spark, "op2_fingerprints")
    assert n == len(documents)
    order = sorted(documents, reverse=True)
    text = {i: documents[i].text or "" for i in order}
    own = {i: sketch(text[i]) for i in order}
    for i, after in zip(order, [*order[1:], order[0]], strict=True):
        third = len(text[i]) // 3
        edited = text[i][: len(text[i]) - third] + text[after][:third]
        r, changed = got[i], sketch(edited)
        assert (r.n_chars, r.edited_sha256) == (len(text[i]), hashlib.sha256(edited.encode()).hexdigest())
        for fingerprint, want in ((r.fingerprint, own[i]), (r.edited_fingerprint, changed)):
            assert base64.b64decode(fingerprint) == b"".join(h.to_bytes(6, "big") for h in want)
        assert r.near_edited == pytest.approx(likeness(own[i], changed))
        assert r.near_next == pytest.approx(likeness(own[i], own[after]))


def test_op3_source_mix(spark, documents):
    got, n = run(spark, "op3_source_mix")
    assert n == len(documents)
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for i, d in documents.items():
        size = len([w for w in re.split(r"[\x20\x09-\x0D]+", d.text or "") if w])
        r = got[i]
        assert r["size"] == size and r.source == d.source and 0 <= r.taken <= 2 * size and r.taken == r.copies * size
        sizes[d.source] += size
        taken[d.source] += r.taken
        largest[d.source] = max(largest[d.source], size)
    target = brute_targets(sizes)
    for i, d in documents.items():
        assert got[i].source_size == sizes[d.source] and got[i].target == pytest.approx(target[d.source])
    # a sample ends with a whole document
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1 for s in sizes)
    again, _ = run(spark, "op3_source_mix")
    assert {i: r.taken for i, r in got.items()} == {i: r.taken for i, r in again.items()}


def test_op6_html_text(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    got, n = run(spark, "op6_html_text")
    assert n == len(pages)
    for p in pages:
        article = re.search(r"<article>(.*)</article>", p.html, re.DOTALL)[1]
        article = re.sub(r"<(script|style).*?</\1>", "", article, flags=re.DOTALL)
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", article)).split())
        assert (got[p.page_id].text, got[p.page_id].n_chars, got[p.page_id].url) == (want, len(want), p.url)


def test_op7_pii(spark, documents):
    got, n = run(spark, "op7_pii")
    assert n == len(documents)
    plain = re.compile(r"[\w.+-]+@[\w-]+\.[\w.]+|\b\d{3}-\d{2}-\d{4}\b|\b(?:\d{1,3}\.){3}\d{1,3}\b")
    for i, d in documents.items():
        before = set(plain.findall(d.text or ""))
        assert not before & set(plain.findall(got[i].text)), (i, before)
        if not got[i].n_replaced:
            assert got[i].text == (d.text or "")


def test_op9_quality(spark, documents):
    got, n = run(spark, "op9_quality")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    assert n == len(documents)
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    right = [got[i].predicted == q for i, q in labels.items() if q is not None and i in got]
    assert np.mean(right) > 0.9


def test_op11_language(spark, documents):
    got, n = run(spark, "op11_language")
    assert n == len(documents)
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1
        if not any(c.isalpha() for c in documents[i].text or ""):
            assert r.lang_pred == "und"
    held = [got[i].lang_pred == d.lang for i, d in documents.items() if got[i].held_out and d.lang]
    assert np.mean(held) > 0.9
