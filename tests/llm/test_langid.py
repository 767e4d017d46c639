"""Language identification on held-out rows, and its parts against plain Python."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.llm.langid import (
    BITS, document_counts, fit_languages, ftrl, held_out, ngram_counts, predict_languages, temperature,
)

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return fit_languages(docs)


def test_held_out_accuracy(docs, model):
    found = predict_languages(docs, model).join(docs, "doc_id").withColumn("held_out", held_out("doc_id")).collect()
    assert len(found) == docs.count()
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    own = [r for r in found if r.held_out and r.lang]
    right = np.array([r.lang_pred == r.lang for r in own])
    assert right.mean() > 0.98
    # calibrated: what it says of itself is near to what is
    assert abs(np.mean([r.score for r in own]) - right.mean()) < 0.05
    assert 0 < (model.weights != 0).mean() < 0.9


def test_held_out_rows_and_other_columns_teach_nothing(spark, docs, model):
    wrong = docs.withColumn("lang", F.when(held_out("doc_id"), F.lit("xx")).otherwise(F.col("lang")))
    wrong = wrong.withColumn("text", F.when(held_out("doc_id"), F.lit("!!")).otherwise(F.col("text"))).drop("source")
    other = fit_languages(wrong.withColumn("source", F.lit("s")).repartition(3))
    assert other.languages == model.languages and np.array_equal(other.weights, model.weights)
    assert other.temperature == model.temperature


def test_odd_texts(spark, model):
    texts = [None, "", " \n", "123 !?", "é", "İ straße ǅ", "the " * 100_000, "x" * 300_000, "\U0001F600", "\U00010400bc"]
    table = spark.createDataFrame([(i, t, "zz", 3) for i, t in enumerate([*texts, *texts])] + [(None, "a", "zz", 1)], "doc_id long, text string, lang string, score int")
    got = sorted(predict_languages(table, model).collect(), key=repr)
    assert len(got) == 2 * len(texts) + 1
    for r in got:
        lettered = r.doc_id is None or any(c.isalpha() for c in ([*texts, *texts][r.doc_id] or ""))
        assert (r.lang_pred in model.languages and 0 < r.score <= 1) if lettered else (r.lang_pred, r.score) == ("und", 0.0)
    assert predict_languages(table.limit(0), model).collect() == []
    nothing = fit_languages(table.limit(0))
    assert {r.lang_pred for r in predict_languages(table, nothing).collect()} == {"und"}
    learnt = next(i for i in range(9) if zlib.crc32(str(i).encode()) % 3 != 1)
    one = fit_languages(spark.createDataFrame([(learnt, "some words", "en")] * 3 + [(learnt, "wordless", None)], "doc_id long, text string, lang string"))
    assert one.languages == ["en"]
    assert {r.lang_pred for r in predict_languages(table, one).collect()} == {"und", "en"}


def brute_grams(text):
    low = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    low = " " + " ".join(low.split()) + " "
    out = Counter()
    for n in (1, 2, 3):
        for i in range(len(low) - n + 1):
            gram = low[i : i + n]
            if gram.strip() and " " not in gram[1:-1]:
                out[gram] += 1
    return out


def test_ngrams():
    texts = ["Aa, bé!", "", "...", "x", "ß y-z  zz", "İi", "A" * 50, " lead", "trail "]
    row, feature, count = ngram_counts(texts)
    for i, t in enumerate(texts):
        want = brute_grams(t)
        assert count[row == i].sum() == sum(want.values())
        assert sorted(count[row == i].tolist()) == sorted(want.values())  # few enough not to collide
    alone = [ngram_counts([t]) for t in texts]
    assert np.array_equal(np.concatenate([a[1] for a in alone]), feature)
    assert feature.max() < 1 << BITS


def test_document_counts(spark):
    texts = ["ab ab", "ab", None, "b"] * 5
    have, n = document_counts(spark.createDataFrame([(t or "",) for t in texts], "text string").repartition(3))
    _, ab, _ = ngram_counts(["ab"])
    assert n == 20 and sorted(have[have > 0].tolist()) == sorted(Counter(
        f for t in texts for f in set(ngram_counts([t or ""])[1].tolist())
    ).values()) and have[ab].min() >= 10


def test_ftrl_is_sparse_and_temperature_calibrates():
    random = np.random.default_rng(0)
    x, y = random.normal(size=(600, 40)), random.integers(0, 3, 600)
    x[np.arange(600), y] += 2
    begins, feature = np.arange(601) * 40, np.tile(np.arange(40), 600)
    rows = (begins, feature, x.ravel())
    plain, _ = ftrl(rows, y, 3, 40, l1=0.0)
    sparse, bias = ftrl(rows, y, 3, 40, l1=30.0)
    assert (plain != 0).all() and 0.2 < (sparse == 0).mean() < 1
    assert (np.argmax(x @ sparse.T + bias, axis=1) == y).mean() > 0.8
    logits = random.normal(size=(20_000, 3))
    p = np.exp(logits) / np.exp(logits).sum(axis=1, keepdims=True)
    labels = (p.cumsum(axis=1) < random.random((20_000, 1))).sum(axis=1)
    assert abs(temperature(logits * 4, labels) - 4) < 0.3
