"""Counts against the tokenizers library's unigram model."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from tallyframe.llm.token_counts import UnigramCounter, UnigramVocabulary, token_counts, vocabulary_of


def library(vocabulary):
    model = models.Unigram(list(vocabulary.pieces), unk_id=0, byte_fallback=vocabulary.byte_fallback)
    tokenizer = Tokenizer(model)
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return tokenizer


@pytest.fixture(scope="module")
def vocabulary():
    return vocabulary_of(public_tokenizers.path("piece_bpe_32k.model"))


def test_against_the_library(vocabulary):
    rnd = random.Random(7)
    texts = ["", " ", "  ", "a", " a", "a ", "a  b", "▁", "▁a ▁ b", "\n", "日本語", "😀😀 x", "<s> <0x0A>", "the end" * 3000]
    texts += ["".join(rnd.choices("ab é\n日😀thanwe▁<>", k=rnd.randint(0, 80))) for _ in range(500)]
    counter, tokenizer = UnigramCounter(vocabulary, cache_words=100), library(vocabulary)
    for t in texts:
        assert counter.count(t) == len(tokenizer.encode(t, add_special_tokens=False).ids), t


@pytest.mark.parametrize("byte_fallback", [False, True])
def test_ties(byte_fallback):
    rnd = random.Random(8)
    for _ in range(150):
        pieces = {"<unk>": 0.0}
        for _ in range(12):
            pieces["".join(rnd.choices("abc▁", k=rnd.randint(1, 3)))] = -float(rnd.randint(1, 4))
        vocabulary = UnigramVocabulary(list(pieces.items()), byte_fallback)
        counter, tokenizer = UnigramCounter(vocabulary), library(vocabulary)
        for _ in range(20):
            t = "".join(rnd.choices("abc dé", k=rnd.randint(0, 14)))
            assert counter.count(t) == len(tokenizer.encode(t, add_special_tokens=False).ids), (pieces, t)


def test_operator(spark, vocabulary):
    rows = [(1, "some text", 1), (1, "some text", 2), (None, None, 3), (4, "", 4), (5, "lorem " * 50_000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    tokenizer = library(vocabulary)
    got = sorted((tuple(r) for r in token_counts(docs, vocabulary).collect()), key=repr)
    assert got == sorted(((i, len(tokenizer.encode(t or "").ids)) for i, t, _ in rows), key=repr)
    assert token_counts(docs.limit(0), vocabulary).collect() == []
