"""Chunked encoding against the tokenizer itself."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyframe.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def texts():
    rnd = random.Random(4)
    soup = ["the", " and", "é", "日本", "  ", "\n", "\t", "'ll", "123", "<|endoftext|>", "<|endof", ".", " ", " ", "a", " "]
    return [
        "", "a", " ", "  a", "x" * 9000, " " * 30_000, "<|endoftext|>" * 300, "a <|endoftext|> b" * 300, "日本語" * 2000,
        "word " * 3000, "\n\n \t" * 3000,
        *["".join(rnd.choices(soup, k=rnd.randint(0, 6000))) for _ in range(12)],
        *[" ".join("".join(rnd.choices("abcdeé", k=rnd.randint(1, 9))) for _ in range(2000)) for _ in range(5)],
    ]


@pytest.mark.parametrize("ranks", [True, False])
def test_ids_and_text(tokenizer, ranks, monkeypatch):
    if not ranks:
        monkeypatch.setattr(bpe, "rank_encoding", lambda *_: None)
    monkeypatch.setattr(bpe, "MIN_CHUNK", 32)
    monkeypatch.setattr(bpe, "CUT_BITS", 6)
    encoder = bpe.ChunkEncoder(PATH, cache_chunks=50)
    for text, ids in zip(texts(), encoder.encode([t.encode() for t in texts()]), strict=True):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids
        assert encoder.decode(ids) == tokenizer.decode(ids.tolist(), skip_special_tokens=False)


def test_chunks_are_the_same_in_copies():
    rnd = random.Random(1)
    passage = bytes(rnd.choices(b"abcdefgh ", k=40_000))
    a, b = b"head " * 100 + passage, b"another beginning " * 37 + passage
    cuts = [bpe.cut_points(np.frombuffer(t, np.uint8), np.array([0])) for t in (a, b)]
    ends = [set(np.array(bpe.chunk_ends(t, c.tolist())) - len(t)) for t, c in zip((a, b), cuts, strict=True)]
    assert len(ends[0] & ends[1]) > 0.8 * len(ends[0])


def test_operator(spark, tokenizer):
    rows = [(1, "some text", 1), (1, "some text", 2), (None, None, 3), (4, "", 4), (5, "É <|endoftext|>" * 900, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = bpe.encode_documents(docs, PATH).collect()
    found = sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist(), r.decoded) for r in got), key=repr)
    wanted = [(i, tokenizer.encode(t or "", add_special_tokens=False).ids, t or "") for i, t, _ in rows]
    assert found == sorted(wanted, key=repr)
    assert bpe.encode_documents(docs.limit(0), PATH).collect() == []
