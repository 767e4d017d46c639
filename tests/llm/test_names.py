"""Extra columns with the names that operators use inside come through with their values."""

import pytest

from tallyframe.llm.bpe import encode_documents
from tallyframe.llm.exact_dedup import drop_exact_duplicates
from tallyframe.llm.importance import take_resampled
from tallyframe.llm.quality import keep_good

NAMES = [
    "row", "id", "text_hash", "kept", "digest", "n_norm", "proof", "run", "best", "n", "keep_id", "group_size", "score",
    "label", "features", "rank", "task", "place", "able", "copies", "times", "unnamed", "ids", "n_tokens", "decoded",
    "_right_id", "_right_text_hash", "_right_doc_id", "_llm_text_hash", "_llm_row", "_rows", "_copies", "_mix_id",
]


@pytest.fixture(scope="module")
def rows():
    good, bad = "good plain words of a text ", "### %%% | ### $$$ | "
    texts = [(good if i % 2 else bad) * (9 + i % 3) for i in range(40)] + [None, "", " "]
    made = [(i, t, *[f"{n}{i}" for n in NAMES], i) for i, t in enumerate(texts)]
    return [*made, made[0], made[0], (None, *made[1][1:])]


@pytest.fixture(scope="module")
def docs(spark, rows):
    schema = "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in NAMES) + ", `a.b``c` int"
    return spark.createDataFrame(rows, schema).repartition(3)


def check(got, docs, rows):
    assert got.columns == docs.columns and got.schema["doc_id"].dataType == docs.schema["doc_id"].dataType
    found = [tuple(r) for r in got.collect()]
    assert found and all(r in set(rows) for r in found)
    return found


def test_exact_duplicates(docs, rows):
    found = check(drop_exact_duplicates(docs), docs, rows)
    bare = [(r[1] or "").replace(" ", "") for r in found]
    assert len(bare) == len(set(bare)) == len({(r[1] or "").replace(" ", "") for r in rows})


def test_quality(spark, docs, rows):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    found = check(keep_good(docs, labels), docs, rows)
    assert {r[0] for r in found if r[1] and r[1].strip() and r[0] is not None} == set(range(1, 40, 2))


def test_resampling(spark, docs, rows):
    target = spark.createDataFrame([("good plain words",)], "text string")
    found = check(take_resampled(docs, target, percent=30), docs, rows)
    assert all("good" in r[1] for r in found)


def test_encoding(docs, rows):
    encoded = encode_documents(docs, "/opt/tokenizers/byte_bpe_50k.json")
    assert encoded.count() == len(rows)
