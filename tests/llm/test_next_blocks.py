"""Blocks of ids stay small however the ids lie."""

from pyspark.sql import functions as F

from tallyframe.llm import fingerprint as fp


def test_outlying_and_null_ids(spark, monkeypatch):
    monkeypatch.setattr(fp, "BLOCK_ROWS", 50)
    ids = [*range(2000), 2**62, -(2**62), *[None] * 1000]
    rows = [(x, f"text {i}") for i, x in enumerate(ids)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    # the most rows that one window task sorts
    seen, real = [], fp.Window.partitionBy
    monkeypatch.setattr(fp.Window, "partitionBy", staticmethod(lambda *c: (seen.append(c), real(*c))[1]))
    led = fp.with_next(docs)
    assert seen == [("block",)]
    got = led.collect()
    blocks = fp._in_blocks(docs).groupBy(F.col("block") < 0, "block").count().collect()
    assert max(r["count"] for r in blocks) <= 200 and sum(r["count"] for r in blocks) == len(rows)
    hashes = dict(docs.select("text", F.xxhash64("text")).collect())
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashes[r[1]]))
    assert {r.text: r.next_text for r in got} == {t: order[(i + 1) % len(order)][1] for i, (_, t) in enumerate(order)}
