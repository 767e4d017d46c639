"""What a Python worker and a batch for it take in memory."""

from __future__ import annotations

import resource
from pathlib import Path

import pyarrow as pa

from tallyframe.llm.arrow import HANDED_BYTES, map_texts, task_of

_KEPT = []


def _resident() -> int:
    return int(Path("/proc/self/statm").read_text().split()[1]) * resource.getpagesize()


def test_a_task_gives_its_memory_back_when_it_ends():
    def setup():
        held = []

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            held.extend(b"x" * (50_000 + i) for i in range(4000))  # too small for mappings of their own
            _KEPT.append(b"y" * 60_000)  # what is allocated last and stays keeps the heap from shrinking by itself
            return batch

        return step

    before = _resident()
    batch = pa.RecordBatch.from_pydict({"text": ["a", "b"]})
    assert len(list(task_of(setup, "text", 1 << 20, 100)(iter([batch])))) == 1
    assert _resident() - before < 50 << 20


def test_batches_for_python_are_of_bounded_bytes(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(name)
    try:
        texts = spark.range(4000, numPartitions=1).selectExpr("repeat('word ', 800) AS text")
        step = lambda batch: pa.RecordBatch.from_pydict({"n": [batch.nbytes]})
        sizes = [r.n for r in map_texts(texts, lambda: step, "n long", step_bytes=1 << 30).collect()]
        assert sum(sizes) > 3 * HANDED_BYTES and max(sizes) < 1.1 * HANDED_BYTES
    finally:
        spark.conf.unset(name)
