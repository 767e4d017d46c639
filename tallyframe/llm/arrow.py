"""Python work on Arrow batches of bounded size."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: text bytes that a step sees at once; a longer single text comes alone
STEP_BYTES = 4 << 20
STEP_ROWS = 4096

#: bytes of rows that Spark hands to Python at once, where a session has Spark's default: it holds them several times
HANDED_BYTES = 4 << 20
_HANDED, _HANDED_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"

Step = Callable[[pa.RecordBatch], pa.RecordBatch]


def give_back_memory() -> None:
    """Give freed memory back to the system, at the end of a task.

    Python workers live on for later tasks and idle beside the JVM in between. Arrow and the C library keep what
    was freed, so that a worker would stay as large as its largest task was.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc alone
    if trim:
        trim(0)


def text_bytes(column: pa.Array) -> list[bytes]:
    """The texts in UTF-8, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def in_steps(batch: pa.RecordBatch, text_col: str, step_bytes: int, step_rows: int) -> Iterator[pa.RecordBatch]:
    sizes = pa.compute.binary_length(batch.column(text_col)).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if i - start >= step_rows or held and held + (size or 0) > step_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size or 0
    if start < len(sizes):
        yield batch.slice(start)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each begins and ends in them."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


def map_texts(
    df: DataFrame,
    setup: Callable[[], Step],
    schema: str,
    text_col: str = "text",
    step_bytes: int = STEP_BYTES,
    step_rows: int = STEP_ROWS,
) -> DataFrame:
    """``setup()`` once per task gives the step for batches of about ``step_bytes`` of text and few enough rows."""
    if df.sparkSession.conf.get(_HANDED) == _HANDED_DEFAULT:
        df.sparkSession.conf.set(_HANDED, str(HANDED_BYTES))
    return df.mapInArrow(task_of(setup, text_col, step_bytes, step_rows), schema)


def task_of(
    setup: Callable[[], Step], text_col: str, step_bytes: int, step_rows: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        step, batch, part = setup(), None, None
        try:
            for batch in batches:
                for part in in_steps(batch, text_col, step_bytes, step_rows):
                    yield step(part)
        finally:
            del step, batch, part
            give_back_memory()

    return run
