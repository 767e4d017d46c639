"""Quality classifier: votes of the nearest labelled documents in a latent-semantic space."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.arrow import Step, buffers, map_texts
from tallyframe.llm.common import checkpointed, keep_packed, packed, text_of
from tallyframe.llm.words import words

#: most labelled documents that a model is fitted on and broadcast with
LABELLED = 3000
LATENT = 32
NEIGHBOURS = 15
#: power of the cosine that a neighbour's vote weighs
SHARPNESS = 32
#: documents whose products with all labelled vectors are held at once
BLOCK_ROWS = 512
#: tasks that the labelled rows of a fit are added up in, and rounds of the decomposition
FIT_TASKS, ROUNDS = 8, 5
SEED = 7
_PIECE = 1 << 20


def _byte_classes() -> np.ndarray:
    """Letters by themselves, capitals, digits and control characters together, the upper half by low bits."""
    classes = np.zeros(256, np.int64)
    named = [b for b in range(0x20, 0x7F) if not (0x30 <= b < 0x3A or 0x41 <= b < 0x5B)] + [0x0A]
    classes[named] = np.arange(len(named)) + 3
    classes[0x30:0x3A], classes[0x41:0x5B] = 1, 2
    classes[0x80:] = len(named) + 3 + np.arange(128) % 16
    return classes


_CLASSES = _byte_classes()
_N = int(_CLASSES.max()) + 1
#: pairs of neighbouring byte classes, then how words repeat: like the one before, like the one before that, neither
FEATURES = _N * _N + 3


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row per text: square roots of the shares of byte pairs and, as a second part, of word repetitions."""
    n = len(offsets) - 1
    out = np.zeros((n, FEATURES), np.float32)
    ends = np.repeat(offsets[1:], np.diff(offsets)) if len(data) <= _PIECE else None
    for at in range(0, max(len(data) - 1, 0), _PIECE):
        piece = data[at : at + _PIECE + 1]
        places = np.arange(at, at + len(piece) - 1)
        of = np.searchsorted(offsets, places, "right") - 1
        inside = places + 1 < (ends[places] if ends is not None else offsets[of + 1])
        classes = _CLASSES[piece]
        low, high = int(of[0]), int(of[-1]) + 1
        cells = ((of - low) * FEATURES + classes[:-1] * _N + classes[1:])[inside]
        out[low:high] += np.bincount(cells, minlength=(high - low) * FEATURES).reshape(-1, FEATURES)
    pairs = out[:, : _N * _N]
    pairs /= np.maximum(pairs.sum(axis=1, keepdims=True), 1)
    hashes, counts = words(data, offsets)
    of = np.repeat(np.arange(n), counts)
    once = np.zeros(len(hashes), bool)
    once[1:] = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])
    twice = np.zeros(len(hashes), bool)
    twice[2:] = (hashes[2:] == hashes[:-2]) & (of[2:] == of[:-2]) & ~once[2:]
    total = np.maximum(counts, 1)
    out[:, -3] = np.bincount(of[once], minlength=n) / total
    out[:, -2] = np.bincount(of[twice], minlength=n) / total
    out[:, -1] = np.where(counts > 0, 1 - out[:, -3] - out[:, -2], 0)
    return np.sqrt(np.maximum(out, 0))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


@dataclass
class NeighbourModel:
    """Weights and basis of the latent space, and the labelled vectors in it."""

    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def latent(self, rows: np.ndarray) -> np.ndarray:
        return _unit((rows * self.idf) @ self.basis)

    def scores(self, rows: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        """The labels of the nearest vectors, weighted by a power of their cosine; the share of label 1 where nothing is near."""
        if not len(self.labels):
            return np.full(len(rows), 0.5)
        cosines = self.latent(rows) @ self.vectors.T
        k = min(neighbours, len(self.labels))
        nearest = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weights = np.maximum(np.take_along_axis(cosines, nearest, axis=1), 0).astype(np.float64) ** SHARPNESS
        total = weights.sum(axis=1)
        votes = (weights * self.labels[nearest]).sum(axis=1) / np.where(total > 0, total, 1)
        return np.where(total > 0, np.clip(votes, 0, 1), self.labels.mean())


def held_out(id_col: str | Column) -> Column:
    """Rows whose labels no model sees: crc32 of the id as text divides by 5."""
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(column.cast("string")) % 5 == 0, F.lit(False))


def _featured() -> Step:
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = features(*buffers(batch.column("text"))).astype(np.float16)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), pa.array([r.tobytes() for r in rows], pa.binary())],
            ["doc_id", "label", "features"],
        )

    return step


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for at in range(0, len(batch), BLOCK_ROWS):
            raw = b"".join(batch.column("features").slice(at, BLOCK_ROWS).to_pylist())
            yield np.frombuffer(raw, np.float16).reshape(-1, FEATURES).astype(np.float32)


def _summed(rows: DataFrame, part: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
    """The sum of ``part`` over all blocks of feature rows, added up in the tasks first; one array per task arrives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, np.float32)
        for block in _blocks(batches):
            total += part(block)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])

    out = np.zeros(shape)
    for total in rows.select("features").mapInArrow(run, "total binary").toArrow().column("total"):
        out += np.frombuffer(total.as_py(), np.float32).reshape(shape)
    return out


def _projected(rows: DataFrame, weights: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All weighted feature rows times ``span``, in order of their ids, and their labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = [(block * weights) @ span for block in _blocks(iter([batch]))]
            raw = [r.astype(np.float32).tobytes() for block in places for r in block]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(raw, pa.binary())], ["doc_id", "label", "place"]
            )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"doc_id {id_type}, label int, place binary").orderBy("doc_id").toArrow()
    matrix = np.frombuffer(b"".join(found.column("place").to_pylist()), np.float32).reshape(-1, span.shape[1])
    return matrix, np.array(found.column("label").to_pylist(), np.float64)


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    most: int = LABELLED,
    id_col: str = "doc_id",
    text_col: str = "text",
    latent: int = LATENT,
) -> NeighbourModel:
    """Fit on at most ``most`` labelled documents, those of the smallest hashed ids that are not held out.

    Latent semantic analysis: idf weights, then a truncated singular value decomposition of the weighted rows A. The
    rows are stored once and stay with the tasks, which give A'(A x) for a few vectors x at a time (subspace
    iteration); the driver sees as many columns as the space has, and some more.

    Null labels and ids teach nothing; of several labels for one id the smallest counts.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    known = known.filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    known = known.groupBy("doc_id").agg(F.min("label").alias("label")).join(texts, "doc_id", "left_semi")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    schema = f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, label int, features binary"
    rows = checkpointed(map_texts(rows, _featured, schema, step_rows=BLOCK_ROWS)).coalesce(FIT_TASKS)

    ones = np.ones((FEATURES, 1), np.float32)
    n = rows.count()
    if not n:
        return NeighbourModel(ones[:, 0], 0 * ones, np.zeros((0, 1), np.float32), np.zeros(0))
    have = _summed(rows, lambda block: (block > 0).sum(axis=0), (FEATURES,))
    weights = (np.log((1 + n) / (1 + have)) + 1).astype(np.float32)
    size = min(latent + 16, n, FEATURES)
    span = np.random.default_rng(SEED).standard_normal((FEATURES, size)).astype(np.float32)
    for _ in range(ROUNDS):

        def product(block: np.ndarray, span: np.ndarray = span) -> np.ndarray:
            block *= weights
            return block.T @ (block @ span)

        span = np.linalg.qr(_summed(rows, product, span.shape))[0].astype(np.float32)
    places, known_labels = _projected(rows, weights, span)
    right = np.linalg.svd(places.astype(np.float64), full_matrices=False)[2].T[:, :latent].astype(np.float32)
    return NeighbourModel(weights, span @ right, _unit(places @ right), known_labels)


def _scored(model: NeighbourModel) -> Step:
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = model.scores(features(*buffers(batch.column("text"))))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return step


def score_quality(docs: DataFrame, model: NeighbourModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score every whole text: 1 where its nearest labelled documents are good, 0 where they are bad.

    Texts become shares of neighbouring byte classes and of repeated words, are weighted by idf and projected to the
    latent space of the fit. The labelled vectors, of bounded number, are broadcast; a block of documents is
    multiplied with all of them, so that the nearest are exact. Nothing is shuffled.

    Empty and null texts are near nothing and score the share of label 1; without labels every score is 0.5. Null ids and
    repeated rows pass through. An empty table gives no rows. Other columns are not read, whatever their names.

    Columns: doc_id, score.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    # plain values: a broadcast, unlike a task, does not bring the code of its classes
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))
    schema = f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, score double"
    return map_texts(texts, lambda: _scored(NeighbourModel(**sent.value)), schema, step_rows=BLOCK_ROWS)


def keep_good(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, with all their columns.

    Rows that repeat an id are kept or dropped by their own text.
    """
    model = fit_quality(docs, labels, id_col=id_col, text_col=text_col)
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("text_hash"))
    keyed = docs.select(key.alias("doc_id"), F.col(text_col).alias("text"))
    good = score_quality(keyed, model).filter(F.col("score") >= threshold)
    return keep_packed(packed(docs, id_col, text_col), good.select("doc_id.*"))
