"""Language of a text: multinomial logistic regression on TF-IDF of character n-grams."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.arrow import in_steps, map_texts
from tallyframe.llm.common import text_of
from tallyframe.llm.words import mix

#: most documents that a model is fitted on, dealt evenly to the languages as far as they have so many
LEARNT = 2400
#: n-grams fall in 2**BITS features
BITS = 16
#: least and most code points of an n-gram
SIZES = (1, 3)
EPOCHS, SEED = 3, 11
#: learning rate and its damping, and the elastic net's two penalties
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.5
#: every so many-th learnt document is for the temperature alone
CALIBRATED = 5
#: text bytes that a step sees at once; a longer single text comes alone
STEP = 1 << 19
UNKNOWN = "und"


def held_out(id_col: str | Column) -> Column:
    """Rows that no model learns from: crc32 of the id as text leaves 1 when divided by 3."""
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(column.cast("string")) % 3 == 1, F.lit(False))


def _code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of all texts with one space (32) before every word and one at the end, and whose they are.

    A word is a run of letters; a space belongs to the text of the word after it.
    """
    joined = " " + " ".join(texts).lower() + " "
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(texts) and len(points) == sum(map(len, texts)) + len(texts) + 1:
        lengths = [len(t) for t in texts]
    else:  # some letters are two in lower case
        lengths = [len(t.lower()) for t in texts]
        joined = " " + " ".join(t.lower() for t in texts) + " "
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    of = np.repeat(np.arange(len(texts) + 1), [*(n + 1 for n in lengths), len(points) - sum(lengths) - len(lengths)])
    high = int(points.max())
    present = np.flatnonzero(np.bincount(points, minlength=high + 1)) if high < 1 << 17 else np.unique(points)
    letters = np.zeros(high + 1, bool)
    letters[[p for p in present.tolist() if chr(p).isalpha()]] = True
    letter = letters[points]
    # of the characters between two words the last is left
    kept = letter.copy()
    kept[:-1] |= letter[1:]
    kept[-1] = True
    points = np.where(letter, points, 32)[kept]
    return points.astype(np.uint64), of[kept]


def ngram_counts(texts: list[str], sizes: tuple[int, int] = SIZES, bits: int = BITS):
    """Hashed character n-grams of each text as a sparse table: row, feature and count of its cells, by row and feature.

    N-grams lie within a word and the space at each of its ends; a space alone is none.
    """
    if not texts:
        none = np.empty(0, np.int64)
        return none, none, none
    points, of = _code_points(texts)
    space = points == 32
    cells, value = [], np.full(len(points), 0x51, np.uint64)
    blocked = np.zeros(len(points), bool)
    for n in range(1, sizes[1] + 1):
        last = np.roll(points, 1 - n)
        if n > 2:
            blocked |= np.roll(space, 2 - n)  # a space inside
        value = value * np.uint64(0x100000001B3) + last
        if n < sizes[0]:
            continue
        good = ~blocked
        good[len(points) - n + 1 :] = False
        if n == 1:
            good &= ~space
        elif n == 2:
            good &= ~(space & np.roll(space, -1))
        hashed = mix(value[good] + np.uint64(n)) >> np.uint64(64 - bits)
        cells.append((of[good].astype(np.int64) << bits) | hashed.astype(np.int64))
    every = np.sort(np.concatenate(cells))
    first = np.ones(len(every), bool)
    first[1:] = every[1:] != every[:-1]
    at = np.flatnonzero(first)
    distinct = every[at]
    return distinct >> bits, distinct & ((1 << bits) - 1), np.diff(np.append(at, len(every)))


def tf_idf(counts, idf: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of unit length: (1 + log count) * idf. Gives where each row begins, the features and the values."""
    row, feature, count = counts
    value = (1 + np.log(count)) * idf[feature]
    norm = np.sqrt(np.bincount(row, value * value, n))
    return np.searchsorted(row, np.arange(n + 1)), feature, value / norm[row] if len(row) else value


@dataclass
class LanguageModel:
    """Languages in order of their names, and what tells them: idf, sparse weights, biases and the temperature."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    sizes: tuple[int, int] = SIZES
    bits: int = BITS

    def logits(self, rows) -> np.ndarray:
        begins, feature, value = rows
        out = np.empty((len(begins) - 1, len(self.languages)))
        for c in range(len(self.languages)):
            sums = np.concatenate(([0.0], np.cumsum(value * self.weights[c][feature])))
            out[:, c] = sums[begins[1:]] - sums[begins[:-1]] + self.bias[c]
        return out

    def probabilities(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Calibrated probabilities of all languages for each text, and which texts have letters."""
        counts = ngram_counts(texts, self.sizes, self.bits)
        rows = tf_idf(counts, self.idf, len(texts))
        return _softmax(self.logits(rows) / self.temperature), np.diff(rows[0]) > 0


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(
    rows, labels: np.ndarray, classes: int, features: int, epochs: int = EPOCHS, alpha: float = ALPHA,
    beta: float = BETA, l1: float = L1, l2: float = L2, seed: int = SEED,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights (classes by features) and biases of a softmax regression by follow-the-regularised-leader.

    Every weight is the minimiser of the gradients so far, of a proximal term and of the elastic net: ``l1`` keeps it at
    zero until its gradients add up to more, ``l2`` shrinks it. Biases are not penalised.
    """
    begins, feature, value = rows
    z, squares = np.zeros((features, classes)), np.zeros((features, classes))
    bias, bias_squares = np.zeros(classes), np.zeros(classes)

    def leader(z: np.ndarray, squares: np.ndarray) -> np.ndarray:
        beyond = np.sign(z) * np.maximum(np.abs(z) - l1, 0)
        return -beyond / ((beta + np.sqrt(squares)) / alpha + l2)

    random = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in random.permutation(len(labels)):
            at, x = feature[begins[i] : begins[i + 1]], value[begins[i] : begins[i + 1], None]
            own_z, own_squares = z[at], squares[at]
            w = leader(own_z, own_squares)
            off = _softmax((x * w).sum(axis=0) + bias)
            off[labels[i]] -= 1
            g = x * off
            more = own_squares + g * g
            z[at] = own_z + g - (np.sqrt(more) - np.sqrt(own_squares)) / alpha * w
            squares[at] = more
            bias_squares += off * off
            bias -= alpha / (beta + np.sqrt(bias_squares)) * off
    return leader(z, squares).T.copy(), bias


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """What logits are best divided by: least log loss between a 20th and 20, by narrowing the range to its better part.

    Labels count as right but for one in n + 2, so that n texts that are all told right do not make a model certain.
    """
    n, classes = logits.shape
    doubt = 1 / (n + 2)

    def loss(log_t: float) -> float:
        p = np.log(np.maximum(_softmax(logits / np.exp(log_t)), 1e-30))
        right = p[np.arange(n), labels]
        return -((1 - doubt) * right + doubt * (p.sum(axis=1) - right) / max(1, classes - 1)).mean()

    low, high = -np.log(20), np.log(20)
    for _ in range(60):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def document_counts(texts: DataFrame, sizes: tuple[int, int] = SIZES, bits: int = BITS) -> tuple[np.ndarray, int]:
    """In how many texts of a column each feature is, and how many texts there are.

    Each task adds up its own, so it gives at most one row per feature, and the driver gets one per feature.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        total, texts_seen = np.zeros(1 << bits, np.int64), 0
        for batch in batches:
            for part in in_steps(batch, "text", STEP, 4096):
                _, feature, _ = ngram_counts(part.column("text").to_pylist(), sizes, bits)
                total += np.bincount(feature, minlength=1 << bits)
                texts_seen += len(part)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(seen, -1)), pa.array(np.append(total[seen], texts_seen))], ["feature", "n"]
        )

    found = texts.mapInArrow(run, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    feature, n = found.column("feature").to_numpy(), found.column("n").to_numpy()
    out = np.zeros(1 << bits, np.int64)
    out[feature[feature >= 0]] = n[feature >= 0]
    return out, int(n[feature < 0].sum())


def _counted(sizes: tuple[int, int], bits: int) -> Callable:
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        row, feature, count = ngram_counts(batch.column("text").to_pylist(), sizes, bits)
        begins = np.searchsorted(row, np.arange(len(batch) + 1))
        cut = lambda x, t: [x[a:b].astype(t).tobytes() for a, b in zip(begins, begins[1:])]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("label"), batch.column("place"),
                pa.array(cut(feature, np.int32), pa.binary()), pa.array(cut(count, np.int32), pa.binary()),
            ],
            ["label", "place", "features", "counts"],
        )

    return lambda: step


def fit_languages(
    docs: DataFrame,
    lang_col: str = "lang",
    most: int = LEARNT,
    sizes: tuple[int, int] = SIZES,
    bits: int = BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> LanguageModel:
    """Learn from the documents that are not held out and have a language.

    How many documents have a feature is counted over all of these. The regression is fitted on ``most`` of them at
    most: for each of the L languages the floor(most / L), one at least, of the smallest hashes of id and text that have
    letters. Every fifth of the sample, by hash, is only for the temperature. So the driver holds ``most`` sparse rows and
    2**bits weights per language, whatever the number of documents; the languages must be few enough for that.
    """
    known = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("label"), text_of(text_col).alias("text"))
    known = known.filter(F.col("label").isNotNull() & ~held_out("doc_id"))
    names = [r.label for r in known.select("label").distinct().orderBy("label").collect()]
    if not names:
        return LanguageModel([], np.ones(1 << bits), np.zeros((0, 1 << bits)), np.zeros(0), 1.0, sizes, bits)
    have, texts = document_counts(known.select("text"), sizes, bits)
    idf = np.log((1 + texts) / (1 + have)) + 1

    each = max(1, most // len(names))
    lettered = known.filter(F.col("text").rlike(r"\p{L}"))
    counts = {r.label: r.n for r in lettered.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    # about twice the wanted rows of each language pass by their hash, then those of the smallest ranks
    place = F.xxhash64("doc_id", "text", F.lit(SEED))
    odds = F.lit(0.0)
    for name, n in counts.items():
        odds = F.when(F.col("label") == name, min(1.0, (2 * each + 20) / n)).otherwise(odds)
    below = F.shiftrightunsigned("place", 11).cast("double") / float(1 << 53) < odds
    drawn = lettered.withColumn("place", place).filter(below)
    sampled = map_texts(
        drawn, _counted(sizes, bits), "label string, place long, features binary, counts binary", step_bytes=STEP
    )
    rank = "row_number() OVER (PARTITION BY label ORDER BY shiftrightunsigned(place, 11), place, features, counts)"
    table = sampled.withColumn("rank", F.expr(rank)).filter(F.col("rank") <= each)
    table = table.orderBy("label", "rank").drop("rank").toArrow()
    labels = np.searchsorted(names, table.column("label").to_pylist())
    features = [np.frombuffer(x, np.int32) for x in table.column("features").to_pylist()]
    amounts = [np.frombuffer(x, np.int32) for x in table.column("counts").to_pylist()]
    held = table.column("place").to_numpy() % CALIBRATED == 0
    del table

    def rows(chosen: np.ndarray):
        sizes_of = [len(features[i]) for i in chosen]
        joined = lambda x: np.concatenate([x[i] for i in chosen] or [np.empty(0, np.int32)])
        return tf_idf((np.repeat(np.arange(len(chosen)), sizes_of), joined(features), joined(amounts)), idf, len(chosen))

    learnt, checked = np.flatnonzero(~held), np.flatnonzero(held)
    if not len(learnt):
        learnt = checked
    weights, bias = ftrl(rows(learnt), labels[learnt], len(names), 1 << bits)
    model = LanguageModel(names, idf.astype(np.float32), weights.astype(np.float32), bias, 1.0, sizes, bits)
    if len(checked):
        model.temperature = temperature(model.logits(rows(checked)), labels[checked])
    return model


def _predicted(m: LanguageModel) -> Callable:
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, known = len(batch), m.languages
        if known and n:
            odds, lettered = m.probabilities([t or "" for t in batch.column("text").to_pylist()])
            best = odds.argmax(axis=1)
            names = [known[b] if some else UNKNOWN for b, some in zip(best, lettered)]
            scores = np.where(lettered, odds[np.arange(n), best], 0.0)
        else:
            names, scores = [UNKNOWN] * n, np.zeros(n)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
            ["doc_id", "lang_pred", "score"],
        )

    return step


def predict_languages(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The language of every whole text and its calibrated probability.

    The model, of bounded size, is broadcast; texts are scored where they are, and nothing is shuffled. Texts that are
    null or have no letter get ``und`` and score 0, and so does every text where no language is known. Null ids and
    repeated rows pass through. An empty table gives no rows. Other columns are not read, whatever their names.

    Columns: doc_id, lang_pred, score.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    # plain values: a broadcast, unlike a task, does not bring the code of its classes
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))
    schema = f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double"
    return map_texts(texts, lambda: _predicted(LanguageModel(**sent.value)), schema, step_bytes=STEP)
