"""Token counts: a Viterbi pass that carries scores and piece counts only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.arrow import Step, map_texts
from tallyframe.llm.common import text_of

#: what stands for a space and begins every word
MARK = "▁"
#: how far an unknown character scores below the worst piece; fixed value
UNKNOWN_PENALTY = 10.0
#: words whose counts a task remembers
CACHE_WORDS = 400_000


@dataclass(frozen=True)
class UnigramVocabulary:
    """Pieces with scores, in the order of their ids."""

    pieces: Sequence[tuple[str, float]]
    byte_fallback: bool = True


def vocabulary_of(path: str) -> UnigramVocabulary:
    """The pieces and scores of a sentencepiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return UnigramVocabulary([(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())])


class UnigramCounter:
    """Counts the pieces of the best segmentation, word by word.

    An Aho-Corasick automaton gives all pieces that end at a place, longest first, so candidates come in order of
    where they start. As in the tokenizer, the first of equal scores stays, a character that is no piece by itself
    can be unknown, and unknown characters in a row become bytes, or one piece where there are no byte pieces.
    """

    def __init__(self, vocabulary: UnigramVocabulary, cache_words: int = CACHE_WORDS) -> None:
        import ahocorasick

        pieces = [p for p in vocabulary.pieces if p[0]]
        self._automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self._automaton.add_word(piece, (len(piece), float(score)))
        self._automaton.make_automaton()
        self._unknown = min((float(s) for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        names = {p for p, _ in pieces}
        self._bytes = {b for b in range(256) if f"<0x{b:02X}>" in names} if vocabulary.byte_fallback else set()
        self._cache: dict[str, int] = {}
        self._cache_words = cache_words

    def _count_word(self, word: str) -> int:
        n = len(word)
        best, pieces = [0.0] * (n + 1), [0] * (n + 1)
        # unknown characters in a row up to here, as bytes without a piece, and their pieces if so
        run: list[str] = [""] * (n + 1)
        matches = self._automaton.iter(word)
        at, found = next(matches, (n, None))
        for end in range(1, n + 1):
            top = None
            single = False
            while at == end - 1:
                length, score = found
                single = single or length == 1
                candidate = best[end - length] + score
                if top is None or candidate > top:
                    top, start = candidate, end - length
                at, found = next(matches, (n, None))
            unknown = False
            if not single:
                candidate = best[end - 1] + self._unknown
                if top is None or candidate > top:
                    top, start, unknown = candidate, end - 1, True
            best[end] = top
            if unknown:
                run[end] = run[end - 1] + word[end - 1]
                pieces[end] = pieces[end - len(run[end])] + self._unknown_pieces(run[end])
            else:
                pieces[end] = pieces[start] + 1
        return pieces[n]

    def _unknown_pieces(self, text: str) -> int:
        data = text.encode("utf-8")
        return len(data) if self._bytes and self._bytes.issuperset(data) else 1

    def count(self, text: str) -> int:
        """Pieces of a text: spaces are marks, one is put before the text, and every mark begins a word."""
        if not text:
            return 0
        parts = text.replace(" ", MARK).split(MARK)
        if text[0] in (" ", MARK):
            parts = parts[1:]
        known, total = self._cache, 0
        for part in parts:
            n = known.get(part)
            if n is None:
                if len(known) >= self._cache_words:
                    known.clear()
                n = known[part] = self._count_word(MARK + part)
            total += n
        return total


def _counted(vocabulary, cache_words: int) -> Step:
    counter = UnigramCounter(vocabulary.value, cache_words)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = [counter.count(t or "") for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64())], ["doc_id", "n_tokens"])

    return step


def token_counts(
    docs: DataFrame,
    vocabulary: UnigramVocabulary,
    id_col: str = "doc_id",
    text_col: str = "text",
    cache_words: int = CACHE_WORDS,
) -> DataFrame:
    """Number of unigram tokens of every whole text, without making the tokens.

    Pieces never reach over a word's beginning, so words are counted by themselves, and a task remembers the
    counts of up to ``cache_words`` words. The vocabulary is broadcast; nothing is shuffled.

    Null and empty texts have no tokens. Null ids and repeated rows pass through. An empty table gives no rows.
    Other columns are not read, whatever their names.

    Columns: doc_id, n_tokens.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, n_tokens long"
    return map_texts(texts, lambda: _counted(sent, cache_words), schema)
