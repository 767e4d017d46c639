"""BPE encoding and decoding: content-defined chunks are encoded once, and their joins are repaired."""

from __future__ import annotations

import json
import os
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.arrow import Step, map_texts, text_bytes
from tallyframe.llm.common import text_of

#: a chunk ends where the hash of the last 16 bytes has its upper CUT_BITS bits 0, about every 2 KB
CUT_BITS = 11
MIN_CHUNK = 512
#: encoded chunks that a task remembers
CACHE_CHUNKS = 8192


def cut_points(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where chunks may end in the texts that begin at ``starts`` of the buffer: a hash of the 16 bytes before.

    The polynomial hash of a window of 2n bytes is put together from those of its halves of n bytes.
    """
    if len(data) < 16:
        return np.empty(0, np.int64)
    h = np.random.default_rng(16).integers(0, 1 << 32, 256, dtype=np.uint32)[data]
    factor = 0x9E3779B1
    for half in (1, 2, 4, 8):
        h = h[:-half] * np.uint32(factor) + h[half:]
        factor = factor * factor % (1 << 32)
    cuts = np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + 16
    # a window that begins before its text is not one of that text
    at = np.searchsorted(starts, cuts, "right") - 1
    return cuts[cuts - starts[at] >= 16]


def chunk_ends(data: bytes, cuts: list[int]) -> list[int]:
    """Ends of the chunks of one text: cuts that leave at least MIN_CHUNK bytes, moved to the next character."""
    ends, last = [], 0
    for cut in cuts:
        if cut - last < MIN_CHUNK:
            continue
        while cut < len(data) and data[cut] & 0xC0 == 0x80:
            cut += 1
        if cut < len(data):
            ends.append(cut)
            last = cut
    return [*ends, len(data)]


def _is_anchor(data: bytes, i: int) -> bool:
    return 0 < i < len(data) - 1 and 0x20 < data[i - 1] < 0x7F and 0x20 < data[i + 1] < 0x7F


def anchor_before(data: bytes, at: int) -> int:
    """The last single space between printable ASCII characters at or before ``at``, else the start.

    The pattern that splits text before merges always ends a word there, so tokens never reach across.
    """
    i = data.rfind(b" ", 0, at + 1)
    while i > 0 and not _is_anchor(data, i):
        i = data.rfind(b" ", 0, i)
    return max(i, 0)


def anchor_after(data: bytes, at: int) -> int:
    """The first such space after ``at``, else the end."""
    i = data.find(b" ", at + 1)
    while i >= 0 and not _is_anchor(data, i):
        i = data.find(b" ", i + 1)
    return i if i >= 0 else len(data)


def token_bytes(tokenizer) -> list[bytes]:
    """The bytes of every id of a byte-level vocabulary: each character of a token stands for one byte.

    Printable bytes stand for themselves and the others, in order, for the characters from 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(b): b for b in plain}
    byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    table = [b""] * (max(tokenizer.get_vocab(with_added_tokens=True).values()) + 1)
    for token, i in tokenizer.get_vocab(with_added_tokens=True).items():
        table[i] = bytes(byte_of[c] for c in token)
    return table


#: how byte-level BPE parts text into words; fixed value
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def rank_encoding(tokenizer, table: list[bytes]):
    """The tokenizer as a rank encoding, which is faster; None where that might not be the same.

    It is, if the tokenizer is plain byte-level BPE whose ids are in the order of its merges.
    """
    import tiktoken

    config = json.loads(tokenizer.to_str())
    model, before, added = config["model"], config["pre_tokenizer"] or {}, config["added_tokens"]
    joined = ["".join(m) if isinstance(m, list) else m.replace(" ", "", 1) for m in model.get("merges", ())]
    plain = (
        model["type"] == "BPE"
        and not (config["normalizer"] or model["dropout"] or model["ignore_merges"])
        and not (model["continuing_subword_prefix"] or model["end_of_word_suffix"])
        and before.get("type") == "ByteLevel"
        and before.get("use_regex")
        and not before.get("add_prefix_space")
        and [model["vocab"].get(t) for t in joined] == list(range(256, 256 + len(joined)))
        and not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added)
    )
    if not plain:
        return None
    special = {t["content"]: t["id"] for t in added}
    ranks = {table[i]: i for t, i in model["vocab"].items() if t not in special}
    return tiktoken.Encoding("ranks", pat_str=WORDS, mergeable_ranks=ranks, special_tokens=special)


class ChunkEncoder:
    """Encodes texts to what the tokenizer gives for each as a whole."""

    def __init__(self, path: str, cache_chunks: int = CACHE_CHUNKS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        self.bytes_of = token_bytes(self._tokenizer)
        self._ranks = rank_encoding(self._tokenizer, self.bytes_of)
        self._sizes = np.array([len(b) for b in self.bytes_of], np.int64)
        self._cache: OrderedDict[bytes, tuple[np.ndarray, np.ndarray]] = OrderedDict()
        self._cache_chunks = cache_chunks

    def _encode_one(self, text: str) -> np.ndarray:
        if self._ranks is not None:
            try:
                return self._ranks.encode_to_numpy(text, allowed_special="all")
            except ValueError:  # its pattern gives up on very long runs of white space
                pass
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _encode(self, pieces: list[bytes]) -> list[np.ndarray]:
        return [self._encode_one(p.decode("utf-8")) for p in pieces]

    def _chunks(self, pieces: list[bytes]) -> dict[bytes, tuple[np.ndarray, np.ndarray]]:
        """Ids of distinct chunks and the offsets at which their tokens end; only unknown ones are encoded."""
        found = {p: self._cache.get(p) for p in dict.fromkeys(pieces)}
        new = [p for p, known in found.items() if known is None]
        for p, ids in zip(new, self._encode(new), strict=True):
            found[p] = self._cache[p] = (ids, np.concatenate(([0], np.cumsum(self._sizes[ids]))))
        for p in pieces:
            self._cache.move_to_end(p)
        while len(self._cache) > self._cache_chunks:
            self._cache.popitem(last=False)
        return found

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        starts = np.cumsum([0, *map(len, texts)])
        cuts = cut_points(np.frombuffer(b"".join(texts), np.uint8), starts[:-1])
        at = np.searchsorted(cuts, starts)
        ends = [chunk_ends(t, (cuts[at[i] : at[i + 1]] - starts[i]).tolist()) for i, t in enumerate(texts)]
        spans = [list(zip([0, *e[:-1]], e, strict=True)) for e in ends]
        chunks = self._chunks([t[a:b] for t, s in zip(texts, spans, strict=True) for a, b in s])
        parts = [[chunks[t[a:b]] for a, b in s] for t, s in zip(texts, spans, strict=True)]
        windows = [
            [[anchor_before(t, j), anchor_after(t, j)] for j in e[:-1] if not (t[j] == 0x20 and _is_anchor(t, j))]
            for t, e in zip(texts, ends, strict=True)
        ]
        return self._repaired(texts, spans, parts, windows)

    def _repaired(self, texts, spans, parts, windows) -> list[np.ndarray]:
        """Re-encode the text around each join; widen where its ends are no token ends of the chunks beside it."""
        done: list[np.ndarray | None] = [None] * len(texts)
        todo = list(range(len(texts)))
        while todo:
            for i in todo:
                windows[i] = _merged(windows[i])
            fresh = iter(self._encode([texts[i][a:b] for i in todo for a, b in windows[i]]))
            again = []
            for i in todo:
                ids, wider = self._assemble(texts[i], spans[i], parts[i], windows[i], [next(fresh) for _ in windows[i]])
                if wider:
                    windows[i] = wider
                    again.append(i)
                else:
                    done[i] = ids
            todo = again
        return done

    def _assemble(self, text, spans, parts, windows, fresh):
        # pieces of text that come from chunks lie between the windows
        edges = [0, *(x for w in windows for x in w), len(text)]
        out, wider, k = [], [list(w) for w in windows], 0
        widened = False
        for n in range(0, len(edges), 2):
            a, b = edges[n], edges[n + 1]
            while a < b:
                while spans[k][1] <= a:
                    k += 1
                start, end = spans[k]
                stop = min(b, end)
                ids, offsets = parts[k]
                i, j = np.searchsorted(offsets, (a - start, stop - start))
                if offsets[i] != a - start:
                    wider[n // 2 - 1][1], widened = anchor_after(text, a), True
                if offsets[j] != stop - start:
                    wider[n // 2][0], widened = anchor_before(text, stop - 1), True
                out.append(ids[i:j])
                a = stop
            if n // 2 < len(fresh):
                out.append(fresh[n // 2])
        return (np.concatenate(out) if out else np.empty(0, np.uint32)), wider if widened else None

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


def _merged(windows: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(windows):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return out


def _encoder(path: str, cache_chunks: int) -> Step:
    encoder = ChunkEncoder(path, cache_chunks)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = encoder.encode(text_bytes(batch.column("text")))
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()),
                pa.array([encoder.decode(x) for x in ids], pa.string()),
            ],
            ["doc_id", "ids", "decoded"],
        )

    return step


def encode_documents(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", cache_chunks: int = CACHE_CHUNKS
) -> DataFrame:
    """Token ids of every text and the text that they decode to, as the tokenizer file at ``path`` has it.

    Texts are cut where a rolling hash of their bytes says so, hence at the same places in copies of a passage.
    A task encodes a chunk once, for whatever documents have it, and remembers the last ``cache_chunks``. What
    the tokenizer would do across a join is repaired: the text from the last safe place before to the
    first one after it is encoded again and put in place of the chunks' tokens there; where the chunks have no
    token end at such a place, the window grows to the next one, at last to the whole text. Safe places are single
    spaces between printable ASCII characters, at which a byte-level tokenizer always begins a new word. Special
    tokens in a text become their ids, as the tokenizer does by default; none are added.

    Nothing is shuffled, a task holds a few megabytes of text at a time (a longer text alone), and the file must
    be at ``path`` on every machine.

    Null and empty texts have no tokens. Null ids and repeated rows pass through. An empty table gives no
    rows. Other columns are not read, whatever their names.

    Columns: doc_id, ids (32-bit little-endian unsigned integers), decoded.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary, decoded string"
    return map_texts(rows, lambda: _encoder(path, cache_chunks), schema)
