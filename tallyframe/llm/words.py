"""Words and word shingles of many texts at once, as arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
#: bytes that are looked at together; words are never cut
_PIECE = 1 << 18

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit integers over all bits; one to one."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int, factor: int) -> np.ndarray:
    out = np.full(n + 1, factor % (1 << 64), np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP = _powers(_PIECE, _MULTIPLIER)
_DOWN = _powers(_PIECE, pow(_MULTIPLIER, -1, 1 << 64))


def _piece_words(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of one piece; ``begins`` marks where a word may begin without a space before."""
    inside = ~_IS_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1] | begins[1:]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | begins[1:]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    if len(data) < len(_UP):
        up, down = _UP, _DOWN
    else:
        up, down = _powers(len(data), _MULTIPLIER), _powers(len(data), pow(_MULTIPLIER, -1, 1 << 64))
    # a polynomial over the word's bytes, as a difference of running sums brought to the same power
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return starts, mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word (A-Z lower-cased) of the texts ``data[offsets[i]:offsets[i + 1]]``, and words per text.

    The work goes piece by piece, so memory beyond the hashes doesn't grow with the length of a text.
    """
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets] = True
    hashes, places, at = [], [], 0
    while at < len(data):
        end = min(at + _PIECE, len(data))
        while end < len(data) and not (begins[end] or _IS_SPACE[data[end]]):
            step = np.flatnonzero(_IS_SPACE[data[end : end + _PIECE]] | begins[end : end + len(data[end : end + _PIECE])])
            end = end + int(step[0]) if len(step) else min(end + _PIECE, len(data))
        starts, found = _piece_words(data[at:end], begins[at:end])
        hashes.append(found)
        places.append(starts + at)
        at = end
    if not hashes:
        return np.empty(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    return np.concatenate(hashes), np.diff(np.searchsorted(np.concatenate(places), offsets))


def shingles(hashes: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of the ``size``-word shingles of each text, sorted within it, and their number per text.

    A text of fewer words has its whole sequence as one shingle; one without words has none.
    """
    n, firsts = len(counts), np.concatenate(([0], np.cumsum(counts)))
    of = np.repeat(np.arange(n), counts)
    left = firsts[of + 1] - np.arange(len(hashes))  # words from here to the end of the text
    begin = (left >= size) | ((np.arange(len(hashes)) == firsts[of]) & (left < size))
    at = np.flatnonzero(begin)
    value = np.zeros(len(at), np.uint64)
    for k in range(size):
        there = left[at] > k
        value[there] = mix(value[there] * np.uint64(_MULTIPLIER) + hashes[at[there] + k])
    of = of[at]
    ends = np.cumsum(np.bincount(of, minlength=n))
    for begin, end in zip((ends - np.bincount(of, minlength=n)).tolist(), ends.tolist()):
        value[begin:end].sort()
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (of[1:] != of[:-1])
    return value[new], np.bincount(of[new], minlength=n)
