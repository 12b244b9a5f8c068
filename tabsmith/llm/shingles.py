"""Word shingles of whole texts, hashed with numpy over the bytes of a batch.

A word is a run of bytes other than U+0020 and U+0009-U+000D after lower-casing
A-Z.  Words and shingles become 64-bit hashes: a polynomial over random byte
values, taken from prefix sums (so a batch costs a few passes over its bytes),
then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import ASCII_LOWER_BYTES

WIDTH = 5
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_RANDOM = np.random.default_rng(71)
_VALUES = _RANDOM.integers(1, 1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Value of each byte after lower-casing.
_VALUES = _VALUES[np.frombuffer(ASCII_LOWER_BYTES, np.uint8)]
_PLACES = _RANDOM.integers(1, 1 << 63, size=64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
#: Everything in ASCII but letters and digits separates words.
NOT_ALNUM = np.array([not (chr(c).isascii() and chr(c).isalnum()) and c < 128 for c in range(256)])
_UP = _DOWN = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _UP, _DOWN
    if len(_UP) < n:
        one = np.array([1], np.uint64)
        _UP = np.cumprod(np.concatenate([one, np.full(n - 1, _BASE, np.uint64)]), dtype=np.uint64)
        _DOWN = np.cumprod(np.concatenate([one, np.full(n - 1, _INVERSE, np.uint64)]), dtype=np.uint64)
    return _UP[:n], _DOWN[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a column of texts; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def words_of(data: np.ndarray, offsets: np.ndarray,
             blank: np.ndarray = _BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash) of every word; no word crosses an offset."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    word = ~blank[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    first[begins] = word[begins]
    starts = np.flatnonzero(first)
    # A word ends before a blank, before the next text or at the end.
    last = word.copy()
    last[:-1] &= ~word[1:] | first[1:]
    ends = np.flatnonzero(last) + 1
    up, down = _powers(len(data) + 1)
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_VALUES[data] * up[:len(data)], out=total[1:])
    h = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return starts, ends, h


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, offsets of the texts among them)."""
    starts, _, h = words_of(data, offsets)
    return h, np.searchsorted(starts, offsets)


def shingle_hashes(words: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Hashes of all runs of ``width`` words of one text; with fewer words the
    whole sequence is one shingle, without words there is none."""
    n = len(words)
    if n == 0:
        return words
    if n < width:
        return mix((words * _PLACES[:n]).sum(keepdims=True) + np.uint64(n))
    h = words[:n - width + 1] * _PLACES[0]
    for i in range(1, width):
        h = h + words[i:n - width + 1 + i] * _PLACES[i]
    return mix(h + np.uint64(width))


def runs_of_texts(column: pa.Array, run_bytes: int = 1_000_000) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, word hashes, offsets) for runs of texts, so that
    the work arrays stay small whatever the batch holds."""
    data, offsets = text_bytes(column)
    a, n = 0, len(offsets) - 1
    while a < n:
        b = min(n, max(a + 1, int(np.searchsorted(offsets, offsets[a] + run_bytes, side="right")) - 1))
        yield a, *word_hashes(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
        a = b
