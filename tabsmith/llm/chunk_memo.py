"""A bounded memory of distinct chunks of text.

Tokenizers work within pieces that no token leaves.  Texts are cut into such
chunks with numpy, over the bytes of many texts at once, and whatever a chunk
stands for (its number of tokens, its ids) is worked out once per worker.

A chunk is known by its size and 16 bytes: its own if it has no more, else the
128-bit XXH3 of them.  What the search goes by is a 64-bit mix of these; where
two chunks share a mix the memory starts anew with another mix, so the answer
never rests on it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

KEY_BYTES = 16
#: Texts are cut in runs of about so many bytes.
RUN_BYTES = 1_000_000
SPACE, FEED = 32, 10
#: White space beyond ASCII, separator controls and the mark U+2581: no cut beside them.
_ODD_BLANK = re.compile(rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]"
                        rb"|\xe2\x81\x9f|\xe2\x96\x81|\xe3\x80\x80")
#: Chunks that may be read together: no white space at their ends, but for one space before.
PLAIN_START = re.compile(rb"\x20?[\x21-\x7e\xc3-\xe0\xe4-\xf4]")
PLAIN_END = re.compile(rb"(?:[\x21-\x7e]|[\xc3-\xdf][\x80-\xbf]|[\xe0\xe4-\xef][\x80-\xbf]{2})\Z")
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def text_runs(column: pa.Array, run_bytes: int = RUN_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of texts, a space set before each text
    that is not empty; null is empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    a, n = 0, len(column)
    while a < n:
        b = min(n, max(a + 1, int(np.searchsorted(offsets, offsets[a] + run_bytes, side="right")) - 1))
        own = offsets[a:b + 1] - offsets[a]
        filled = np.diff(own) > 0
        spaced = np.insert(data[offsets[a]:offsets[b]], own[:-1][filled], SPACE)
        yield a, spaced, own + np.concatenate([[0], np.cumsum(filled)])
        a = b


def _begins(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets] = True
    return begins


def word_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of chunks that neither a byte-level tokenizer's pieces nor a piece
    of a sentence model cross: a single space between other characters, a line
    feed between other characters and what follows it."""
    begins = _begins(data, offsets)
    blank = (data == SPACE) | ((data >= 9) & (data <= 13))
    inner = (data == SPACE) | (data == FEED)
    for m in _ODD_BLANK.finditer(data.tobytes()):
        blank[m.start():m.end()] = True
    at = np.flatnonzero(inner[1:-1]) + 1
    at = at[~blank[at - 1] & ~blank[at + 1] & ~begins[at] & ~begins[at + 1]]
    begins[at] = True
    begins[at[data[at] == FEED] + 1] = True
    return np.flatnonzero(begins[:-1])


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of chunks that no piece of a sentence model crosses: a space behind
    something else than a space, line feeds and what follows them."""
    begins = _begins(data, offsets)
    space = data == SPACE
    blank = space.copy()
    for m in re.finditer(rb"\xe2\x96\x81", data.tobytes()):
        blank[m.end() - 1] = True
    at = np.flatnonzero(space[1:] & ~blank[:-1]) + 1
    feed = np.flatnonzero(data == FEED)
    begins[at] = begins[feed] = begins[feed + 1] = True
    return np.flatnonzero(begins[:-1])


class ChunkMemo:
    """Numbers distinct chunks in the order in which they are learnt.  ``learn``
    takes the bytes of new chunks, in order; ``forget`` is called when the memory
    starts anew, and numbers begin at 0 again."""

    def __init__(self, learn: Callable[[list[bytes]], None], forget: Callable[[], None], most: int):
        self.learn, self.forget, self.most, self.salt = learn, forget, most, 0
        self._clear()

    def _clear(self) -> None:
        self.mixes = np.empty(0, np.uint64)                          # sorted
        self.keys = np.empty((0, 3), np.uint64)                      # size and 16 bytes
        self.numbers = np.empty(0, np.int64)

    def restart(self) -> None:
        self._clear()
        self.forget()

    def _keys(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        size = np.diff(np.append(starts, len(data)))
        padded = np.concatenate([data, np.zeros(KEY_BYTES, np.uint8)])
        own = np.lib.stride_tricks.sliding_window_view(padded, KEY_BYTES)[starts]
        own *= np.arange(KEY_BYTES) < size[:, None]
        keys = np.empty((len(starts), 3), np.uint64)
        keys[:, 0], keys[:, 1:] = size, own.view("<u8")
        long = np.flatnonzero(size > KEY_BYTES)
        if len(long):
            import xxhash
            view = memoryview(np.ascontiguousarray(data))
            for i in long.tolist():
                a = int(starts[i])
                value = xxhash.xxh3_128_intdigest(view[a:a + int(size[i])])
                keys[i, 1], keys[i, 2] = value & (1 << 64) - 1, value >> 64
        return keys

    def _mixed(self, keys: np.ndarray) -> np.ndarray:
        mix = (keys[:, 0] + np.uint64(self.salt)) * _MIX[0]
        for column, factor in ((keys[:, 1], _MIX[1]), (keys[:, 2], _MIX[2])):
            mix = (mix ^ column) * factor
            mix ^= mix >> np.uint64(31)
        return mix * _MIX[3]

    def find(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The number of every chunk that starts at ``starts`` (the first at 0).
        A memory that is full starts anew before it takes more, so numbers hold
        until the next call."""
        if not len(starts):
            return np.empty(0, np.int64)
        keys = self._keys(data, starts)
        while True:
            mixes, at, place = np.unique(self._mixed(keys), return_index=True, return_inverse=True)
            distinct = keys[at]
            spot = np.searchsorted(self.mixes, mixes)
            known = np.zeros(len(mixes), bool)
            inside = spot < len(self.mixes)
            known[inside] = self.mixes[spot[inside]] == mixes[inside]
            if (distinct[place] == keys).all() and (self.keys[spot[known]] == distinct[known]).all():
                break
            self.salt += 1
            self.restart()
        fresh = ~known
        if fresh.any() and len(self.mixes) and len(self.mixes) + int(fresh.sum()) > self.most:
            self.restart()
            spot, known, fresh = np.zeros(len(mixes), np.int64), np.zeros(len(mixes), bool), np.ones(len(mixes), bool)
        numbers = np.empty(len(mixes), np.int64)
        numbers[known] = self.numbers[spot[known]]
        if fresh.any():
            numbers[fresh] = len(self.numbers) + np.arange(int(fresh.sum()))
            view = data.tobytes()
            ends = np.append(starts[1:], len(data))
            self.learn([view[starts[i]:ends[i]] for i in at[fresh]])
            self.mixes = np.insert(self.mixes, spot[fresh], mixes[fresh])
            self.keys = np.insert(self.keys, spot[fresh], distinct[fresh], axis=0)
            self.numbers = np.insert(self.numbers, spot[fresh], numbers[fresh])
        return numbers[place]


def sums(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Sums of ``values`` by text: text i owns values[begins[i]:begins[i + 1]]."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[begins[1:]] - total[begins[:-1]]
