"""Fast exact encoding of whole texts with a byte-level BPE tokenizer.

Such a tokenizer first cuts a text into pieces that are encoded one by one, and
no piece reaches across a single space or a lone line feed.  Texts are therefore
cut there (with numpy, over the bytes of a whole batch), each distinct chunk is
encoded once by the tokenizers library, and a text's ids are its chunks' ids in
order.  Texts in which a cut might be wrong (runs of white space around a space,
white space beyond ASCII, separator control characters, special tokens) are
encoded whole.
"""

from __future__ import annotations

import os
import re

import numpy as np

from .chunk_memo import PLAIN_END, PLAIN_START

#: Chunks remembered by one Python worker; beyond it the memory starts anew.
MAX_CHUNKS = 1_000_000
#: New chunks are encoded so many at a time: the library's results are large.
PART_CHUNKS = 4096
#: Plain chunks encoded together.
JOINED = 256
#: Texts are cut in runs of about so many bytes.
RUN_BYTES = 1_000_000
_SPACE = rb"[\x09-\x0d\x20]"
_UNSURE = (_SPACE + b"\x20" + _SPACE + rb"|[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80"
           rb"|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
_P1, _P2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class _Powers:
    """Powers of an odd multiplier and of its inverse modulo 2**64."""

    def __init__(self, p: np.uint64):
        self.p, self.inverse = p, np.uint64(pow(int(p), -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int):
        if len(self.up) < n:
            self.up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, self.p)]), dtype=np.uint64)
            self.down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, self.inverse)]), dtype=np.uint64)
        return self.up[:n], self.down[:n]


class WordTokens:
    """Encoder with a memory of chunks; one lives in each Python worker."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        added = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        special = [re.escape(c.encode()) for c in added.values()]
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        #: Bytes of each token: an entry has a character for each, an added one is plain text.
        self.bytes_of = np.zeros(max(vocab.values()) + 1, np.int64)
        for entry, i in vocab.items():
            self.bytes_of[i] = len(entry.encode()) if i in added else len(entry)
        self.unsure = re.compile(b"|".join([_UNSURE, *special]))
        rng = np.random.default_rng(20240607)
        self.byte_values = rng.integers(1, 1 << 63, size=(2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.powers = [_Powers(_P1), _Powers(_P2)]
        self._forget()

    def _forget(self):
        self.keys = np.empty(0, np.uint64)      # sorted chunk hashes
        self.check = np.empty(0, np.uint64)     # a second hash of each
        self.at = np.empty(0, np.int64)         # where its ids start
        self.n = np.empty(0, np.int64)          # how many they are
        self.ids = np.empty(0, np.uint32)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, their offsets) of the UTF-8 texts data[offsets[i]:offsets[i + 1]]."""
        ids, sizes, a, n = [], [], 0, len(offsets) - 1
        while a < n:
            b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + RUN_BYTES)) - 1)
            part, count = self._encode_run(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            ids.append(part)
            sizes.append(count)
            a = b
        sizes = np.concatenate(sizes) if sizes else np.empty(0, np.int64)
        return (np.concatenate(ids) if ids else np.empty(0, np.uint32),
                np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))

    def _encode_run(self, data: np.ndarray, offsets: np.ndarray):
        n_texts = len(offsets) - 1
        if not len(data):
            return np.empty(0, np.uint32), np.zeros(n_texts, np.int64)
        starts = self._starts(data, offsets)
        where = self._find(data, starts)
        text_of = np.searchsorted(offsets, starts, side="right") - 1
        unsure = np.zeros(n_texts, bool)
        for m in self.unsure.finditer(data.tobytes()):
            unsure[np.searchsorted(offsets, m.start(), side="right") - 1] = True
            unsure[np.searchsorted(offsets, m.end() - 1, side="right") - 1] = True
        unsure[text_of[where < 0]] = True
        n = np.where(where < 0, 0, self.n[where])
        n[unsure[text_of]] = 0
        per_text = np.bincount(text_of, weights=n, minlength=n_texts).astype(np.int64)
        # Ragged gather: position within a chunk plus where its ids start.
        first = np.cumsum(n) - n
        flat = np.repeat(self.at[where] - first, n) + np.arange(int(n.sum()))
        ids = self.ids[flat]
        if unsure.any():
            which = np.flatnonzero(unsure)
            whole = self._encode([data[offsets[i]:offsets[i + 1]].tobytes().decode() for i in which])
            before = np.concatenate([[0], np.cumsum(per_text)])
            pieces, last = [], 0
            for i, own in zip(which, whole):
                pieces += [ids[last:before[i]], np.array(own, np.uint32)]
                last = before[i]
                per_text[i] = len(own)
            ids = np.concatenate([*pieces, ids[last:]])
        return ids, per_text

    @staticmethod
    def _starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where chunks start: at texts, at spaces, at and behind lone line feeds."""
        begins = np.zeros(len(data) + 1, bool)
        begins[offsets] = True
        space = data == 32
        blank = space | ((data >= 9) & (data <= 13))
        feed = np.flatnonzero(data[1:-1] == 10) + 1
        feed = feed[~blank[feed - 1] & ~blank[feed + 1] & ~begins[feed] & ~begins[feed + 1]]
        begins[:-1] |= space
        begins[feed] = begins[feed + 1] = True
        return np.flatnonzero(begins[:-1])

    def _hashes(self, data: np.ndarray, starts: np.ndarray, which: int) -> np.ndarray:
        up, down = self.powers[which].get(len(data) + 1)
        total = np.concatenate([[np.uint64(0)], np.cumsum(self.byte_values[which][data] * up[:len(data)])])
        ends = np.append(starts[1:], len(data))
        h = (total[ends] - total[starts]) * down[starts]
        return h ^ (h >> np.uint64(29))

    def _find(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Place of every chunk in the memory, learning new ones; -1 where two
        different chunks share a hash."""
        with np.errstate(over="ignore"):
            first, second = (self._hashes(data, starts, i) for i in (0, 1))
        keys, at, place = np.unique(first, return_index=True, return_inverse=True)
        pos = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = pos < len(self.keys)
        known[inside] = self.keys[pos[inside]] == keys[inside]
        if not known.all():
            if len(self.keys) + len(keys) > MAX_CHUNKS:
                self._forget()
                known[:] = False
            self._learn(data, starts, keys[~known], at[~known], second)
            pos = np.searchsorted(self.keys, keys)
        where = pos[place]
        return np.where(self.check[where] == second, where, -1)

    def _each(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many of each) of chunks, one by one."""
        own = self._encode([c.decode() for c in chunks])
        sizes = np.fromiter(map(len, own), np.int64, len(own))
        return np.fromiter((i for x in own for i in x), np.uint32, int(sizes.sum())), sizes

    def _joined(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same of plain chunks, encoded together with line feeds between them, which
        no piece holds beside other characters: tokens are dealt out by their bytes."""
        runs = [b"\n" + b"\n".join(chunks[i:i + JOINED]) for i in range(0, len(chunks), JOINED)]
        ids = np.concatenate([np.array(x, np.uint32) for x in self._encode([r.decode() for r in runs])])
        ends = np.cumsum(self.bytes_of[ids])
        size = np.fromiter(map(len, chunks), np.int64, len(chunks))
        stops = np.cumsum(size + 1)
        edges = np.concatenate([stops - size, stops])
        at = np.minimum(np.searchsorted(ends, edges), max(0, len(ends) - 1))
        if not len(ends) or not np.array_equal(ends[at], edges):
            return self._each(chunks)
        first, last = at[:len(chunks)] + 1, at[len(chunks):] + 1
        sizes = last - first
        return ids[np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))], sizes

    def _learn(self, data, starts, keys, at, second):
        ends = np.append(starts[1:], len(data))
        raw = data.tobytes()
        chunks = [raw[starts[i]:ends[i]] for i in at.tolist()]
        plain = np.fromiter((PLAIN_START.match(c) is not None and PLAIN_END.search(c) is not None for c in chunks), bool, len(chunks))
        n, begin, ids, base = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64), [self.ids], len(self.ids)
        for which, encode in ((np.flatnonzero(plain), self._joined), (np.flatnonzero(~plain), self._each)):
            for a in range(0, len(which), PART_CHUNKS):
                own = which[a:a + PART_CHUNKS]
                part, sizes = encode([chunks[i] for i in own.tolist()])
                n[own], begin[own] = sizes, base + np.cumsum(sizes) - sizes
                ids.append(part)
                base += len(part)
        self.ids = np.concatenate(ids)
        place = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, place, keys)
        self.check = np.insert(self.check, place, second[at])
        self.at = np.insert(self.at, place, begin)
        self.n = np.insert(self.n, place, n)


_ENCODERS: dict[str, WordTokens] = {}


def encoder(path: str) -> WordTokens:
    if path not in _ENCODERS:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")       # a task is one thread
        _ENCODERS[path] = WordTokens(path)
    return _ENCODERS[path]
