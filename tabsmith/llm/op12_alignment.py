"""Alignment of two tokenizers over whole texts.

Both tokenizers cut the same bytes, a space and the text.  Where a token of A and
one of B end at the same byte, a group ends; the two tokens are linked.

*Fragments.*  What a range of bytes holds is a fragment: the tokens up to its
first common end (open prefix), closed groups, and the tokens after its last
common end (open suffix); a range without a common end is open as a whole.  Two
neighbours compose: the suffix of the left and the prefix of the right close the
groups between them (``compose``; associative, the empty fragment is neutral).
Very long texts are cut into byte ranges, a row each, at places no token crosses,
chosen for A and for B apart; tasks align the ranges, and a tree of shuffles
composes their open ends, ``FAN`` neighbours at a time.  Groups leave a range (or
a step of the tree) as soon as they are closed, with their place in the text, so
no task holds a whole long text's groups; a last sorted pass reads them in order.

*Short texts.*  They are one range each.  Texts are cut into chunks that neither
tokenizer crosses (see ``word_starts``), so that a chunk's own groups are closed,
and a worker aligns each distinct chunk once, in a memory of bounded size.

*Counts.*  Links are counted per task by chunk, then summed per id pair in one
shuffle.  The links of short texts are written beside their figures, so that no
text is encoded twice; a second pass looks their counts up.  These are broadcast
in slices of at most about ``MAX_PAIRS`` pairs, a pass over the written links for
each slice; a corpus whose pairs fit into one slice needs one.

Defined cases: null and empty texts, and texts whose tokens' joined bytes differ
from the text's (such as those that hold U+2581), have no tokens: zeros, no hash
and no links; control strings inside texts are plain text; rows that repeat are
rows each and count each; a null id is kept; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Iterator
from itertools import chain, groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.session import materialize

from .chunk_memo import PLAIN_END, PLAIN_START, ChunkMemo, sums, text_runs, word_starts
from .common import release
from .op13_token_counts import MARK

#: Bytes of a range; texts of fewer bytes are one.
RANGE_BYTES = 32768
FAN = 16                    # neighbours composed by one step of the tree
MAX_CHUNKS = 300_000        # remembered by one Python worker
PART_CHUNKS = 4096          # encoded at a time: the library's results are large
RUN_BYTES = 500_000         # of short texts aligned at a time
JOINED = 256                # plain chunks read together
MAX_PAIRS = 2_000_000       # id pairs in a slice of the counts: 34 MB
#: Where no token of A crosses: a single space between characters that are no white space.
CUT_A = re.compile(rb"(?:(?<=[\x21-\x7e])|(?<=[\xc3-\xdf][\x80-\xbf]))\x20(?=[\x21-\x7e\xc3-\xe0\xe4-\xf4])")
#: Where no token of B crosses: a space behind something else than a space.
CUT_B = re.compile(rb"(?<!\x20)(?<!\xe2\x96\x81)\x20")


class Tokens(NamedTuple):
    """Tokens of one tokenizer: ids and the byte at which each ends."""
    ids: np.ndarray
    ends: np.ndarray

    def part(self, a: int, b: int | None = None) -> Tokens:
        return Tokens(self.ids[a:b], self.ends[a:b])

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(np.concatenate([self.ids, other.ids]), np.concatenate([self.ends, other.ends]))


NO_TOKENS = Tokens(np.empty(0, np.int64), np.empty(0, np.int64))


class Groups(NamedTuple):
    """Closed groups in order: their text (each with a ``;`` behind it), sizes
    and the id pairs that they link."""
    text: bytes
    n_a: int
    n_b: int
    pairs: np.ndarray


NO_GROUPS = Groups(b"", 0, 0, np.empty(0, np.int64))


class Fragment(NamedTuple):
    """``closed`` is None where the range has no common end; its tokens are then
    all in ``prefix``."""
    prefix: tuple[Tokens, Tokens]
    closed: Groups | None
    suffix: tuple[Tokens, Tokens]


EMPTY = Fragment((NO_TOKENS, NO_TOKENS), None, (NO_TOKENS, NO_TOKENS))


def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a.astype(np.int64) << 32 | b.astype(np.int64)


def spell(a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> tuple[bytes, np.ndarray]:
    """(text, end of each group in it) of whole groups of ids; group i ends with the
    ids at last_a[i] and last_b[i]."""
    size_a, size_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
    at_a = np.arange(len(a)) + np.repeat(last_b + 1 - size_b, size_a)      # behind the B ids of earlier groups
    at_b = np.arange(len(b)) + np.repeat(last_a + 1, size_b)
    ids, stops = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
    ids[at_a], ids[at_b] = a, b
    stops[at_a[last_a]], stops[at_b[last_b]] = ord("|"), ord(";")
    digits = np.ones(len(ids), np.int64)
    for power in range(1, len(str(int(ids.max(initial=0))))):
        digits += ids >= 10 ** power
    ends = np.cumsum(digits + 1)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    out[ends - 1] = stops
    left, place = ids, ends - 2
    some = np.arange(len(ids))
    while len(some):
        out[place[some]] = left[some] % 10 + ord("0")
        left, place = left // 10, place - 1
        some = some[left[some] > 0]
    return out.tobytes(), ends[at_b[last_b]]


def common_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the tokens of A and of B that end together."""
    begin = min(ends_a[0], ends_b[0]) if len(ends_a) and len(ends_b) else 0
    size = int(max(ends_a[-1], ends_b[-1]) - begin) + 1 if len(ends_a) and len(ends_b) else 0
    if not size:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    seen = np.zeros((2, size), bool)
    seen[0, ends_a - begin] = True
    seen[1, ends_b - begin] = True
    return np.flatnonzero(seen[1, ends_a - begin]), np.flatnonzero(seen[0, ends_b - begin])


def close(a: Tokens, b: Tokens) -> Groups:
    """Groups of tokens whose last ends are common."""
    if not len(a.ids):
        return NO_GROUPS
    last_a, last_b = common_ends(a.ends, b.ends)
    return Groups(spell(a.ids, b.ids, last_a, last_b)[0], len(a.ids), len(b.ids), pair_key(a.ids[last_a], b.ids[last_b]))


def fragment(a: Tokens, b: Tokens) -> Fragment:
    """What a range's tokens of A and of B make."""
    at_a, at_b = common_ends(a.ends, b.ends)
    if not len(at_a):
        return Fragment((a, b), None, (NO_TOKENS, NO_TOKENS))
    i, j, k, m = at_a[0] + 1, at_b[0] + 1, at_a[-1] + 1, at_b[-1] + 1
    return Fragment((a.part(0, i), b.part(0, j)), close(a.part(i, k), b.part(j, m)), (a.part(k), b.part(m)))


def compose(left: Fragment, right: Fragment) -> tuple[Fragment, Groups]:
    """(the fragment of both ranges, the groups that their meeting closes).  The
    fragment's own groups are left to the caller, who knows their places: its
    ``closed`` is empty, or None where the whole is still open."""
    if left.closed is None:
        # What is open in the left may share ends with the right's open start.
        own = fragment(left.prefix[0] + right.prefix[0], left.prefix[1] + right.prefix[1])
        if own.closed is None:
            return Fragment(own.prefix, None, own.suffix), NO_GROUPS
        suffix = right.suffix if right.closed is not None else own.suffix
        return Fragment(own.prefix, NO_GROUPS, suffix), own.closed
    own = fragment(left.suffix[0] + right.prefix[0], left.suffix[1] + right.prefix[1])
    if own.closed is None:
        return Fragment(left.prefix, NO_GROUPS, own.prefix), NO_GROUPS
    first = close(*own.prefix)
    middle = Groups(first.text + own.closed.text, first.n_a + own.closed.n_a, first.n_b + own.closed.n_b,
                    np.concatenate([first.pairs, own.closed.pairs]))
    suffix = right.suffix if right.closed is not None else own.suffix
    return Fragment(left.prefix, NO_GROUPS, suffix), middle


class Tokenizers:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        import json

        import sentencepiece
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        n = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(n)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode()
                        for i, p in enumerate(pieces)]
        # A's entries spell bytes by characters: printable ones of Latin-1 stand for
        # themselves, the others for U+0100 and on, in order.
        plain = [*range(0x21, 0x7f), *range(0xa1, 0xad), *range(0xae, 0x100)]
        spelt = {chr(c): c for c in plain}
        spelt |= {chr(0x100 + i): c for i, c in enumerate(sorted(set(range(256)) - set(plain)))}
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a: list[bytes] = [b""] * (max(vocab.values()) + 1)
        added = {t.content for t in self.a.get_added_tokens_decoder().values()}
        for entry, i in vocab.items():
            self.bytes_a[i] = entry.encode() if entry in added else bytes(spelt.get(c, 0) for c in entry)
        self.array_a, self.array_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        kind = json.loads(self.a.to_str())
        before = kind["pre_tokenizer"] or {}
        #: Texts may be cut where the module says.
        self.cuts = (before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
                     and kind["normalizer"] is None
                     and not any(MARK in p.lstrip(MARK) or ("\n" in p and len(p) > 1) for p in pieces))

    def ids_a(self, parts: list[bytes]) -> Iterator[list[int]]:
        """Ids of each part, read as it would be inside a text."""
        for at in range(0, len(parts), PART_CHUNKS):
            yield from [e.ids for e in self.a.encode_batch_fast([p.decode() for p in parts[at:at + PART_CHUNKS]], add_special_tokens=False)]

    def ids_b(self, parts: list[bytes]) -> Iterator[list[int]]:
        # The model sets a space of its own before a text; a line feed never merges.
        for at in range(0, len(parts), PART_CHUNKS):
            own = [p[1:] if p[:1] == b" " and len(p) > 1 else b"\n" + p for p in parts[at:at + PART_CHUNKS]]
            for part, spaced, ids in zip(parts[at:at + PART_CHUNKS], own, self.b.encode([x.decode() for x in own], num_threads=1), strict=True):
                yield ids if len(spaced) < len(part) else ids[2:]

    def read(self, part: bytes, ids: list[int], which: str) -> bool:
        """Whether the tokens' joined bytes are the part's."""
        table = self.bytes_a if which == "a" else self.bytes_b
        return b"".join([table[i] for i in ids]) == part

    def _each(self, chunks: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """(ids, numbers of ids by chunk) of A and of B, and which chunks read back;
        those that don't have no ids."""
        lists = [list(self.ids_a(chunks)), list(self.ids_b(chunks))]
        good = np.array([self.read(c, a, "a") and self.read(c, b, "b") for c, a, b in zip(chunks, *lists, strict=True)], bool)
        lists = [[x if g else [] for x, g in zip(own, good, strict=True)] for own in lists]
        counts = [np.fromiter(map(len, own), np.int64, len(own)) for own in lists]
        return [np.fromiter(chain.from_iterable(own), np.int64, int(n.sum())) for own, n in zip(lists, counts, strict=True)], counts, good

    def _joined(self, chunks: list[bytes]):
        """The same of plain chunks, read together with line feeds between them, which
        neither tokenizer lets a token cross; None if they don't read back so."""
        runs = [b"\n" + b"\n".join(chunks[i:i + JOINED]) for i in range(0, len(chunks), JOINED)]
        size = np.fromiter(map(len, chunks), np.int64, len(chunks))
        ids, counts = [], []
        for which, table, sizes in (("a", self.bytes_a, self.array_a), ("b", self.bytes_b, self.array_b)):
            lead = int(which == "b")                       # the space that B sets before a text
            flat = []
            for i in range(0, len(runs), PART_CHUNKS // JOINED):       # the library's results are large
                part = runs[i:i + PART_CHUNKS // JOINED]
                texts = [r.decode() for r in part]
                own = ([e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)] if which == "a"
                       else self.b.encode(texts, num_threads=1))
                own = list(chain.from_iterable(own))
                if b"".join(map(table.__getitem__, own)) != b"".join([b" " * lead + r for r in part]):
                    return None
                flat.append(np.array(own, np.int64))
            flat = np.concatenate(flat)
            ends = np.cumsum(sizes[flat])
            step = np.ones(len(chunks), np.int64)
            step[::JOINED] += lead
            stops = np.cumsum(size + step)                 # where chunks end, and begin
            begins = stops - size
            at = np.searchsorted(ends, np.concatenate([begins, stops]))
            if not np.array_equal(ends[np.minimum(at, len(ends) - 1)], np.concatenate([begins, stops])):
                return None
            first, last = at[:len(chunks)] + 1, at[len(chunks):] + 1
            counts.append(last - first)
            ids.append(flat[np.repeat(first - np.cumsum(counts[-1]) + counts[-1], counts[-1]) + np.arange(int(counts[-1].sum()))])
        return ids, counts, np.ones(len(chunks), bool)

    def align_chunks(self, chunks: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """(text of the groups, (tokens of A, of B, groups, whether it reads back), id
        pairs) of chunks that no token leaves."""
        plain = np.array([PLAIN_START.match(c) is not None and PLAIN_END.search(c) is not None for c in chunks], bool) & self.cuts
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        easy = [chunks[i] for i in order[:int(plain.sum())].tolist()]
        rest = [chunks[i] for i in order[len(easy):].tolist()]
        found = [(self._joined(easy) if easy else None) or self._each(easy), self._each(rest)]
        ids, counts = ([np.concatenate([f[k][w] for f in found]) for w in (0, 1)] for k in (0, 1))
        good = np.concatenate([f[2] for f in found])
        last_a, last_b = common_ends(*(np.cumsum(sizes[own]) for own, sizes in zip(ids, (self.array_a, self.array_b), strict=True)))
        text, stops = spell(*ids, last_a, last_b)
        groups = np.searchsorted(last_a, np.cumsum(counts[0]))             # up to each chunk's end
        at = np.concatenate([[0], stops])[groups].tolist()
        texts = [text[i:j] for i, j in zip([0, *at], at)]
        pairs, n = pair_key(ids[0][last_a], ids[1][last_b]), np.diff(groups, prepend=0)
        # Back to the order in which the chunks came.
        back = np.argsort(order)
        first = (groups - n)[back]
        n = n[back]
        pairs = pairs[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
        return [texts[i] for i in back.tolist()], np.stack([counts[0][back], counts[1][back], n, good[back]], axis=1), pairs

    def ends(self, ids: list[int], which: str, at: int = 0) -> Tokens:
        ids = np.array(ids, np.int64)
        return Tokens(ids, at + np.cumsum((self.array_a if which == "a" else self.array_b)[ids]))


class Aligner:
    """Aligns short texts by their chunks; one lives in each Python worker."""

    def __init__(self, path_a: str, path_b: str, most: int = MAX_CHUNKS):
        self.tokenizers = Tokenizers(path_a, path_b)
        self.memo = ChunkMemo(self._learn, self._forget, most)
        self.links = None
        self._forget()

    def use(self, links: CountLinks | None) -> Aligner:
        """Sets who counts the links of chunks."""
        self.links = links
        return self

    def finish(self) -> None:
        """Ends a task: its links are counted and the memory goes, since the worker
        may wait beside others that need the room."""
        self.memo.restart()
        self.use(None)
        release()

    def _forget(self) -> None:
        if self.links is not None:
            self.links.forget(self)
        self.texts: list[bytes] = []
        self.sizes = np.empty((0, 4), np.int64)            # tokens of A, of B, groups, whether it reads back
        self.pairs = np.empty(0, np.int64)                 # of all chunks, in order

    def _learn(self, chunks: list[bytes]) -> None:
        texts, sizes, pairs = self.tokenizers.align_chunks(chunks)
        self.texts += texts
        self.sizes = np.concatenate([self.sizes, sizes])
        self.pairs = np.concatenate([self.pairs, pairs])

    def fragments(self, parts: list[bytes], places: list[int]) -> Iterator[tuple[bool, Fragment]]:
        """(whether it reads back, the fragment) of ranges that no token crosses."""
        for first, numbers, begins, good in self.runs(pa.array([p[1:].decode() for p in parts], pa.string())):
            for i, at in enumerate(places[first:first + len(good)]):
                own = numbers[begins[i]:begins[i + 1]]
                if not good[i] or not len(own):
                    yield bool(good[i]), EMPTY
                    continue
                n_a, n_b, _ = (int(x) for x in self.sizes[own, :3].sum(axis=0))
                head, text = b"".join([self.texts[x] for x in own.tolist()]).split(b";", 1)
                a, b = ([int(x) for x in ids.split(b",")] for ids in head.split(b"|"))
                prefix = self.tokenizers.ends(a, "a", at), self.tokenizers.ends(b, "b", at)
                yield True, Fragment(prefix, Groups(text, n_a - len(a), n_b - len(b), self.links_of(own)[1:]), (NO_TOKENS, NO_TOKENS))

    def links_of(self, numbers: np.ndarray) -> np.ndarray:
        """The id pairs of chunks, one after the other."""
        n = self.sizes[numbers, 2]
        begin = np.cumsum(self.sizes[:, 2]) - self.sizes[:, 2]
        return self.pairs[np.repeat(begin[numbers] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]

    def runs(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(first row, chunk numbers, begins of texts among them, good texts)."""
        for first, data, offsets in text_runs(column, RUN_BYTES):
            starts = word_starts(data, offsets) if self.tokenizers.cuts else np.unique(offsets[:-1][np.diff(offsets) > 0])
            numbers = self.memo.find(data, starts)
            begins = np.searchsorted(starts, offsets)
            bad = sums(1 - self.sizes[numbers, 3], begins) > 0
            yield first, numbers, begins, ~bad


class CountLinks:
    """Sums the links of a task by id pair, over the uses of chunks."""

    def __init__(self):
        self.done: list[tuple[np.ndarray, np.ndarray]] = []
        self.uses = np.empty(0, np.int64)

    def used(self, own: Aligner, numbers: np.ndarray) -> None:
        uses = np.bincount(numbers, minlength=len(own.texts))
        uses[:len(self.uses)] += self.uses
        self.uses = uses

    def add(self, pairs: np.ndarray, n: np.ndarray) -> None:
        keys, place = np.unique(pairs, return_inverse=True)
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, place, n)
        self.done.append((keys, total))
        if len(self.done) > 8:
            self._merge()

    def _merge(self) -> None:
        done, self.done = self.done, []
        self.add(np.concatenate([p for p, _ in done]), np.concatenate([n for _, n in done]))

    def forget(self, own: Aligner) -> None:
        n = len(self.uses)
        if n:
            begins = np.concatenate([[0], np.cumsum(own.sizes[:n, 2])])
            for a in range(0, n, 1 << 15):                 # a part at a time: sorting takes its own room
                b = min(n, a + (1 << 15))
                self.add(own.pairs[begins[a]:begins[b]], np.repeat(self.uses[a:b], own.sizes[a:b, 2]))
        self.uses = np.empty(0, np.int64)

    def rows(self) -> pa.RecordBatch:
        """(pair, n) of all so far, which is then forgotten."""
        pairs = n = np.empty(0, np.int64)
        if self.done:
            self._merge()
            ((pairs, n),), self.done = self.done, []
        return pa.RecordBatch.from_arrays([pa.array(pairs[n > 0]), pa.array(n[n > 0])], ["pair", "n"])

    def size(self) -> int:
        return sum(len(p) for p, _ in self.done)


class LookUp:
    """One slice of the counts: for any pairs, their counts and whether each is the
    highest of its B id."""

    def __init__(self, pairs: np.ndarray, counts: np.ndarray, best: np.ndarray):
        self.table = pairs, counts, best

    def of(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count, best) of every pair, 0 where another slice has it."""
        keys, counts, best = self.table
        if not len(keys):
            return np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
        at = np.minimum(np.searchsorted(keys, pairs), len(keys) - 1)
        there = keys[at] == pairs
        return np.where(there, counts[at], 0), (best[at] & there).astype(np.int64)


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(paths: tuple[str, str]) -> Aligner:
    if paths not in _ALIGNERS:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")       # a task is one thread
        _ALIGNERS[paths] = Aligner(*paths)
    return _ALIGNERS[paths]


# --- very long texts: ranges, fragments, the tree ---------------------------------------------------------------

RANGE_SCHEMA = "key binary, id {}, no long, at_a long, at_b long, part_a binary, part_b binary"


def _ranges(range_bytes: int):
    """Rows (id, text) to byte ranges; a key for each row of the input."""
    def cut(pattern: re.Pattern, text: bytes, at: int) -> int:
        found = pattern.search(text, at) if at < len(text) else None
        return found.start() if found else len(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text = b" " + batch.column(1)[i].as_py().encode()
                key, a, b = uuid.uuid4().bytes, 0, 0
                for no, at in enumerate(range(range_bytes, len(text) + range_bytes, range_bytes)):
                    # A range without a place to cut leaves its bytes to the one before.
                    next_a, next_b = max(a, cut(CUT_A, text, at)), max(b, cut(CUT_B, text, at))
                    yield pa.RecordBatch.from_arrays([
                        pa.array([key]), batch.column(0).slice(i, 1), pa.array([no]), pa.array([a]), pa.array([b]),
                        pa.array([text[a:next_a]], pa.binary()), pa.array([text[b:next_b]], pa.binary())],
                        ["key", "id", "no", "at_a", "at_b", "part_a", "part_b"])
                    a, b = next_a, next_b

    return run


#: kind 0: open ends of range ``no``; kind 1: groups closed at byte ``at``.
PART_SCHEMA = ("key binary, id {}, kind int, no long, good boolean, whole boolean, prefix binary, suffix binary, "
               "at long, text binary, n_a long, n_b long, pairs binary")
PART_NAMES = [c.split()[0] for c in PART_SCHEMA.split(", ")]


def _pack(tokens: tuple[Tokens, Tokens]) -> bytes:
    a, b = tokens
    return np.concatenate([[len(a.ids), len(b.ids)], a.ids, a.ends, b.ids, b.ends]).astype("<i8").tobytes()


def _unpack(data: bytes) -> tuple[Tokens, Tokens]:
    x = np.frombuffer(data, "<i8")
    n, m, x = int(x[0]), int(x[1]), x[2:]
    return Tokens(x[:n], x[n:2 * n]), Tokens(x[2 * n:2 * n + m], x[2 * n + m:])


def _open_row(key, id_, no, good, part: Fragment) -> dict:
    return {"key": key, "id": id_, "kind": 0, "no": no, "good": good, "whole": part.closed is None,
            "prefix": _pack(part.prefix), "suffix": _pack(part.suffix)}


def _closed_row(key, id_, at, groups: Groups) -> dict:
    return {"key": key, "id": id_, "kind": 1, "at": int(at), "text": groups.text, "n_a": groups.n_a, "n_b": groups.n_b,
            "pairs": groups.pairs.astype("<i8").tobytes()}


def _part_rows(rows: list[dict], id_type: pa.DataType) -> pa.RecordBatch:
    kinds = [pa.binary(), id_type, pa.int32(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary(), pa.binary(),
             pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], t) for n, t in zip(PART_NAMES, kinds, strict=True)],
                                      PART_NAMES)


def _first_end(part: Fragment) -> int:
    """Where the open start of a fragment ends: at its first common end."""
    return int(part.prefix[0].ends[-1])


def _fragment_of(both: Tokenizers, row: dict) -> tuple[bool, Fragment]:
    """A range whose tokens of A and of B lie between different cuts."""
    a = next(both.ids_a([row["part_a"]])) if row["part_a"] else []
    b = next(both.ids_b([row["part_b"]])) if row["part_b"] else []
    good = both.read(row["part_a"], a, "a") and both.read(row["part_b"], b, "b")
    return good, fragment(both.ends(a, "a", row["at_a"]), both.ends(b, "b", row["at_b"])) if good else EMPTY


def _align_ranges(paths: tuple[str, str]):
    """Ranges to the open ends and the closed groups of their fragments."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(paths).use(None)
        both = own.tokenizers
        for batch in batches:
            rows = batch.to_pylist()
            # Ranges with one cut for both tokenizers go through the memory of chunks, together.
            whole = [r for r in rows if both.cuts and r["at_a"] == r["at_b"] and r["part_a"] == r["part_b"] and len(r["part_a"]) > 1]
            found = own.fragments([r["part_a"] for r in whole], [r["at_a"] for r in whole])
            found = dict(zip(map(id, whole), found, strict=True))
            for row in rows:
                good, part = found.get(id(row)) or _fragment_of(both, row)
                out = [_open_row(row["key"], row["id"], row["no"], good, part)]
                if part.closed is not None and part.closed.n_a:
                    out.append(_closed_row(row["key"], row["id"], _first_end(part), part.closed))
                yield _part_rows(out, batch.column(1).type)
            release()
        own.finish()

    return run


def _compose_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Open ends, sorted by key and range, to those of FAN ranges together, and
    the groups that this closes."""
    def rows():
        for batch in batches:
            for row in batch.to_pylist():
                yield row, batch.column(1).type

    for (key, no), own in groupby(rows(), lambda r: (r[0]["key"], r[0]["no"] // FAN)):
        total, good, out, id_, kind = EMPTY, True, [], None, None
        for row, kind in own:
            good, id_ = good and row["good"], row["id"]
            part = Fragment(_unpack(row["prefix"]), None if row["whole"] else NO_GROUPS, _unpack(row["suffix"]))
            # Where the groups that are now closed begin: behind the left's last common end.
            if total.closed is None:
                total, closed = compose(total, part)
                at = _first_end(total) if total.closed is not None else 0
            else:
                begin = total.suffix[0].ends[0] if len(total.suffix[0].ids) else part.prefix[0].ends[:1]
                total, closed = compose(total, part)
                at = int(np.min(begin)) - 1 if np.size(begin) else 0
            if closed.n_a:
                out.append(_closed_row(key, id_, at, closed))
        yield _part_rows([_open_row(key, id_, no, good, total), *out], kind)


def _long_groups(docs: DataFrame, paths: tuple[str, str], kind: str, range_bytes: int) -> tuple[DataFrame, DataFrame]:
    """(rows of the long texts: key, id, good; their closed groups)."""
    ranges = materialize(docs.mapInArrow(_ranges(range_bytes), RANGE_SCHEMA.format(kind)), "byte-ranges")
    schema = PART_SCHEMA.format(kind)
    parts = materialize(ranges.repartition("key", "no").mapInArrow(_align_ranges(paths), schema), "fragments")
    closed = [parts.where("kind = 1")]
    level = parts.where("kind = 0")
    top = level.agg(F.max("no")).head()[0] or 0
    while top > 0:
        step = (level.withColumn("up", F.expr(f"no div {FAN}")).repartition("key", "up")
                .sortWithinPartitions("key", "no").drop("up").mapInArrow(_compose_neighbours, schema))
        step = materialize(step, "composed")
        closed.append(step.where("kind = 1"))
        level, top = step.where("kind = 0"), top // FAN

    def first_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The start of a text is a common end, so the first open group is closed too.
        for batch in batches:
            out = [_closed_row(r["key"], r["id"], -1, close(*_unpack(r["prefix"]))) for r in batch.to_pylist()]
            if out:
                yield _part_rows(out, batch.column(1).type)

    closed.append(materialize(level.where("good").mapInArrow(first_groups, schema), "first-groups"))
    groups = closed[0]
    for more in closed[1:]:
        groups = groups.unionByName(more)
    keep = level.where("good").select(F.col("key").alias("own"))
    return level.select("key", "id", "good"), groups.join(keep, F.col("key") == F.col("own"), "left_semi")


# --- counts, and the passes that look them up ---------------------------------------------------------------------

SHORT_SCHEMA = "id {}, n_a long, n_b long, n_groups long, groups_sha256 string, links array<long>, pair long, n long"


def _align_short(paths: tuple[str, str]):
    """Rows (id, text) to their figures and links, and rows (pair, n) of the counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted, kind = CountLinks(), None
        own = aligner(paths).use(counted)

        def counts() -> pa.RecordBatch:
            pair, n = counted.rows().columns
            none = [pa.nulls(len(pair), t) for t in (kind, *[pa.int64()] * 3, pa.string(), pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays([*none, pair, n], SHORT_NAMES)

        for batch in batches:
            kind = batch.column(0).type
            for first, numbers, begins, good in own.runs(batch.column(1)):
                if not good.all():
                    stay = np.repeat(good, np.diff(begins))
                    numbers, begins = numbers[stay], np.concatenate([[0], np.cumsum(np.diff(begins) * good)])
                counted.used(own, numbers)
                n = [sums(own.sizes[numbers, c], begins) for c in range(3)]
                digests = []
                for a, b in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True):
                    text = b"".join([own.texts[x] for x in numbers[a:b].tolist()])
                    digests.append(hashlib.sha256(text[:-1]).hexdigest() if a < b else "")
                links = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n[2])]).astype(np.int32)),
                                                 pa.array(own.links_of(numbers)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(digests)), *map(pa.array, n), pa.array(digests, pa.string()), links,
                     *[pa.nulls(len(digests), pa.int64())] * 2], SHORT_NAMES)
            release()
            if counted.size() > MAX_PAIRS:
                yield counts()
        own.finish()
        if kind is not None:
            yield counts()

    return run


SHORT_NAMES = [c.split()[0] for c in SHORT_SCHEMA.split(", ")]


def _count_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    links = CountLinks()
    for batch in batches:
        for row in batch.to_pylist():
            pairs = np.frombuffer(row["pairs"], "<i8")
            links.add(pairs, np.ones(len(pairs), np.int64))
        if links.size() > MAX_PAIRS:
            yield links.rows()
    yield links.rows()


FOUND = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
FOUND_TYPES = [pa.int64()] * 6 + [pa.string()]
FOUND_NAMES = [c.split()[0] for c in FOUND.split(", ")]


def _found_rows(ids: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(FOUND_NAMES)
    return pa.RecordBatch.from_arrays([ids, *(pa.array(c, t) for c, t in zip(columns, FOUND_TYPES, strict=True))],
                                      ["id", *FOUND_NAMES])


def _look_up_short(table):
    """Written figures and links to the rows of the result."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links = LookUp(*table.value)
        for batch in batches:
            own = batch.column("links")
            counts, best = links.of(own.flatten().to_numpy())
            begins = own.offsets.to_numpy().astype(np.int64) - own.offsets[0].as_py()
            n_groups = batch.column("n_groups")
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_a"), batch.column("n_b"), n_groups, n_groups, pa.array(sums(best, begins)),
                 pa.array(sums(counts, begins)), batch.column("groups_sha256")], ["id", *FOUND_NAMES])

    return run


def _look_up_long(table):
    """Closed groups, sorted by key and place, to a row for each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links = LookUp(*table.value)

        def rows():
            for batch in batches:
                for i in range(batch.num_rows):
                    yield {n: batch.column(n)[i].as_py() for n in ("key", "text", "n_a", "n_b", "pairs")}, batch.column("id").slice(i, 1)

        for _, own in groupby(rows(), lambda r: r[0]["key"]):
            digest, last, n, ids = hashlib.sha256(), b"", np.zeros(5, np.int64), None
            for row, ids in own:
                pairs = np.frombuffer(row["pairs"], "<i8")
                counts, best = links.of(pairs)
                n += [row["n_a"], row["n_b"], len(pairs), best.sum(), counts.sum()]
                digest.update(last)
                if last:
                    digest.update(b";")
                last = row["text"][:-1]
            digest.update(last)
            yield _found_rows(ids, [(*n[:3].tolist(), *n[2:].tolist(), digest.hexdigest())])

    return run


def _slices(counted: DataFrame, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The counts in slices of about ``most`` pairs: (pairs in order, counts, best)."""
    total = counted.count()
    n_slices = max(1, -(-total // most))
    for s in range(n_slices):
        part = counted.where(F.pmod(F.xxhash64("pair"), F.lit(n_slices)) == s).select("pair", "n", "best").toArrow()
        pairs = part.column("pair").to_numpy()
        order = np.argsort(pairs)
        yield pairs[order], part.column("n").to_numpy()[order], part.column("best").to_numpy()[order].astype(bool)


def align(docs: DataFrame, tokenizer_a: str, model_b: str, id_col: str = "doc_id", text_col: str = "text",
          range_bytes: int = RANGE_BYTES, max_pairs: int = MAX_PAIRS) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every
    document: the last is the hash of ``a1,a2|b1;a3|b2`` (ids in order)."""
    spark, paths = docs.sparkSession, (tokenizer_a, model_b)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    is_long = F.coalesce(F.octet_length("text") >= range_bytes, F.lit(False))
    short = rows.where(~is_long)
    long_rows, groups = _long_groups(rows.where(is_long), paths, kind, range_bytes)
    aligned = materialize(short.mapInArrow(_align_short(paths), SHORT_SCHEMA.format(kind)), "aligned")
    pairs = aligned.where("pair is not null").select("pair", "n").unionByName(
        groups.select("pairs").mapInArrow(_count_groups, "pair long, n long"))
    counted = pairs.groupBy("pair").agg(F.sum("n").alias("n"))
    # At most as many pairs for one id of B as A has ids.
    of_b = Window.partitionBy(F.expr("pair & 4294967295L"))
    counted = materialize(counted.withColumn("best", F.col("n") == F.max("n").over(of_b)), "pair-counts")
    schema = f"id {kind}, {FOUND}"
    zeros = long_rows.where("not good").select("id", *[F.lit(0).cast("long").alias(n) for n in FOUND_NAMES[:-1]],
                                               F.lit("").alias(FOUND_NAMES[-1]))
    short = aligned.where("pair is null").drop("pair", "n")
    ordered = groups.select("key", "id", "at", "text", "n_a", "n_b", "pairs").repartition("key").sortWithinPartitions("key", "at")
    found, n_slices = None, 0
    for table in _slices(counted, max_pairs):
        if n_slices == 1:
            found = materialize(found, "slice")
        # About max_pairs pairs, whatever the corpus.
        shared = spark.sparkContext.broadcast(table)
        part = short.mapInArrow(_look_up_short(shared), schema).unionByName(
            ordered.mapInArrow(_look_up_long(shared), schema)).unionByName(zeros)
        n_slices += 1
        if n_slices > 1:
            part = materialize(part, "slice")
            shared.unpersist()
        found = part if found is None else found.unionByName(part)
    if n_slices > 1:
        # Rows of one id and one hash are alike in every slice.
        found = (found.groupBy("id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
                 .agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"), F.count("*").alias("rows")))
        copies = (F.col("rows") / n_slices).cast("long")
        found = found.select("*", F.explode(F.sequence(F.lit(1).cast("long"), copies)).alias("copy")).select(
            "id", *[(F.col(n) / copies).cast("long").alias(n) if n in ("n_best", "count_sum") else n for n in FOUND_NAMES])
    return found.select(F.col("id").alias(id_col), *FOUND_NAMES)
