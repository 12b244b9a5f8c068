"""Benchmark decontamination by CGK walks, bit sampling and an exact edit check.

A document leaks an item if some run of its words is within ``MAX_EDITS`` (a
share of the item's words) word edits of the whole item.  Words are runs of
letters and digits, A-Z lower-cased.

1. Segments.  An item is cut into segments of up to ``SEGMENT`` words.  A leak with
   d edits in m segments has one with floor(d / m) at most, so few however long
   the item is.
2. Screen.  At a place where such a segment could stand, enough of the benchmark's
   runs of three words (fewer for short segments) must meet; all other places of a
   document are passed over.  This loses nothing and knows no items.
3. CGK walks.  At each place left a window of the segments' size is embedded: a walk
   writes out its word at every step and moves on or stays as a random bit of
   (word, step) says, so an edit shifts two walks for a few steps only, and edit
   distance becomes Hamming distance.  Of ``WALKS`` walks ``TABLES`` tables each sample
   a few steps; a document and an item that agree in all samples of a table, at one
   segment, are a candidate.  Steps behind a segment's or a text's end agree with
   nothing.  Recall per item is over 0.95 at the most edits (tests measure it).
4. Exact check.  Where a candidate's grams meet on a diagonal often enough for a leak
   (n - 2 - 3d times for n words; lossless again), the distance of the item to the
   best run of words around it, by a bit-parallel dynamic program over whole items
   of any length.

All of it runs where a document is read; nothing is shuffled.  The benchmark's
index is broadcast: items are taken in parts of at most ``PART_CHARS``
characters, so its size is bounded whatever the benchmark holds, and a larger
benchmark costs another pass per part.

Defined cases: null or empty texts leak nothing; items without a word are never
leaked; items of under three words must occur unchanged; repeated items count
each; of an item's leaks in a document the one with fewest edits, then the
earliest, is told; null ids are kept; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release
from .shingles import NOT_ALNUM, mix, text_bytes, words_of

MAX_EDITS = 0.2
GRAM = 3
PART_CHARS = 32_000_000
RUN_BYTES = 1_000_000
_FILTER_BITS = 22
#: Words of a segment, walks, tables sampled from each, places embedded at a time.
SEGMENT, WALKS, TABLES, SLICE = 12, 6, 4, 1 << 15
_SEEDS = np.random.default_rng(20240917).integers(1, 1 << 63, WALKS).astype(np.uint64)


def _steps(size: int) -> int:
    """Steps of a walk: it seldom reaches a segment's end by then."""
    return max(1, 3 * size // 2)


def _samples(size: int, walk: int) -> list[list[int]]:
    """Steps that the tables of a walk sample, the same for documents and items."""
    rng, n = np.random.default_rng([size, walk]), 1 if size <= 2 else 2 if size < 8 else 3
    if size <= 2:
        return [[0]]                       # no step but the first is sure to be inside
    return [rng.choice(_steps(size), n, replace=False).tolist() for _ in range(TABLES)]


def _walk(words: np.ndarray, begin: np.ndarray, end: np.ndarray, size: int, walk: int) -> tuple[np.ndarray, np.ndarray]:
    """(words written out, whether each is inside) by step, of walks from ``begin``."""
    n, at = _steps(size), begin.copy()
    out, inside = np.empty((n, len(begin)), np.uint64), np.empty((n, len(begin)), bool)
    for step in range(n):
        inside[step] = at < end
        out[step] = words[np.minimum(at, len(words) - 1)]
        at += (mix(out[step] ^ _SEEDS[walk]) >> np.uint64(step) & np.uint64(1)).astype(np.int64)
    return out, inside


def _keys(out: np.ndarray, inside: np.ndarray, columns: list[int]) -> tuple[np.ndarray, np.ndarray]:
    key = np.zeros(out.shape[1], np.uint64)
    for c in columns:
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + out[c])
    return key, inside[columns].all(axis=0)


class _Segments:
    """Segments of one size that allow as many edits: their gram screen and tables."""

    def __init__(self, size: int, edits: int, words: np.ndarray, begin: np.ndarray, items: np.ndarray):
        self.size, self.edits = size, edits
        self.width = min(GRAM, size // (edits + 1))
        #: Grams that are left of a segment, whatever the edits.
        self.need = size - self.width + 1 - self.width * edits
        within = (begin[:, None] + np.arange(size)).ravel()
        grams = _grams(words[within], self.width)
        # Grams that reach from one segment into the next are none.
        self.grams = np.unique(grams[np.arange(len(grams)) % size <= size - self.width])
        self.present = np.zeros(1 << _FILTER_BITS, bool)
        self.present[self.grams & np.uint64((1 << _FILTER_BITS) - 1)] = True
        self.tables = []
        for walk in range(WALKS):
            out, inside = _walk(words, begin, begin + size, size, walk)
            own = []
            for columns in _samples(size, walk):
                key, good = _keys(out, inside, columns)
                order = np.argsort(key[good], kind="stable")
                own.append((columns, key[good][order], items[good][order]))
            self.tables.append(own)

    def places(self, words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Places at which a segment could begin."""
        grams = _grams(words, self.width)
        at = np.flatnonzero(self.present[grams & np.uint64((1 << _FILTER_BITS) - 1)])
        spot = np.searchsorted(self.grams, grams[at])
        spot[spot == len(self.grams)] = 0
        at = at[self.grams[spot] == grams[at]] if len(self.grams) else at[:0]
        at = at[np.searchsorted(offsets, at, side="right") == np.searchsorted(offsets, at + self.width - 1, side="right")]
        if len(at) < self.need:
            return at[:0]
        known = np.zeros(len(words) + 1, np.int64)
        known[at + 1] = 1
        known = np.cumsum(known)
        # A place whose window holds enough known grams; windows end with the run.
        reach = np.minimum(np.arange(len(words)) + self.size + self.edits - self.width + 1, len(words))
        return np.flatnonzero(known[reach] - known[:-1] >= self.need)

    def meet(self, words: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
        """(text, item) pairs that agree in a table."""
        at = self.places(words, offsets)
        for a in range(0, len(at), SLICE):
            begin = at[a:a + SLICE]
            text = np.searchsorted(offsets, begin, side="right") - 1
            for walk, tables in enumerate(self.tables):
                out, inside = _walk(words, begin, offsets[text + 1], self.size, walk)
                for columns, keys, items in tables:
                    key, good = _keys(out, inside, columns)
                    low = np.searchsorted(keys, key)
                    count = np.where(good, np.searchsorted(keys, key, side="right") - low, 0)
                    if count.any():
                        which = np.repeat(low, count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
                        yield np.unique(np.stack([np.repeat(text, count), items[which]], axis=1), axis=0)


def _words(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, word hashes, offsets of the texts) per run."""
    data, offsets = text_bytes(column)
    a, n = 0, len(offsets) - 1
    while a < n:
        b = min(n, max(a + 1, int(np.searchsorted(offsets, offsets[a] + RUN_BYTES, side="right")) - 1))
        starts, _, h = words_of(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], NOT_ALNUM)
        yield a, h, np.searchsorted(starts, offsets[a:b + 1] - offsets[a])
        a = b


def _grams(words: np.ndarray, width: int) -> np.ndarray:
    h = np.full(max(0, len(words) - width + 1), np.uint64(width))
    for i in range(width):
        h = mix(h + words[i:len(words) - width + 1 + i])
    return h


def edit_distance_inside(item: list[int], words: list[int]) -> tuple[int, int]:
    """(least edits that turn ``item`` into a run of ``words``, end of the first
    such run), by Myers' bit vectors over numbers of any length."""
    n = len(item)
    full, top = (1 << n) - 1, 1 << (n - 1)
    places: dict[int, int] = {}
    for i, w in enumerate(item):
        places[w] = places.get(w, 0) | 1 << i
    plus, minus, now = full, 0, n
    best, end = n, 0
    for j, w in enumerate(words):
        eq = places.get(w, 0)
        x = eq | minus
        diagonal = (((eq & plus) + plus) ^ plus) | eq
        up, down = minus | ~(diagonal | plus) & full, plus & diagonal
        now += bool(up & top) - bool(down & top)
        up, down = up << 1 & full, down << 1 & full
        plus, minus = down | ~(x | up) & full, up & x
        if now < best:
            best, end = now, j + 1
    return best, end


@dataclass
class Index:
    """The items of one part of the benchmark."""
    item_ids: list
    words: list[np.ndarray]

    def __post_init__(self):
        self.size = np.array([len(w) for w in self.words], np.int64)
        self.edits = np.where(self.size >= GRAM, np.floor(MAX_EDITS * self.size), 0).astype(np.int64)
        #: Grams so short that one at least survives any d edits.
        self.width = np.minimum(GRAM, self.size // (self.edits + 1))
        self.need = np.maximum(1, self.size - (self.width - 1) - self.width * self.edits)
        #: By gram width (3, less for the shortest items): hashes, items, offsets.
        self.tables = {}
        for width in sorted(set(self.width.tolist()) - {0}):
            which = np.flatnonzero(self.width == width).tolist()
            grams = [_grams(self.words[i], width) for i in which]
            hashes = np.concatenate(grams)
            items = np.repeat(which, [len(g) for g in grams])
            at = np.concatenate([np.arange(len(g)) for g in grams])
            order = np.argsort(hashes, kind="stable")
            present = np.zeros(1 << _FILTER_BITS, bool)
            present[hashes & np.uint64((1 << _FILTER_BITS) - 1)] = True
            self.tables[width] = (hashes[order], items[order], at[order], present)

        self.segments = self._cut()

    def _cut(self) -> list[_Segments]:
        words = np.concatenate([*self.words, np.empty(0, np.uint64)])
        first, groups = np.cumsum(self.size) - self.size, {}
        for item, n in enumerate(self.size.tolist()):
            m = -(-n // SEGMENT)
            ends = [n * i // m for i in range(m + 1)]
            for a, b in zip(ends[:-1], ends[1:]):
                groups.setdefault((b - a, int(self.edits[item]) // m), []).append((int(first[item]) + a, item))
        return [_Segments(size, edits, words, *np.array(own, np.int64).T) for (size, edits), own in sorted(groups.items())]

    def candidates(self, words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(text, item) pairs whose walks agree in a table, sorted."""
        found = [pairs for segments in self.segments for pairs in segments.meet(words, offsets)] if len(words) else []
        return np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 2), np.int64)

    def windows(self, words: np.ndarray, offsets: np.ndarray):
        """(item, diagonal) wherever enough grams of the item meet, sorted."""
        out = []
        for width, (hashes, items, at, present) in self.tables.items():
            grams = _grams(words, width)
            place = np.flatnonzero(present[grams & np.uint64((1 << _FILTER_BITS) - 1)])
            # A gram must not reach into the next text.
            place = place[np.searchsorted(offsets, place, side="right") == np.searchsorted(offsets, place + width - 1, side="right")]
            low = np.searchsorted(hashes, grams[place])
            count = np.searchsorted(hashes, grams[place], side="right") - low
            if not count.sum():
                continue
            hit = np.repeat(low, count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
            where = np.repeat(place, count)
            item, diagonal = items[hit], where - at[hit]
            span = int(max(len(words), 1) + 4 * self.size.max() + 8)
            key = item * span + diagonal + 2 * int(self.size.max())
            order = np.argsort(key, kind="stable")
            key, item, diagonal, where = key[order], item[order], diagonal[order], where[order]
            # Hits on diagonals up to 2 d to the right: one leak has them all there.
            reach = np.searchsorted(key, key + 2 * self.edits[item], side="right") - np.arange(len(key))
            good = np.flatnonzero(reach >= self.need[item])
            if len(good):
                # Every diagonal of such a group gets a window.
                cover = np.zeros(len(key) + 1, np.int64)
                np.add.at(cover, good, 1)
                np.add.at(cover, good + reach[good], -1)
                inside = np.cumsum(cover[:-1]) > 0
                rows = np.unique(np.stack([item[inside], diagonal[inside], np.searchsorted(offsets, where[inside], side="right") - 1],
                                          axis=1), axis=0)
                out.append(rows)
        return np.concatenate(out) if out else np.empty((0, 3), np.int64)

    def leaks(self, words: np.ndarray, offsets: np.ndarray) -> dict[tuple[int, int], tuple[int, int]]:
        """(text, item) to (edits, first word) of its best leak."""
        found: dict[tuple[int, int], tuple[int, int]] = {}
        pairs = self.candidates(words, offsets)
        if not len(pairs):
            return found
        rows = self.windows(words, offsets)
        n = len(self.size)
        rows = rows[np.isin(rows[:, 2] * n + rows[:, 0], pairs[:, 0] * n + pairs[:, 1])]
        last: dict[tuple[int, int], int] = {}
        for item, start, text in rows.tolist():                   # by item, then place
            if last.get((text, item), start - 1) >= start:        # inside the last region
                continue
            n, most, own = int(self.size[item]), int(self.edits[item]), self.words[item].tolist()
            low, high = int(offsets[text]), int(offsets[text + 1])
            a, b = max(low, start - 2 * most), min(high, start + n + 2 * most)
            edits, end = edit_distance_inside(own, words[a:b].tolist())
            last[text, item] = start + most
            if edits <= most:
                begin = a + end - _reversed_length(own, words[a:a + end].tolist())
                found[text, item] = min(found.get((text, item), (n + 1, 0)), (edits, begin - low))
        return found


def _reversed_length(item: list[int], words: list[int]) -> int:
    """Words of the shortest run that ends at the end of ``words`` and is as near
    to the item as any run that ends there."""
    n = len(item)
    row, best, length = list(range(n + 1)), n, 0
    for j, w in enumerate(reversed(words[-2 * n - 2:]), 1):
        last, row = row, [j]
        for i in range(n):
            row.append(min(last[i] + (item[n - 1 - i] != w), last[i + 1] + 1, row[i] + 1))
        if row[n] < best:
            best, length = row[n], j
    return length


def _parts(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[Index]:
    """Indexes of bounded size over all items."""
    items = benchmark.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).where("text is not null")
    chars = items.agg(F.sum(F.length("text"))).head()[0] or 0
    n_parts = max(1, -(-2 * chars // PART_CHARS) if chars > PART_CHARS else 1)
    for part in range(n_parts):
        rows = items.where(F.pmod(F.xxhash64("text"), F.lit(n_parts)) == part).collect()
        rows.sort(key=lambda r: (r["id"] is None, r["id"] or 0, r["text"]))
        words = [h for _, run, at in _words(pa.array([r["text"] for r in rows], pa.string()))
                 for h in (run[at[i]:at[i + 1]] for i in range(len(at) - 1))]
        keep = [i for i, w in enumerate(words) if len(w)]
        if keep:
            yield Index([rows[i]["id"] for i in keep], [words[i] for i in keep])


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id, item, edits, item_words, first_word) for every document and item that
    it leaks."""
    kinds = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    schema = f"`{id_col}` {kinds[0]}, `{item_col}` {kinds[1]}, edits int, item_words int, first_word int"
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    out = None
    for index in _parts(benchmark, item_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast((index.item_ids, index.words))

        def search(batches, shared=shared):
            own = Index(*shared.value)
            for batch in batches:
                found = [(batch.column(0)[first + t], own.item_ids[i], e, int(own.size[i]), at)
                         for first, words, offsets in _words(batch.column(1))
                         for (t, i), (e, at) in sorted(own.leaks(words, offsets).items())]
                if found:
                    yield _records(found, id_col, item_col)

        part = rows.mapInArrow(search, schema)
        out = part if out is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def _records(found, id_col, item_col) -> pa.RecordBatch:
    ids, items, edits, sizes, at = zip(*found, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array([x.as_py() for x in ids], ids[0].type), pa.array(items), pa.array(edits, pa.int32()),
         pa.array(sizes, pa.int32()), pa.array(at, pa.int32())], [id_col, item_col, "edits", "item_words", "first_word"])


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text") -> DataFrame:
    """The documents that leak no item, with all their columns: the text alone goes
    to Python, and its decision comes back."""
    for index in _parts(benchmark, item_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast((index.item_ids, index.words))

        docs = docs.where(_clean(shared)(F.col(f"`{text_col}`")))
    return docs


def _clean(shared):
    @F.arrow_udf("boolean")
    def clean(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Index(*shared.value)
        for column in texts:
            bad = np.zeros(len(column), bool)
            for first, words, offsets in _words(column):
                for t, _ in own.leaks(words, offsets):
                    bad[first + t] = True
            yield pa.array(~bad)
        release()

    return clean
