"""N-gram Jaccard join: documents whose sets of word shingles overlap enough.

A T-occurrence search in two steps.

1. *Short lists.*  Every document sends out its rarest shingles: of n shingles
   it must share T = ceil(0.8 n) with any partner, so a partner shares at least
   k of its first n - T + k in any common order.  The order is by a bounded table
   of frequent words (a shingle is as rare as its rarest word), then by hash; a
   first pass finds the lists that are long all the same, and their shingles go
   last (a bounded table again).  So passages that many documents share come
   last, and just copies have long lists.  Equal shingles meet, a list
   of up to ``SHORT_LIST`` documents gives its pairs of fitting size, and pairs
   that meet k times stay.  A longer list is not paired: its members are just
   tied to one of them.  Pairs and ties make *families*, which hold every link.
2. *DivideSkip inside a family.*  The documents of a family come together, by
   text.  Frequent shingles of the family become bit rows; the others keep
   inverted lists, which are merged by counting; only documents whose count can
   still reach the threshold are probed in the bit rows.  Documents that are
   already in one component are not compared, so a group of n copies costs no n
   squared.  What leaves a task are the components of its links, as stars.

A family too large for one task is cut into blocks and every two blocks meet.
Documents with equal sets are one class from the start (128-bit digest), and
each run of texts sends out a shingle that many of its own documents share just
once, so neither exact nor near copies pile up on one key.  The components of
all links come from star contraction.

Defined cases: null and empty texts, and texts without words, have an empty set
and are linked with nothing; with fewer words than a shingle the whole sequence
is the one shingle; repeated rows are copies; rows that share an id count as one
document, linked with all that any of its texts is linked with, and have one
component; rows with a null id are returned with a null component and link
nothing; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.session import materialize

from .common import numbered, release
from .components import connected_components, stars
from .shingles import WIDTH, runs_of_texts, shingle_hashes

THRESHOLD = 80                 # percent
OVERLAP = 8                    # k: shared rare shingles that make a candidate
SHORT_LIST = 32
FREQUENT_WORDS = 1 << 16       # entries of the order's table: 1 MB at most
BLOCK_DOCS, BLOCK_SHINGLES = 8192, 8_000_000
MAX_BROADCAST_ROWS = 1_000_000
ORDER_ROUNDS = 1               # passes that look for shingles shared by many
COMMON_SHINGLES = 1 << 18      # entries of their table: 2 MB at most
SURE = 1 << 20                 # weight of a tie
SCAN_SCHEMA = "doc_id long, n int, s1 long, s2 long, word long, uses long"


def needed(n: np.ndarray | int):
    """Least overlap with any partner of a set of n."""
    return -(-THRESHOLD * n // 100)


def digest(shingles: np.ndarray) -> tuple[int, int]:
    import xxhash
    value = xxhash.xxh3_128_intdigest(shingles.tobytes())
    a, b = value & (1 << 64) - 1, value >> 64
    return a - (1 << 64) * (a >> 63), b - (1 << 64) * (b >> 63)


def shingle_set(words: np.ndarray) -> np.ndarray:
    return np.unique(shingle_hashes(words, WIDTH))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document (n, digest) and rows of word counts, summed per task;
    of a task's words those stay that are among its most frequent."""
    counts = _WordCounts()
    for batch in batches:
        ids, out = batch.column(0), []
        for _, hashes, at in runs_of_texts(batch.column(1)):
            counts.add(hashes)
            for i in range(len(at) - 1):
                s = shingle_set(hashes[at[i]:at[i + 1]])
                out.append((len(s), *(digest(s) if len(s) else (None, None))))
        n, s1, s2 = zip(*out, strict=True) if out else ((), (), ())
        yield _batch(SCAN_TYPES, doc_id=ids, n=n, s1=s1, s2=s2)
    words, uses = counts.most(FREQUENT_WORDS)
    yield _batch(SCAN_TYPES, word=words.view(np.int64), uses=uses)
    release()


class _WordCounts:
    """Counts of a task's words in bounded memory: when it holds too many, those
    used least go.  Only an order of shingles hangs on it, no result."""

    def __init__(self):
        self.words, self.uses, self.fresh, self.n = np.empty(0, np.uint64), np.empty(0, np.int64), [], 0

    def add(self, hashes: np.ndarray) -> None:
        self.fresh.append(hashes)
        self.n += len(hashes)
        if self.n > 1_000_000:
            self._merge()

    def _merge(self) -> None:
        words, uses = np.unique(np.concatenate([*self.fresh, self.words[:0]]), return_counts=True)
        merged, place = np.unique(np.concatenate([self.words, words]), return_inverse=True)
        self.uses = np.bincount(place, weights=np.concatenate([self.uses, uses]), minlength=len(merged)).astype(np.int64)
        self.words, self.fresh, self.n = merged, [], 0
        if len(merged) > 16 * FREQUENT_WORDS:
            self.words, self.uses = _most(self.words, self.uses, 8 * FREQUENT_WORDS)

    def most(self, k: int):
        self._merge()
        return _most(self.words, self.uses, k)


def _most(words, uses, k):
    if len(words) <= k:
        return words, uses
    stay = np.sort(np.argsort(-uses, kind="stable")[:k])
    return words[stay], uses[stay]


SCAN_TYPES = [("doc_id", pa.int64()), ("n", pa.int32()), ("s1", pa.int64()), ("s2", pa.int64()),
              ("word", pa.int64()), ("uses", pa.int64())]


def _batch(types, **columns) -> pa.RecordBatch:
    size = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[n], t) if n in columns else pa.nulls(size, t) for n, t in types], [n for n, _ in types])


def scan(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, tuple[np.ndarray, np.ndarray]]:
    """(documents with n and digest, the order's table of frequent words)."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    both = materialize(rows.mapInArrow(_scan, SCAN_SCHEMA), "shingle-scan")
    top = (both.where("word is not null").groupBy("word").agg(F.sum("uses").alias("uses"))
           .orderBy(F.desc("uses"), "word").limit(FREQUENT_WORDS).collect())
    words = np.array([r["word"] for r in top], np.int64).view(np.uint64)
    order = np.argsort(words)
    level = np.array([r["uses"].bit_length() for r in top], np.int64)
    return both.where("word is null").select("doc_id", "n", "s1", "s2"), (words[order], level[order])


class Order:
    """The common order: shingles known to be shared by many documents last, then
    by the level of their rarest word, then by hash.  Any order is right; this
    one keeps the lists short."""

    def __init__(self, words: np.ndarray, levels: np.ndarray, common: np.ndarray):
        self.words, self.levels, self.common = words, levels, common      # sorted
        self.present = np.zeros(1 << 22, bool)
        self.present[common & np.uint64((1 << 22) - 1)] = True

    def word_levels(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(hashes), np.int64)
        place = np.searchsorted(self.words, hashes)
        place[place == len(self.words)] = 0
        return np.where(self.words[place] == hashes, self.levels[place], 0)

    def is_common(self, shingles: np.ndarray) -> np.ndarray:
        out = self.present[shingles & np.uint64((1 << 22) - 1)]
        some = np.flatnonzero(out)
        if len(some):
            place = np.searchsorted(self.common, shingles[some])
            place[place == len(self.common)] = 0
            out[some] = self.common[place] == shingles[some]
        return out


def rare_shingles(words: np.ndarray, levels: np.ndarray, order: Order) -> tuple[np.ndarray, np.ndarray]:
    """(whole set, its rarest shingles by the common order) of one text."""
    hashes = shingle_hashes(words, WIDTH)
    if len(words) >= WIDTH:
        level = np.lib.stride_tricks.sliding_window_view(levels, WIDTH).min(axis=1)
    else:
        level = levels.min(keepdims=True)
    whole, at = np.unique(hashes, return_index=True)
    least = needed(len(whole))
    size = len(whole) - least + min(OVERLAP, least)
    level = level[at] + 64 * order.is_common(whole)
    # Hashes are sorted already, so a stable sort by level is the common order.
    return whole, whole[np.argsort(level, kind="stable")[:size]]


def _postings(table):
    """Rows (h, node, n) of rare shingles; with a null h, ties (node, tie)."""
    order = Order(*table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for first, hashes, at in runs_of_texts(batch.column(0)):
                level = order.word_levels(hashes)
                rare, nodes, sizes = [], [], []
                for i in range(len(at) - 1):
                    if at[i] == at[i + 1]:
                        continue
                    whole, own = rare_shingles(hashes[at[i]:at[i + 1]], level[at[i]:at[i + 1]], order)
                    node = digest(whole)[0]
                    if node not in seen:
                        if len(seen) < 1_000_000:
                            seen.add(node)
                        rare.append(own)
                        nodes.append(node)
                        sizes.append(len(whole))
                if rare:
                    yield _local_lists(rare, np.array(nodes, np.int64), np.array(sizes, np.int32))

    return run


POSTING_SCHEMA = "h long, node long, n int, tie long"
POSTING_TYPES = [("h", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("tie", pa.int64())]


def _local_lists(rare, nodes, sizes) -> pa.RecordBatch:
    """Postings of a run; a list that is long within the run sends one posting
    marked long (n = 0) and ties its members to it."""
    count = np.fromiter(map(len, rare), np.int64, len(rare))
    h, who = np.concatenate(rare), np.repeat(np.arange(len(rare)), count)
    order = np.argsort(h, kind="stable")
    h, who = h[order], who[order]
    start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    size = np.diff(np.append(start, len(h)))
    in_long = np.repeat(size > SHORT_LIST, size)
    head = np.repeat(who[start], size)
    tied = np.unique(np.stack([head[in_long], who[in_long]], axis=1), axis=0)
    tied = tied[tied[:, 0] != tied[:, 1]]
    keep = ~in_long
    keep[start] = True
    n = np.where(in_long, 0, sizes[who])[keep]
    posted, ties = int(keep.sum()), len(tied)
    return pa.RecordBatch.from_arrays([
        pa.array(np.concatenate([h[keep].view(np.int64), np.zeros(ties, np.int64)]),
                 mask=np.arange(posted + ties) >= posted),
        pa.array(np.concatenate([nodes[who[keep]], nodes[tied[:, 1]]])),
        pa.array(np.concatenate([n, np.zeros(ties)]).astype(np.int32)),
        pa.array(np.concatenate([np.zeros(posted, np.int64), nodes[tied[:, 0]]]),
                 mask=np.arange(posted + ties) < posted)], [name for name, _ in POSTING_TYPES])


PAIR_SCHEMA = "u long, v long, k int, weight int"


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted postings to weighted pairs: u < v, the overlap k they must show and
    what this list adds to it.  Only short lists are held; a long one ties each
    member to its first as the rows come."""
    held: list[tuple[np.ndarray, ...]] = []     # the last list, its end still unknown
    for batch in batches:
        h = batch.column(0)
        is_tie = np.asarray(h.is_null())
        node, n = np.asarray(batch.column(1)), np.asarray(batch.column(2))
        if is_tie.any():
            yield _ties(np.asarray(batch.column(3).fill_null(0))[is_tie], node[is_tie])
        h = np.asarray(h.fill_null(0))[~is_tie]
        rows = [h, node[~is_tie], n[~is_tie]]
        if held:
            rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
        if not len(rows[0]):
            continue
        last = rows[0] == rows[0][-1]
        held = [x[last] for x in rows]
        if len(held[0]) > 4 * SHORT_LIST:           # certainly long: tie it now
            yield _ties(np.full(last.sum() - 1, held[1][0]), held[1][1:])
            held = [held[0][:1], held[1][:1], np.zeros(1, np.int32)]
        yield from _lists(*(x[~last] for x in rows))
    if held:
        yield from _lists(*held)
    release()


def _ties(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return _pair_batch(a, b, np.ones(len(a)), np.full(len(a), SURE))


def _pair_batch(a, b, k, weight) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array(np.minimum(a, b).astype(np.int64)), pa.array(np.maximum(a, b).astype(np.int64)),
        pa.array(k.astype(np.int32)), pa.array(weight.astype(np.int32))], ["u", "v", "k", "weight"])


def _lists(h, node, n) -> Iterator[pa.RecordBatch]:
    """Whole lists, sorted by (h, node)."""
    if len(h) < 2:
        return
    marked = n == 0
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (node[1:] != node[:-1])])
    start_of = np.cumsum(np.concatenate([[True], h[1:] != h[:-1]])) - 1
    any_mark = np.bincount(start_of, weights=marked) > 0
    h, node, n, start_of = h[new], node[new], n[new], start_of[new]
    size = np.bincount(start_of, minlength=len(any_mark))
    start = np.cumsum(size) - size
    long = any_mark | (size > SHORT_LIST)
    in_long = long[start_of]
    first = node[start][start_of]
    if in_long.any():
        yield _ties(first[in_long], node[in_long])
    least = needed(n.astype(np.int64))
    k = np.minimum(OVERLAP, least)
    for gap in range(1, SHORT_LIST):
        a = np.flatnonzero((start_of[:-gap] == start_of[gap:]) & ~in_long[:-gap]) if gap < len(h) else []
        if not len(a):
            break
        b = a + gap
        fits = np.minimum(n[a], n[b]) >= np.maximum(least[a], least[b])
        a, b = a[fits], b[fits]
        if len(a):
            yield _pair_batch(node[a], node[b], np.minimum(k[a], k[b]), np.ones(len(a)))


def divide_skip(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """A spanning forest of the links between sorted shingle sets."""
    m = len(sets)
    order = np.argsort([len(s) for s in sets], kind="stable")
    size = np.array([len(sets[i]) for i in order], np.int64)
    _, token, uses = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True, return_counts=True)
    doc = np.repeat(np.arange(m), size)
    shared = uses[token] > 1
    token, doc = token[shared], doc[shared]
    # Long lists: bits per document; short ones: inverted lists.
    is_long = uses > max(64, m // 16)
    slot = np.cumsum(is_long) - 1
    in_long = is_long[token]
    bits = np.zeros((m, int(is_long.sum()) + 63 >> 6), np.uint64)
    at = slot[token[in_long]]
    np.bitwise_or.at(bits, (doc[in_long], at >> 6), np.uint64(1) << (at & 63).astype(np.uint64))
    n_long = np.bincount(doc[in_long], minlength=m)
    token, doc = token[~in_long], doc[~in_long]
    own = np.searchsorted(doc, np.arange(m + 1))            # a document's short tokens
    by_token = np.argsort(token, kind="stable")
    posted, lists = doc[by_token], np.searchsorted(token[by_token], np.arange(len(uses) + 1))
    component, links = np.arange(m), []
    least = needed(size)
    for r in range(1, m):
        low = int(np.searchsorted(size, least[r]))           # smaller ones can't reach it
        rest = low + np.flatnonzero(component[low:r] != component[r])
        if not len(rest):
            continue
        mine = token[own[r]:own[r + 1]]
        if len(mine):
            hits = np.concatenate([posted[lists[t]:lists[t + 1]] for t in mine])
            count = np.bincount(hits[hits < r], minlength=r)[rest]
        else:
            count = np.zeros(len(rest), np.int64)
        able = count + np.minimum(n_long[r], n_long[rest]) >= least[r]
        rest, count = rest[able], count[able]
        if not len(rest):
            continue
        overlap = count + np.bitwise_count(bits[rest] & bits[r]).sum(axis=1, dtype=np.int64)
        for j in rest[100 * overlap >= THRESHOLD * (size[r] + size[rest] - overlap)]:
            if component[j] != component[r]:
                links.append((int(order[j]), int(order[r])))
                a, b = component[j], component[r]
                component[component == max(a, b)] = min(a, b)
    return links


def _family_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (unit, node, s1, s2, text), sorted by unit, to the components of the
    unit's links, as stars."""
    unit, nodes, sets = None, [], []

    def links():
        found = np.array(divide_skip(sets) if len(sets) > 1 else [], np.int64).reshape(-1, 2)
        u, v = stars(*np.array(nodes, np.int64)[found].T)
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    for batch in batches:
        units, node = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        wanted = list(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True))
        for first, hashes, at in runs_of_texts(batch.column(4)):
            for i in range(len(at) - 1):
                row = first + i
                if units[row] != unit:
                    yield links()
                    unit, nodes, sets = units[row], [], []
                own = shingle_set(hashes[at[i]:at[i + 1]])
                # Of rows that share an id, only the class asked for counts.
                if len(own) and digest(own) == wanted[row]:
                    nodes.append(node[row])
                    sets.append(own)
    yield links()


def _bounded(df: DataFrame, limit: int = MAX_BROADCAST_ROWS) -> DataFrame:
    return F.broadcast(df) if df.count() <= limit else df


def _sorted_postings(texts: DataFrame, table) -> DataFrame:
    # At most FREQUENT_WORDS words and COMMON_SHINGLES shingles.
    shared = texts.sparkSession.sparkContext.broadcast(table)

    def postings(batches):
        yield from _postings(shared.value)(batches)
        release()

    return (texts.mapInArrow(postings, POSTING_SCHEMA).repartition("h", F.when(F.col("h").isNull(), F.col("node")))
            .sortWithinPartitions("h", "node"))


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, size) of the long lists in sorted postings; a marked row stands for
    a list that is long by itself."""
    now, size = None, 0
    for batch in batches:
        h, n = batch.column(0), np.asarray(batch.column(2))
        there = ~np.asarray(h.is_null())
        h, n = np.asarray(h.fill_null(0))[there], n[there]
        if not len(h):
            continue
        start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        sizes = np.add.reduceat(np.where(n == 0, SHORT_LIST + 1, 1), start)
        heads = h[start]
        if now is not None:
            if heads[0] == now:
                sizes[0] += size
            elif size > SHORT_LIST:
                yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([size])], ["h", "size"])
        now, size = int(heads[-1]), int(sizes[-1])
        long = np.flatnonzero(sizes[:-1] > SHORT_LIST)
        yield pa.RecordBatch.from_arrays([pa.array(heads[long]), pa.array(sizes[long].astype(np.int64))], ["h", "size"])
    if now is not None and size > SHORT_LIST:
        yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([size])], ["h", "size"])


def _long_lists(texts: DataFrame, table) -> np.ndarray:
    """Shingles whose lists are longest, COMMON_SHINGLES at most."""
    top = (_sorted_postings(texts, table).mapInArrow(_sizes, "h long, size long")
           .orderBy(F.desc("size"), "h").limit(COMMON_SHINGLES).collect())
    return np.sort(np.array([r["h"] for r in top], np.int64).view(np.uint64))


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) per document."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    known, words = scan(docs, id_col, text_col)
    texts = rows.where("doc_id is not null").select("text")
    common = np.empty(0, np.uint64)
    for _ in range(ORDER_ROUNDS):
        common = np.union1d(common, _long_lists(texts, (*words, common)))
    candidates = (_sorted_postings(texts, (*words, common)).mapInArrow(_pairs, PAIR_SCHEMA).groupBy("u", "v")
                  .agg(F.min("k").alias("k"), F.sum("weight").alias("weight")).where("weight >= k").select("u", "v"))
    families = connected_components(candidates, "families")

    # A class is all documents of one digest; its smallest id stands for it.
    classes = materialize(known.where("doc_id is not null and s1 is not null").groupBy("s1", "s2", "n")
                          .agg(F.min("doc_id").alias("first_id")), "classes")
    members = materialize(classes.join(families, F.col("s1") == F.col("node"))
                          .select(F.col("component").alias("family"), "s1", "s2", "n", "first_id"), "members")
    sizes = members.groupBy("family").agg(F.count("*").alias("docs"), F.sum("n").alias("shingles")).where("docs > 1")
    blocks = F.greatest(F.ceil(F.col("docs") / BLOCK_DOCS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    placed = (members.join(sizes.withColumn("blocks", blocks).select(F.col("family").alias("f"), "blocks"),
                           F.col("family") == F.col("f"))
              .withColumn("block", F.pmod(F.xxhash64("s2"), F.col("blocks")).cast("int")))
    others = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: b != F.col("block")))
    units = placed.select("family", "block", "s1", "s2", "first_id", F.explode(others).alias("other")).select(
        F.concat_ws(":", "family", F.least("block", "other"), F.greatest("block", "other")).alias("unit"),
        "s1", "s2", F.col("first_id").alias("node"))
    found = (rows.join(_bounded(units), F.col("doc_id") == F.col("node"))
             .select("unit", "node", "s1", "s2", "text")
             .repartition("unit").sortWithinPartitions("unit", "s1", "s2", "node"))
    links = found.mapInArrow(_family_links, "u long, v long")
    several = materialize(_several_texts(known), "several-texts")
    # The texts of one id are linked by it.
    own = known.join(several, "doc_id").join(classes.select("s1", "s2", "first_id"), ["s1", "s2"]).select("doc_id", "first_id")
    tied = own.join(own.groupBy("doc_id").agg(F.min("first_id").alias("least")), "doc_id").where("first_id <> least")
    links = links.unionByName(tied.select(F.col("first_id").alias("u"), F.col("least").alias("v")))
    components = connected_components(links, "components")

    class_of = classes.join(components, F.col("first_id") == F.col("node"), "left").select(
        F.col("s1").alias("c1"), F.col("s2").alias("c2"), F.coalesce("component", "first_id").alias("component"))
    # A row without words has the component that the id has by its other texts.
    of_id = own.join(components, F.col("first_id") == F.col("node"), "left").groupBy(F.col("doc_id").alias("id")).agg(
        F.min(F.coalesce("component", "first_id")).alias("by_id"))
    labelled = (known.join(class_of, (F.col("s1") == F.col("c1")) & (F.col("s2") == F.col("c2")), "left")
                .join(_bounded(materialize(of_id, "component-of-id")), F.col("doc_id") == F.col("id"), "left"))
    return labelled.select(
        F.col("doc_id").alias(id_col), F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("by_id", "component", "doc_id")).alias("component_id"))


def _several_texts(known: DataFrame) -> DataFrame:
    """Ids that have rows of different sets (a set without words is one too)."""
    ends = [e(F.coalesce(c, F.lit(0))).alias(f"{name}_{c}") for c in ("s1", "s2") for name, e in (("low", F.min), ("high", F.max))]
    ends += [F.min("n").alias("low_n"), F.max("n").alias("high_n")]
    return (known.where("doc_id is not null").groupBy("doc_id").agg(*ends)
            .where("low_s1 <> high_s1 or low_s2 <> high_s2 or low_n <> high_n").select("doc_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay: of every component the one with the smallest id."""
    names = docs.columns
    docs, (id_col, text_col) = numbered(docs, id_col, text_col)
    found = materialize(jaccard_join(docs, id_col, text_col).where(f"{id_col} <> component_id")
                        .select(F.col(id_col).alias("gone")).distinct(), "near-copies")
    return docs.join(_bounded(found), F.col(id_col) == F.col("gone"), "left_anti").toDF(*names)
