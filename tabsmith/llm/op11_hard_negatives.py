"""Hard negatives by Fagin's threshold algorithm.

Components become whole numbers, floor(256 x), so that scores are exact.  Rows
are packed into blocks that hold, for every dimension, the order of their rows
by it.  For an anchor the lists are read from the end that its sign asks for,
all dimensions a step deeper at a time; a row met for the first time is scored
at once (random access to its whole vector).  What is unseen can score no more
than the threshold, the sum over dimensions of the anchor's component times the
last value read there.  A block is left once the threshold is strictly below the
k-th score of every window that is asked for (or below the window's end, where
it holds fewer), so ties are never cut.

Two passes: the anchors' best rows of their own label (one window without
bounds), then for each of these positives the best rows of other labels whose
score lies between two shares of the positive's.  A task holds a group of blocks
and streams all anchors past it, their best so far carried from block to block;
groups are made of rows dealt by a hash, so no label, vector or id is a key.
The best of the groups are merged by one ranked window: k rows a group at most.

Defined cases: rows with a null id or label, a null vector or a null or
non-finite component take no part; vectors of one length are mined among their
own kind; rows that repeat an id all count as candidates (equal rows too), but
none that shares the anchor's id does, and each different row of an anchor's id
is mined by itself; components beyond a long stop at its ends, and so do scores
on return; a zero anchor scores 0 with all; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.session import materialize

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95                  # percent of the positive's score
#: Rows of a block, blocks that a task holds, anchors packed together, first depth read.
BLOCK, HELD, ANCHORS, DEPTH = 4096, 16, 512, 16
#: kind 0: candidates; kind 1: anchors, who come behind the candidates of their group.
BLOCK_SCHEMA = "dim int, block long, n int, ids binary, labels binary, vectors binary, lists binary"
LONG = np.iinfo(np.int64)


def usable(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def _matrix(vectors: pd.Series, dim: int) -> np.ndarray:
    return np.array(vectors.tolist(), np.int64).reshape(len(vectors), dim)


def _pack(with_lists: bool):
    def pack(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("id")
        vectors = _matrix(part["vector"], int(key[0]))
        lists = np.argsort(vectors, axis=0, kind="stable").T.astype(np.uint32).tobytes() if with_lists else b""
        return pd.DataFrame({"dim": [key[0]], "block": [key[1]], "n": [len(part)],
                             "ids": [part["id"].to_numpy(np.int64).tobytes()],
                             "labels": [part["label"].to_numpy(np.int64).tobytes()],
                             "vectors": [vectors.tobytes()], "lists": [lists]})

    return pack


class Block:
    """Rows of a block and their lists: ``order[d]`` holds the rows by rising
    component d, ``sorted[d]`` these components."""

    def __init__(self, ids, labels, vectors, order):
        self.ids, self.labels, self.vectors, self.order = ids, labels, vectors, order
        self.sorted = np.take_along_axis(vectors.T, order.astype(np.int64), axis=1)
        self.top = int(max(abs(int(vectors.max(initial=0))), abs(int(vectors.min(initial=0)))))
        self.kinds: dict[type, tuple[np.ndarray, np.ndarray]] = {}

    def as_kind(self, kind: type) -> tuple[np.ndarray, np.ndarray]:
        if kind not in self.kinds:
            self.kinds[kind] = self.vectors.astype(kind), self.sorted.astype(kind)
        return self.kinds[kind]


class Best:
    """The k best (score, id) of a window low <= score <= high."""

    def __init__(self, k: int, low: int | None = None, high: int | None = None):
        self.k, self.low, self.high = k, low, high
        self.scores: list[int] = []
        self.ids: list[int] = []

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        stay = np.ones(len(scores), bool)
        if self.low is not None:
            stay = (scores >= self.low) & (scores <= self.high)
        if len(self.scores) == self.k:
            stay &= scores >= self.scores[-1]
        if not stay.any():
            return
        scores, ids = scores[stay], ids[stay]
        if len(scores) > self.k:
            most = scores >= np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            scores, ids = scores[most], ids[most]
        both = sorted(zip((-s for s in [*self.scores, *scores.tolist()]), [*self.ids, *ids.tolist()]))[:self.k]
        self.scores, self.ids = [-s for s, _ in both], [i for _, i in both]

    def floor(self) -> int | float:
        """What an unseen score must reach to matter."""
        if len(self.scores) == self.k:
            return self.scores[-1]
        return -float("inf") if self.low is None else self.low


def threshold_search(block: Block, vector: np.ndarray, allowed: np.ndarray, windows: list[Best]) -> int:
    """Adds what a block holds to every window; the number of rows scored."""
    n, top = len(block.ids), max(abs(int(x)) for x in vector.tolist()) if len(vector) else 0
    bound = len(vector) * block.top * top
    # Whole numbers below 2**53 are exact in doubles, below 2**63 in longs.
    kind = np.float64 if bound < 1 << 53 else np.int64 if bound < 1 << 63 else object
    vectors, values = block.as_kind(kind)
    q = vector.astype(kind)
    up, down = np.flatnonzero(vector > 0), np.flatnonzero(vector < 0)
    seen, depth, step, scored = np.zeros(n, bool), 0, DEPTH, 0
    while depth < n:
        end = min(n, depth + step)
        fresh = np.zeros(n, bool)
        if len(up) or len(down):
            fresh[block.order[up, n - end:n - depth]] = True
            fresh[block.order[down, depth:end]] = True
        else:
            fresh[:] = True                                   # a zero anchor has no lists
        fresh &= ~seen
        seen |= fresh
        rows = np.flatnonzero(fresh & allowed)
        if len(rows):
            scores, ids = vectors[rows] @ q, block.ids[rows]
            scores = (np.array([min(max(x, LONG.min), LONG.max) for x in scores.tolist()], np.int64) if kind is object
                      else scores.astype(np.int64))
            scored += len(rows)
            for window in windows:
                window.add(scores, ids)
        limit = (values[up, n - end] * q[up]).sum() + (values[down, end - 1] * q[down]).sum()
        if all(limit < window.floor() for window in windows):
            break
        depth, step = end, 2 * step
    return scored


def _windows(positives: list[int], k: int, low: int, high: int) -> list[Best | None]:
    """A window for each positive's score; None where it holds no number."""
    ends = [(-(-low * p // 100), high * p // 100) for p in positives]
    return [Best(k, a, b) if a <= b else None for a, b in ends]


POSITIVE_SCHEMA = "anchor long, positive_id long, positive_score long"
NEGATIVE_SCHEMA = "anchor long, place int, negative_id long, negative_score long"


def _search(same_label: bool, k: int, low: int = 0, high: int = 0):
    """Blocks, sorted by group, kind and block, to the best of each group."""
    def found(blocks: list[Block], row: dict) -> list[tuple]:
        out, dim = [], row["dim"]
        anchors = np.frombuffer(row["ids"], np.int64).reshape(-1, 2)           # key, id
        labels = np.frombuffer(row["labels"], np.int64)
        vectors = np.frombuffer(row["vectors"], np.int64).reshape(len(anchors), dim)
        scores = row["scores"] or [[]] * len(anchors)
        for (key, id_), label, vector, positives in zip(anchors.tolist(), labels, vectors, scores, strict=True):
            windows = [Best(k)] if same_label else _windows([int(p) for p in positives], k, low, high)
            asked = [w for w in windows if w is not None]
            for block in blocks if asked else ():
                of_label = block.labels == label
                threshold_search(block, vector, (of_label if same_label else ~of_label) & (block.ids != id_), asked)
            for place, window in enumerate(windows):
                if window is not None:
                    out += [(key, place, i, s) for i, s in zip(window.ids, window.scores, strict=True)]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, blocks = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                if (row["dim"], row["group"]) != group:
                    group, blocks = (row["dim"], row["group"]), []
                if row["kind"] == 0:
                    vectors = np.frombuffer(row["vectors"], np.int64).reshape(row["n"], row["dim"])
                    order = np.frombuffer(row["lists"], np.uint32).reshape(row["dim"], row["n"])
                    blocks.append(Block(np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64), vectors, order))
                    continue
                rows = found(blocks, row)
                keys, places, ids, scores = zip(*rows, strict=True) if rows else ((),) * 4
                columns = [pa.array(keys, pa.int64()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())]
                if same_label:
                    yield pa.RecordBatch.from_arrays(columns, ["anchor", "positive_id", "positive_score"])
                else:
                    columns.insert(1, pa.array(places, pa.int32()))
                    yield pa.RecordBatch.from_arrays(columns, ["anchor", "place", "negative_id", "negative_score"])

    return run


def _blocks(rows: DataFrame, name: str) -> DataFrame:
    """Candidates in blocks of about BLOCK rows of one length, dealt by a hash of
    the row; of equal rows as many stand there as can be among the best."""
    copies = F.least(F.count(F.lit(1)), F.lit(max(POSITIVES, NEGATIVES)).cast("long"))
    spread = (rows.groupBy("dim", "id", "label", "vector").agg(copies.alias("copies"))
              .select("dim", "id", "label", "vector", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")))
    spread = materialize(spread, f"{name}-rows")
    # One row for each length of vectors: n lengths take n * n / 2 components in the table at least.
    sizes = spread.groupBy("dim").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    dealt = spread.join(F.broadcast(sizes), "dim").select(
        "dim", F.pmod(F.xxhash64("id", "label", "vector", "copy"), F.col("blocks")).alias("block"), "id", "label", "vector")
    return materialize(dealt.groupBy("dim", "block").applyInPandas(_pack(True), BLOCK_SCHEMA), name)


def _anchor_blocks(anchors: DataFrame, groups: DataFrame) -> DataFrame:
    """Anchors (key, id, label, vector, scores) packed, a copy for each group of
    blocks of their length."""
    schema = "dim int, block long, n int, ids binary, labels binary, vectors binary, scores array<array<long>>"

    def pack(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("key")
        return pd.DataFrame({"dim": [key[0]], "block": [key[1]], "n": [len(part)],
                             "ids": [part[["key", "id"]].to_numpy(np.int64).tobytes()],
                             "labels": [part["label"].to_numpy(np.int64).tobytes()],
                             "vectors": [_matrix(part["vector"], int(key[0])).tobytes()],
                             "scores": [[list(x) for x in part["scores"]]]})

    sizes = anchors.groupBy("dim").agg(F.ceil(F.count("*") / ANCHORS).alias("packs"))
    packed = (anchors.join(F.broadcast(sizes), "dim").withColumn("pack", F.pmod(F.xxhash64("key"), F.col("packs")))
              .groupBy("dim", "pack").applyInPandas(pack, schema))
    return packed.join(F.broadcast(groups), "dim").select(
        "dim", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("group"), F.lit(1).alias("kind"), "block", "n",
        "ids", "labels", "vectors", F.lit(None).cast("binary").alias("lists"), "scores")


def _mined(blocks: DataFrame, anchors: DataFrame, search, schema: str) -> DataFrame:
    """Every group of blocks with all anchors of its length."""
    tasks = 2 * blocks.sparkSession.sparkContext.defaultParallelism
    n = F.count("*")
    groups = materialize(blocks.groupBy("dim").agg(F.greatest(F.ceil(n / HELD), F.least(n, F.lit(tasks).cast("long"))).alias("groups")),
                         "groups")
    held = blocks.join(F.broadcast(groups), "dim").select(
        "dim", (F.col("block") % F.col("groups")).alias("group"), F.lit(0).alias("kind"), "block", "n", "ids", "labels",
        "vectors", "lists", F.lit(None).cast("array<array<long>>").alias("scores"))
    total = groups.agg(F.sum("groups")).head()[0] or 1
    both = held.unionByName(_anchor_blocks(anchors, groups)).repartition(min(4 * total, 20_000), "dim", "group")
    return both.sortWithinPartitions("dim", "group", "kind", "block").mapInArrow(search, schema)


def mine(vectors: DataFrame, is_anchor: Column, label: Column | None = None, id_col: str = "vec_id",
         label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).
    ``is_anchor`` and ``label`` are expressions over the columns id, label and
    vector; ``label`` takes the place of the label."""
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"),
                          F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector")))
    if label is not None:
        rows = rows.withColumn("label", label.cast("long")).where("label is not null")
    rows = rows.withColumn("vector", F.transform("vector", lambda x: F.floor(x * float(SCALE)))).withColumn("dim", F.size("vector"))
    blocks = _blocks(rows, "candidate-blocks")
    none = F.array().cast("array<long>")
    anchors = materialize(rows.where(is_anchor).distinct().select(
        F.monotonically_increasing_id().alias("key"), "dim", "id", "label", "vector", none.alias("scores")), "anchors")

    found = _mined(blocks, anchors, _search(True, POSITIVES), POSITIVE_SCHEMA)
    order = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id")
    positives = materialize(found.withColumn("place", F.row_number().over(order) - 1).where(F.col("place") < POSITIVES), "positives")

    # POSITIVES rows an anchor at most, in order of their place.
    told = positives.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("told"))
    asking = anchors.drop("scores").join(told, F.col("key") == F.col("anchor")).select(
        "key", "dim", "id", "label", "vector", F.col("told.positive_score").alias("scores"))
    found = _mined(blocks, asking, _search(False, NEGATIVES, LOW, HIGH), NEGATIVE_SCHEMA)
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), "negative_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= NEGATIVES)
    named = anchors.select("key", F.col("id").alias("anchor_id"))
    return (best.join(positives, ["anchor", "place"]).join(named, F.col("key") == F.col("anchor"))
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


ORACLE_SQL = r"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.e, c.e)::BIGINT AS score
      FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM
        (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS k FROM s WHERE same) WHERE k <= 5),
n AS (SELECT p.anchor_id, positive_id, positive_score, s.vec_id AS negative_id, score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, s.vec_id) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
       AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
