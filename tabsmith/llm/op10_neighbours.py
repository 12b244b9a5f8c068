"""Nearest neighbours by a block matrix join.

Queries and candidates are packed into blocks of rows.  Every pair of a query
block and a candidate block is one tile: the int8 codes of both give all inner
products of the tile at once, each with a bound of its quantisation error.  A
candidate stays if its upper bound reaches the query's k-th best lower bound so
far; those are computed again from the original vectors in double precision,
and a bounded heap per query (kept as a sorted array) holds the k best.  The
bound is never broken, so nothing is lost.  The heaps of a query's runs of tiles
are merged by one ranked window.

A task works on one query block and a run of candidate blocks, streamed one by
one, so memory is bounded by two blocks and a slice of their tile however large
the table is, and the k-th best so far carries over from tile to tile.

Defined cases: vectors that are null, zero or that hold null or non-finite
components take no part; vectors of one length are searched among their own
kind; rows that repeat an id all count, as queries and as candidates, and a
query id gets the k best of its rows; ties go to the smaller id; products beyond
a double's range count as they come, infinite or, before all others, not a number
(as SQL orders them); fewer than k candidates give fewer rows; an empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.session import materialize

#: Rows of a block, and the queries that meet a candidate block at a time.
QUERY_BLOCK, CANDIDATE_BLOCK, SLICE = 16384, 4096, 256
BLOCK_SCHEMA = "dim int, block long, n int, ids binary, vectors binary"
FOUND_SCHEMA = "query_id long, vec_id long, score double"
_EPS = np.finfo(np.float64).eps


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _pack(rows: DataFrame, copies: str, blocks: str, name: str) -> DataFrame:
    """Blocks of rows of (id, vector) of one length, as many as ``blocks`` says,
    spread by a hash of the row; a row stands there ``copies`` times."""

    def pack(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("id")
        vectors = np.array(part["vector"].tolist(), np.float64)
        return pd.DataFrame({"dim": [key[0]], "block": [key[1]], "n": [len(part)],
                             "ids": [part["id"].to_numpy(np.int64).tobytes()], "vectors": [vectors.tobytes()]})

    spread = (rows.where(F.col(copies) > 0)
              .select("dim", "id", "vector", blocks, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))).alias("copy"))
              .select("dim", F.pmod(F.xxhash64("id", "vector", "copy"), F.col(blocks)).alias("block"), "id", "vector"))
    return materialize(spread.groupBy("dim", "block").applyInPandas(pack, BLOCK_SCHEMA), name)


def quantise(vectors: np.ndarray):
    """(codes, scale, l1 norm of the codes, size of the largest error)."""
    top = np.abs(vectors).max(axis=1)
    scale = np.maximum(top / 127.0, np.finfo(np.float64).tiny)
    codes = np.rint(vectors / scale[:, None]).clip(-127, 127)
    error = np.abs(vectors - codes * scale[:, None]).max(axis=1)
    return codes.astype(np.int8), scale, np.abs(codes).sum(axis=1), error


def tile_bounds(q, c, dim: int):
    """(approximate inner products, bound of their error) of two quantised
    blocks.  Of x.y with x = sx*a + e and y = sy*b + f the codes give sx*sy*a.b;
    the rest is at most sx*|a|_1*max|f| + sy*|b|_1*max|e| + dim*max|e|*max|f|."""
    (a, sa, la, ea), (b, sb, lb, eb) = q, c
    # Whole numbers up to dim * 127**2: exact in float32 for dim up to 1040.
    kind = np.float32 if dim * 127 * 127 < 1 << 24 else np.float64
    products = (a.astype(kind) @ b.astype(kind).T).astype(np.float64)
    products *= sa[:, None] * sb[None, :]
    bound = (sa * la)[:, None] * eb[None, :] + (sb * lb)[None, :] * ea[:, None] + dim * ea[:, None] * eb[None, :]
    return products, bound * (1 + 1e-9) + 8 * dim * _EPS * np.abs(products)


class Best:
    """The k best of each query so far, by score, then smaller id."""

    def __init__(self, query_ids: np.ndarray, vectors: np.ndarray, k: int):
        self.query_ids, self.vectors, self.k = query_ids, vectors, k
        self.scores = np.full((len(query_ids), k), -np.inf)
        self.found = np.zeros((len(query_ids), k), np.int64)
        self.there = np.zeros((len(query_ids), k), bool)           # places that are taken
        self.codes = quantise(vectors)

    def tile(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        codes = quantise(vectors)
        for a in range(0, len(self.query_ids), SLICE):
            self._slice(slice(a, a + SLICE), ids, vectors, codes)

    def _slice(self, at: slice, ids: np.ndarray, vectors: np.ndarray, codes) -> None:
        k = self.k
        with np.errstate(over="ignore", invalid="ignore"):
            near, bound = tile_bounds([x[at] for x in self.codes], codes, vectors.shape[1])
            lower, upper = near - bound, near + bound
        # Where a product or its bound overflows nothing is known of it.
        known = np.isfinite(lower) & np.isfinite(upper)
        own = self.query_ids[at][:, None] == ids[None, :]
        floor = np.where(self.there[at, -1], self.scores[at, -1], -np.inf)
        if len(ids) > k:
            lower = np.where(own | ~known, -np.inf, lower)
            floor = np.fmax(floor, np.partition(lower, len(ids) - k, axis=1)[:, len(ids) - k])
        stay = ~own & ~(known & (upper < floor[:, None]))
        for i in np.flatnonzero(stay.any(axis=1)):
            q, which = at.start + i, np.flatnonzero(stay[i])
            # Summed row by row, so that equal vectors get equal scores.
            with np.errstate(over="ignore", invalid="ignore"):
                exact = (vectors[which] * self.vectors[q]).sum(axis=1)
            held = self.there[q]
            scores = np.concatenate([self.scores[q][held], exact])
            found = np.concatenate([self.found[q][held], ids[which]])
            order = np.lexsort((found, -scores, ~np.isnan(scores)))[:k]
            self.scores[q, :len(order)], self.found[q, :len(order)] = scores[order], found[order]
            self.there[q, :len(order)] = True

    def rows(self) -> pa.RecordBatch:
        q, at = np.nonzero(self.there)
        return pa.RecordBatch.from_pydict({"query_id": self.query_ids[q], "vec_id": self.found[q, at],
                                           "score": self.scores[q, at]})


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of every
    query row with all other rows."""
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                          F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
                          is_query.alias("is_query")).where(F.col("id").isNotNull() & usable(F.col("vector")))
    # Of equal rows of one id k copies at most can be among the k best.
    copies = [F.least(n, F.lit(k).cast("long")).alias(name) for n, name in (
        (F.count(F.lit(1)), "copies"), (F.count_if(F.col("is_query")), "query_copies"))]
    rows = materialize(rows.groupBy("id", "vector").agg(*copies).withColumn("dim", F.size("vector")), "vectors")
    # A task takes one query block and a run of candidate blocks, runs being as
    # long as the parallelism allows.
    tasks = F.lit(4 * vectors.sparkSession.sparkContext.defaultParallelism)
    sizes = rows.groupBy("dim").agg(F.ceil(F.sum("copies") / CANDIDATE_BLOCK).alias("n_candidates"),
                                    F.ceil(F.sum("query_copies") / QUERY_BLOCK).alias("n_queries")).where("n_queries > 0")
    sizes = materialize(sizes.withColumn("n_runs", F.least("n_candidates", F.ceil(tasks / F.col("n_queries")))), "lengths")
    # One row for each length of vectors: n lengths take n * n / 2 components in the table at least.
    sizes = F.broadcast(sizes)
    rows = rows.join(sizes, "dim")
    candidates = _pack(rows, "copies", "n_candidates", "candidate-blocks").join(sizes, "dim")
    queries = _pack(rows, "query_copies", "n_queries", "query-blocks").join(sizes, "dim")
    # Every query block meets every candidate block of its length.
    zero = F.lit(0).cast("long")
    left = queries.select("dim", F.col("block").alias("q"), F.explode(F.sequence(zero, F.col("n_runs") - 1)).alias("run"),
                          F.lit(-1).cast("long").alias("c"), "n", "ids", "vectors")
    right = candidates.select("dim", F.explode(F.sequence(zero, F.col("n_queries") - 1)).alias("q"),
                              (F.col("block") % F.col("n_runs")).alias("run"),
                              F.col("block").alias("c"), "n", "ids", "vectors")
    tiles = left.unionByName(right).repartition("dim", "q", "run").sortWithinPartitions("dim", "q", "run", "c")

    def search(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = own = None
        for part in parts:
            for i in range(part.num_rows):
                row = {name: part.column(name)[i] for name in ("c", "n", "ids", "vectors")}
                key = tuple(part.column(name)[i].as_py() for name in ("dim", "q", "run"))
                ids = np.frombuffer(row["ids"].as_buffer(), np.int64)
                block = np.frombuffer(row["vectors"].as_buffer(), np.float64).reshape(row["n"].as_py(), -1)
                if row["c"].as_py() < 0:      # a query block comes before its candidates
                    if best is not None:
                        yield best.rows()
                    best, own = Best(ids.copy(), block.copy(), k), key
                elif own == key:              # a query block may have no rows
                    best.tile(ids, block)
        if best is not None:
            yield best.rows()

    found = tiles.mapInArrow(search, FOUND_SCHEMA)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


ORACLE_SQL = r"""
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 20
"""
