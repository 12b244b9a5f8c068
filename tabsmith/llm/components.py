"""Connected components of a distributed edge list.

Tasks first contract the edges they read to stars around the smallest node of
each local component; large-star and small-star rounds then join the local
stars.  A round is two map-side-combined minima and joins of the edges with
them, written to the shared folder, so nothing grows on the driver and a lost
executor only repeats its part of one round.  The rounds end when every node
hangs on one other at most, which hangs on none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.session import materialize

#: Edges that a task contracts at a time.
CHUNK = 1 << 20
#: A node with more than one in so many of the edges is looked up without a shuffle.
HOT_SHARES = 512
EDGE_SCHEMA = "u long, v long"


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The components of some edges as (node, smallest node), without the
    smallest nodes themselves."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[:len(u)], ends[len(u):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    hangs = label != np.arange(len(nodes))
    return nodes[hangs], nodes[label[hangs]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, n = [], 0

    def out():
        u, v = stars(*(np.concatenate(x) for x in zip(*held, strict=True)))
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    for batch in batches:
        held.append((np.asarray(batch.column(0)), np.asarray(batch.column(1))))
        n += batch.num_rows
        if n >= CHUNK:
            yield out()
            held, n = [], 0
    if n:
        yield out()


def _with_least(edges: DataFrame, total: int) -> DataFrame:
    """(u, v, m): m is the least of u and its neighbours v; ``total`` edges.  Nodes
    with a large share of the edges, HOT_SHARES at most, are looked up where the
    edges are read, so that the centre of a star is no key of a shuffle."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select(
        F.col("u").alias("k"), F.least("u", "m").alias("m"), (F.col("n") * HOT_SHARES > total).alias("hot"))
    hot = F.broadcast(least.where("hot").select("k", "m"))
    far = edges.join(hot, F.col("u") == F.col("k"), "left_anti")
    return (edges.join(hot, F.col("u") == F.col("k")).select("u", "v", "m")
            .unionByName(far.join(least.where("not hot").select("k", "m"), F.col("u") == F.col("k")).select("u", "v", "m")))


def _pairs(df: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """A row (u, v) for each of the named pairs of columns of each row."""
    each = [F.struct(F.col(a).alias("u"), F.col(b).alias("v")) for a, b in pairs]
    return df.select(F.explode(F.array(*each)).alias("e")).select("e.u", "e.v")


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    """Larger neighbours move to the least one; edges u > v come and go."""
    far = _with_least(_pairs(edges, ("u", "v"), ("v", "u")), 2 * total).where(F.col("v") > F.col("u"))
    return far.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    """Smaller neighbours and the node itself move to the least one."""
    return _pairs(_with_least(edges, total), ("v", "m"), ("u", "m")).where("u <> v")


def _parents(edges: DataFrame) -> DataFrame:
    """(node, component, last): the least and the largest node that a node hangs
    on; a node that others hang on counts as its own."""
    return (_pairs(edges, ("u", "v"), ("v", "v")).groupBy(F.col("u").alias("node"))
            .agg(F.min("v").alias("component"), F.max("v").alias("last")))


def _is_done(edges: DataFrame) -> bool:
    """Whether every edge belongs to a star; edges may repeat."""
    return not _parents(edges).agg(F.max(F.col("component") < F.col("last"))).head()[0]


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of the edges (columns u and v, longs);
    the component is its smallest node.  Loops and nulls are no edges; no edge
    gives no row."""
    read = materialize(edges.where("u <> v").select("u", "v"), f"{name}-edges")
    now = materialize(read.mapInArrow(_contract, EDGE_SCHEMA), name)
    while not _is_done(now):
        # Where the rows of one u are together, this also drops repeated edges.
        # A large star gives as many edges as it takes at most, but for loops.
        total = now.count()
        now = materialize(_small_star(_large_star(now, total), total).mapInArrow(_contract, EDGE_SCHEMA), name)
    return _parents(now).select("node", "component")
