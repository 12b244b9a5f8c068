"""Shapley values of tree ensembles by path weights.

A tree's expected output, given only some features, follows a row where a split's
feature is given and else goes both ways by the training rows' shares.  For a leaf
whose path asks d features, let z_i be the share of rows that its splits on feature
i let through and o_i whether the row passes them all.  The leaf's part in the
Shapley value of feature j is

    value * (o_j - z_j) * integral over t in [0, 1] of prod_{i != j} ((1 - t) z_i + t o_i)

for the weight k! (d - 1 - k)! / d! of a set of k features is the integral of
t^k (1 - t)^(d - 1 - k).  The integrand is a polynomial of degree d - 1, so Gauss's
rule with ceil(d / 2) points is exact: leaves x depth^2 steps for a row, no
background rows, all rows of a batch at once.

The values of a row add up to the ensemble's margin less its expected output.  Node
tables are read from the saved model's own table (a row for each node); they are
shipped with the tasks and must not exceed ``MAX_NODES``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.operators.explain import TOP_K
from tabsmith.session import output_path

#: Nodes of an ensemble, about 100 bytes each when shipped.
MAX_NODES = 500_000


@dataclass(frozen=True)
class Leaf:
    """A leaf's value and, for each feature on its path, the share of training rows
    let through and the bounds low < x <= high."""
    value: float
    features: np.ndarray
    shares: np.ndarray
    low: np.ndarray
    high: np.ndarray


@dataclass(frozen=True)
class TreeEnsemble:
    """Leaves of all trees, values weighted; the expected output."""
    leaves: list[Leaf]
    base: float


def saved_nodes(spark: SparkSession, path: str) -> dict[int, dict[int, dict]]:
    """tree -> node id -> node, from the table of a saved tree model."""
    data = spark.read.parquet(f"{path}/data")
    if "nodeData" in data.columns:
        data = data.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        data = data.withColumn("tree", F.lit(0))
    n = data.count()
    if n > MAX_NODES:
        raise ValueError(f"the model has {n} nodes; at most {MAX_NODES} are shipped with tasks")
    rows = data.select("tree", "id", "prediction", "impurityStats", "rawCount", "leftChild", "rightChild",
                       F.col("split.featureIndex").alias("feature"), F.col("split.numCategories").alias("categories"),
                       F.col("split.leftCategoriesOrThreshold").alias("split")).collect()
    out: dict[int, dict[int, dict]] = {}
    for r in rows:
        out.setdefault(r["tree"], {})[r["id"]] = r.asDict()
    return out


def _leaves(nodes: dict[int, dict], value, weight: float) -> Iterator[Leaf]:
    """Leaves by an explicit walk: paths can be deep."""
    todo = [(0, {})]
    while todo:
        at, path = todo.pop()
        node = nodes[at]
        if node["leftChild"] < 0:
            features = sorted(path)
            share, low, high = (np.array([path[f][i] for f in features], float) for i in range(3))
            yield Leaf(weight * value(node), np.array(features, np.int64), share, low, high)
            continue
        if node["categories"] is not None and node["categories"] >= 0:
            raise ValueError("splits on categories have no order; encode them as columns first")
        f, threshold = node["feature"], node["split"][0]
        share, low, high = path.get(f, (1.0, -np.inf, np.inf))
        total = max(1, nodes[node["leftChild"]]["rawCount"] + nodes[node["rightChild"]]["rawCount"])
        for child, bounds in ((node["leftChild"], (low, min(high, threshold))), (node["rightChild"], (max(low, threshold), high))):
            todo.append((child, {**path, f: (share * nodes[child]["rawCount"] / total, *bounds)}))


def ensemble_of(model, spark: SparkSession) -> TreeEnsemble:
    """The leaves of a fitted classifier (tree, forest or boosted trees): a forest's
    output is the mean share of class 1, a boosted model's its margin."""
    path = output_path(spark, "tree-model")
    model.write().overwrite().save(path)
    trees = saved_nodes(spark, path)
    boosted = isinstance(model, GBTClassificationModel)
    weights = list(model.treeWeights) if boosted else [1.0 / len(trees)] * len(trees)

    def share(node):
        stats = node["impurityStats"]
        return stats[1] / sum(stats) if len(stats) > 1 and sum(stats) else float(node["prediction"])

    value = (lambda node: float(node["prediction"])) if boosted else share
    leaves = [leaf for t in sorted(trees) for leaf in _leaves(trees[t], value, weights[t])]
    return TreeEnsemble(leaves, float(sum(leaf.value * leaf.shares.prod() for leaf in leaves)))


def _rules(depth: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Gauss's points and weights on [0, 1] for paths of up to ``depth`` features."""
    out = [(np.array([0.5]), np.array([1.0]))]
    for d in range(1, depth + 1):
        x, w = np.polynomial.legendre.leggauss((d + 1) // 2)
        out.append(((x + 1) / 2, w / 2))
    return out


def _contributions(leaf: Leaf, passed: np.ndarray, rule) -> np.ndarray:
    """A leaf's part (rows x its features) for rows that pass the given splits."""
    t, w = rule
    # rows x features x points; never 0, for t < 1 and shares of a reached leaf are above 0
    factors = (1 - t) * np.maximum(leaf.shares, 1e-300)[None, :, None] + t * passed[:, :, None]
    whole = (factors.prod(axis=1) * w)[:, None, :]
    return leaf.value * (passed - leaf.shares) * (whole / factors).sum(axis=2)


#: Features on a path up to which all patterns of passed splits are worked out before
#: the rows: 2^8 patterns x 8 features of a leaf are 16 KB.
MAX_PATTERN = 8
#: Splits whose outcome is remembered for a batch, a byte for each row.
MAX_TESTS = 2_048


def pattern_tables(ensemble: TreeEnsemble) -> list[np.ndarray | None]:
    """For each leaf its part for every pattern of passed splits (bit i: the i-th feature
    of its path); none for longer paths."""
    rules = _rules(MAX_PATTERN)
    out: list[np.ndarray | None] = []
    for leaf in ensemble.leaves:
        d = len(leaf.features)
        bits = (np.arange(1 << d)[:, None] >> np.arange(d)) & 1 == 1 if 0 < d <= MAX_PATTERN else None
        out.append(None if bits is None else _contributions(leaf, bits, rules[d]))
    return out


def path_shapley(rows: np.ndarray, ensemble: TreeEnsemble, tables: Sequence[np.ndarray | None] | None = None) -> np.ndarray:
    """Shapley values (rows x features); a missing value (NaN) goes right.  A leaf's part
    depends on which splits a row passes only, so it is looked up by that pattern
    (``pattern_tables``, which a caller with many batches works out once)."""
    tables = pattern_tables(ensemble) if tables is None else tables
    rules = _rules(max((len(leaf.features) for leaf in ensemble.leaves), default=0))
    values = np.ascontiguousarray(np.where(np.isnan(rows), np.inf, rows).T)
    out, tests = np.zeros(values.shape), {}

    def passes(f, low, high):
        """Whether rows go through; leaves of a tree share most of their bounds."""
        if (f, low, high) not in tests:
            if len(tests) >= MAX_TESTS:
                tests.clear()
            x = values[f]
            tests[f, low, high] = (x <= high if np.isneginf(low) else (x > low) & (x <= high)).view(np.uint8)
        return tests[f, low, high]

    for leaf, table in zip(ensemble.leaves, tables, strict=True):
        if not len(leaf.features):
            continue
        passed = [passes(f, low, high) for f, low, high in zip(leaf.features.tolist(), leaf.low.tolist(), leaf.high.tolist())]
        if table is None:
            out[leaf.features] += _contributions(leaf, np.array(passed).T.astype(bool), rules[len(leaf.features)]).T
            continue
        pattern = passed[0].copy()
        for i, p in enumerate(passed[1:], 1):
            pattern |= p << i
        for f, part in zip(leaf.features.tolist(), table.T):
            out[f] += np.ascontiguousarray(part)[pattern]
    return out.T


def path_contributions(df: DataFrame, features: Sequence[str], model, keep: Sequence[str] = (), k: int = TOP_K,
                       spread_base: bool = True, total: str | None = None) -> DataFrame:
    """The k largest contributions of every row (``Feature_i_Name``, ``_Contribution``)
    and ``base_value``.  With ``spread_base`` each carries its share of the base
    before they are ranked; ``total`` names a column for the sum of all features'
    contributions and the base."""
    features, keep = list(features), list(keep)
    shared = df.sparkSession.sparkContext.broadcast(ensemble_of(model, df.sparkSession))      # MAX_NODES nodes at most
    top = min(k, len(features))
    schema = ", ".join([f"`{c}` {t}" for c, t in df.select(*[F.col(f"`{c}`") for c in keep]).dtypes]
                       + [f"Feature_{i}_Name string, Feature_{i}_Contribution double" for i in range(1, top + 1)]
                       + ["base_value double"] + ([f"`{total}` double"] if total else []))
    places = [f"__f{i}" for i in range(len(features))]

    def run(batches):
        ensemble = shared.value
        tables = pattern_tables(ensemble)
        for pdf in batches:
            phi = path_shapley(pdf[places].to_numpy(float).reshape(len(pdf), len(features)), ensemble, tables)
            out = pdf[keep].copy()
            sums = phi.sum(axis=1) + ensemble.base
            if spread_base:
                phi = phi + ensemble.base / len(features)
            order = np.argsort(-np.abs(phi), axis=1, kind="stable")
            for i in range(top):
                out[f"Feature_{i + 1}_Name"] = np.array(features, object)[order[:, i]]
                out[f"Feature_{i + 1}_Contribution"] = np.take_along_axis(phi, order[:, i:i + 1], axis=1)[:, 0]
            out["base_value"] = ensemble.base
            if total:
                out[total] = sums
            yield out

    columns = [F.col(f"`{c}`") for c in keep] + [F.col(f"`{f}`").cast("double").alias(p) for f, p in zip(features, places)]
    return df.select(*columns).mapInPandas(run, schema)


def margins(model, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """What the contributions of a row add up to, as the model itself says it."""
    column = model.getRawPredictionCol() if isinstance(model, GBTClassificationModel) else model.getProbabilityCol()
    return model.transform(df).select(*keep, vector_to_array(F.col(column))[1].alias("margin"))


