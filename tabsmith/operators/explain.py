"""Per-row additive attributions.

* linear models: contribution_j = w_j * (x_j - mean_j), as column expressions;
* tree models: exact interventional Shapley values against a background
  sample, computed per partition with ``mapInPandas`` (numpy, vectorised over
  rows x background).  Node tables come from the fitted model (a few hundred
  rows at most) and the background is bounded (default 100 rows), so both are
  shipped with the task; the scored rows stay distributed.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOP_K = 10


def linear_contributions(df: DataFrame, features: Sequence[str], weights: Sequence[float],
                         means: Mapping[str, float] | None = None, prefix: str = "contrib_",
                         digits: int | None = 6, spread_base: bool = False,
                         intercept: float = 0.0) -> DataFrame:
    """``contrib_<f> = w_f * (f - mean_f)``; means from one aggregation if not given.

    With ``spread_base`` the base value (the margin at the means) is shared
    equally by the features and added to each contribution, as the
    reference's per-row attribution table does.
    """
    if means is None:
        row = df.agg(*[F.avg(F.col(f).cast("double")).alias(f) for f in features]).first()
        means = {f: row[f] for f in features}
    share = 0.0
    if spread_base:
        base = float(intercept) + sum(float(w) * float(means[f] or 0.0) for f, w in zip(features, weights))
        share = base / len(features)
    new = {}
    for f, w in zip(features, weights):
        e = F.lit(float(w)) * (F.col(f).cast("double") - F.lit(float(means[f] or 0.0)))
        if spread_base:
            e = e + F.lit(share)
        new[f"{prefix}{f}"] = F.round(e, digits) if digits is not None else e
    return df.withColumns(new)


def top_k_columns(names: Sequence[str], contribs: Sequence[Column], k: int = TOP_K) -> list[Column]:
    """``Feature_i_Name`` / ``Feature_i_Contribution`` for the k largest |c|.

    Sorted by |c| descending, ties by feature position (a stable sort);
    missing contributions sort last.
    """
    arr = F.array(*[F.struct(F.coalesce(-F.abs(c), F.lit(float("inf"))).alias("key"),
                             F.lit(i).alias("idx"), F.lit(n).alias("name"), c.cast("double").alias("value"))
                    for i, (n, c) in enumerate(zip(names, contribs))])
    top = F.slice(F.array_sort(arr), 1, k)
    out = []
    for i in range(1, min(k, len(names)) + 1):
        out.append(top.getItem(i - 1).getField("name").alias(f"Feature_{i}_Name"))
        out.append(top.getItem(i - 1).getField("value").alias(f"Feature_{i}_Contribution"))
    return out


# ------------------------------------------------------------------ trees

def _tree_nodes(java_root, regression: bool = False) -> list[tuple]:
    """(feature, threshold, left, right, value) rows; leaves have feature -1.

    value is the class-1 share of the leaf's training statistics (classifier
    trees) or the leaf prediction (regression trees of a boosted model).
    """
    rows: list = []

    def walk(node):
        idx = len(rows)
        rows.append(None)
        if node.getClass().getSimpleName() == "InternalNode":
            split = node.split()
            left = walk(node.leftChild())
            right = walk(node.rightChild())
            rows[idx] = (int(split.featureIndex()), float(split.threshold()), left, right, float("nan"))
        else:
            stats = [] if regression else list(node.impurityStats().stats())
            if len(stats) >= 2 and sum(stats) > 0:
                value = float(stats[1]) / float(sum(stats))
            else:
                value = float(node.prediction())
            rows[idx] = (-1, float("nan"), -1, -1, value)
        return idx

    walk(java_root)
    return rows


def tree_tables(model) -> tuple[list[list[tuple]], list[float]]:
    """Node tables and weights of a fitted Spark tree model (tree or forest)."""
    if hasattr(model, "trees"):
        trees = model.trees
        weights = list(model.treeWeights) if hasattr(model, "treeWeights") else [1.0] * len(trees)
        if type(model).__name__.startswith("RandomForest"):
            weights = [1.0 / len(trees)] * len(trees)
        return [_tree_nodes(t._java_obj.rootNode(), "Regression" in type(t).__name__) for t in trees], weights
    return [_tree_nodes(model._java_obj.rootNode(), "Regression" in type(model).__name__)], [1.0]


def _leaf_paths(nodes):
    paths = []

    def walk(i, conds):
        f, thr, left, right, value = nodes[i]
        if f < 0:
            paths.append((value, conds))
            return
        walk(left, conds + [(f, thr, True)])
        walk(right, conds + [(f, thr, False)])

    walk(0, [])
    return paths


def _satisfies(X, conds):
    """Per feature on the path: do rows of X satisfy all its conditions?"""
    by_f: dict[int, np.ndarray] = {}
    for f, thr, go_left in conds:
        col = X[:, f]
        ok = (col <= thr) if go_left else ~(col <= thr)
        by_f[f] = ok if f not in by_f else (by_f[f] & ok)
    return by_f


def shapley_batch(X: np.ndarray, Z: np.ndarray, tables, weights) -> np.ndarray:
    """Exact interventional Shapley values of a tree ensemble for rows X
    against background Z (averaged over Z)."""
    n, d = X.shape
    m = Z.shape[0]
    fact = np.array([math.factorial(i) for i in range(64)], dtype=float)
    phi = np.zeros((n, d))
    for nodes, w in zip(tables, weights):
        for value, conds in _leaf_paths(nodes):
            if not conds:
                continue
            sx, sz = _satisfies(X, conds), _satisfies(Z, conds)
            feats = list(sx)
            A = [sx[f][:, None] & ~sz[f][None, :] for f in feats]
            B = [~sx[f][:, None] & sz[f][None, :] for f in feats]
            dead = np.zeros((n, m), dtype=bool)
            for f in feats:
                dead |= ~sx[f][:, None] & ~sz[f][None, :]
            a = np.sum(A, axis=0)
            b = np.sum(B, axis=0)
            live = ~dead
            tot = fact[a + b]
            wa = np.where(a > 0, fact[np.maximum(a - 1, 0)] * fact[b] / tot, 0.0)
            wb = np.where(b > 0, fact[a] * fact[np.maximum(b - 1, 0)] / tot, 0.0)
            for f, Af, Bf in zip(feats, A, B):
                contrib = (live & Af) * wa - (live & Bf) * wb
                phi[:, f] += w * value * contrib.mean(axis=1)
    return phi


def tree_contributions(df: DataFrame, features: Sequence[str], model, background: np.ndarray,
                       keep: Sequence[str], k: int = TOP_K, spread_base: bool = True) -> DataFrame:
    """Top-k Shapley contributions per row (``Feature_i_Name/_Contribution``)
    plus ``base_value`` (mean model output over the background).  With
    ``spread_base`` each contribution carries base_value / n_features (the
    reference's convention), before ranking by absolute value."""
    tables, weights = tree_tables(model)
    features = list(features)
    keep = list(keep)
    Z = np.asarray(background, dtype=float)
    base = float(sum(w * np.mean([_predict_tree(nodes, z) for z in Z]) for nodes, w in zip(tables, weights)))
    kk = min(k, len(features))
    schema = ", ".join([f"`{c}` {t}" for c, t in df.select(*keep).dtypes] +
                       [f"Feature_{i}_Name string, Feature_{i}_Contribution double" for i in range(1, kk + 1)] +
                       ["base_value double"])

    def run(batches):
        import pandas as pd
        for pdf in batches:
            X = pdf[features].astype(float).to_numpy()
            phi = shapley_batch(X, Z, tables, weights)
            if spread_base:
                phi = phi + base / len(features)
            order = np.lexsort((np.tile(np.arange(len(features)), (len(X), 1)), -np.abs(phi)), axis=1) \
                if len(X) else np.zeros((0, len(features)), dtype=int)
            out = pdf[keep].copy()
            for i in range(kk):
                idx = order[:, i] if len(X) else np.array([], dtype=int)
                out[f"Feature_{i + 1}_Name"] = [features[j] for j in idx]
                out[f"Feature_{i + 1}_Contribution"] = phi[np.arange(len(X)), idx] if len(X) else []
            out["base_value"] = base
            yield pd.DataFrame(out)

    return df.select(*keep, *[F.col(f).cast("double").alias(f) for f in features if f not in keep]) \
        .mapInPandas(run, schema)


def _predict_tree(nodes, x) -> float:
    i = 0
    while nodes[i][0] >= 0:
        f, thr, left, right, _ = nodes[i]
        i = left if x[f] <= thr else right
    return nodes[i][4]
