"""Feature selection: rank correlation, greedy ranking, LASSO path, elimination.

The rows are read in a few distributed passes; what the choices are made from is
bounded by the number of features: a correlation table, or one matrix of moments.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.operators import models as md
from tabsmith.operators.rank import default_cells, running_sums
from tabsmith.operators.stacking import ConfiguredClassifier

RANK_SUFFIX = "_rank"


def _number(column: str):
    x = F.col(f"`{column}`").cast("double")
    return F.when(~F.isnan(x), x)


def average_ranks(df: DataFrame, key: str, columns: Sequence[str], cells: int | None = None) -> DataFrame:
    """(key, ``<column>_rank``...): every value's rank in its column, ties averaged;
    missing values have none.  ``key`` must be unique.

    All columns go through one flow: distinct values with counts, running counts in
    value order (cells by approximate quantiles, so that no column is one task),
    then the ranks go back to the rows.  Values that hold more than a cell's share of
    a column are at most ``cells`` a column; they are looked up without a shuffle, so
    no value is a hot key.
    """
    columns, cells = list(columns), cells or default_cells(df)
    kind = df.schema[key].dataType.simpleString()
    if not columns:
        return df.select(key)
    qs = [i / cells for i in range(1, cells)]
    stats = df.agg(*[F.percentile_approx(_number(c), qs, 1000).alias(f"b{i}") for i, c in enumerate(columns)],
                   *[F.count(_number(c)).alias(f"n{i}") for i, c in enumerate(columns)]).head()
    long = df.select(F.col(f"`{key}`").alias("id"), F.explode(F.array(*[
        F.struct(F.lit(i).alias("col"), _number(c).alias("v")) for i, c in enumerate(columns)])).alias("s")).select("id", "s.col", "s.v")
    counts = long.where("v is not null").groupBy("col", "v").agg(F.count(F.lit(1)).alias("c"))
    cell, share = F.lit(0), F.lit(0)
    for i in range(len(columns)):
        bounds = F.array(*[F.lit(float(b)) for b in sorted(set(stats[f"b{i}"] or []))]).cast("array<double>")
        cell = F.when(F.col("col") == i, F.size(F.filter(bounds, lambda b: b < F.col("v")))).otherwise(cell)
        share = F.when(F.col("col") == i, F.lit(stats[f"n{i}"] / cells)).otherwise(share)
    ranked = running_sums(counts, ["col"], [F.col("v")], cell, {"c": F.col("c")}, inclusive=True).select(
        "col", "v", (F.col("cum_c") - F.col("c") + (F.col("c") + 1) / 2).alias("rank"), (F.col("c") > share).alias("hot"))
    hot = F.broadcast(ranked.where("hot").select("col", "v", "rank"))       # below ``cells`` values a column
    cold = long.join(hot.drop("rank"), ["col", "v"], "left_anti")
    both = long.join(hot, ["col", "v"]).select("id", "col", "rank").unionByName(
        cold.join(ranked.where("not hot").select("col", "v", "rank"), ["col", "v"], "left").select("id", "col", "rank"))
    wide = both.groupBy("id").agg(*[F.max(F.when(F.col("col") == i, F.col("rank"))).alias(f"{c}{RANK_SUFFIX}")
                                    for i, c in enumerate(columns)])
    return wide.withColumnRenamed("id", key).withColumn(key, F.col(key).cast(kind))


def correlations(df: DataFrame, columns: Sequence[str], names: Sequence[str] | None = None) -> DataFrame:
    """(feature_a, feature_b, corr) of all pairs, over the rows that have both; null
    where one of them has no spread."""
    names = list(names or columns)
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1, len(names))]
    if not pairs:
        return df.sparkSession.createDataFrame([], "feature_a string, feature_b string, corr double")
    x = [F.col(f"`{c}`").cast("double") for c in columns]

    def corr(i, j):
        spread = F.stddev_pop(F.when(x[j].isNotNull(), x[i])) * F.stddev_pop(F.when(x[i].isNotNull(), x[j]))
        return F.when(spread > 0, F.covar_pop(x[i], x[j]) / F.when(spread > 0, spread))

    row = df.agg(*[corr(i, j).alias(f"c{i}_{j}") for i, j in pairs])
    cells = [F.struct(F.lit(names[i]).alias("feature_a"), F.lit(names[j]).alias("feature_b"), F.col(f"c{i}_{j}").alias("corr"))
             for i, j in pairs]
    return row.select(F.explode(F.array(*cells)).alias("p")).select("p.*")


def spearman(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Rank correlations of all pairs of columns."""
    return correlations(average_ranks(df, key, columns), [f"{c}{RANK_SUFFIX}" for c in columns], columns)


def rank_features(table: DataFrame, label: str) -> list[tuple[int, str, float, float]]:
    """(place, feature, relevance, redundancy) from a correlation table: next comes
    the feature whose absolute correlation with the label most exceeds its mean
    absolute correlation with those already placed (ties: by name).  A correlation
    that is missing counts as 0."""
    size = {frozenset((r["feature_a"], r["feature_b"])): abs(r["corr"]) if r["corr"] == r["corr"] and r["corr"] is not None else 0.0
            for r in table.collect()}                                       # a row for each pair of features
    left = sorted({f for pair in size for f in pair} - {label})
    placed: list[tuple[int, str, float, float]] = []
    while left:
        def redundancy(f):
            return float(np.mean([size[frozenset((f, p[1]))] for p in placed])) if placed else 0.0
        best = max(left, key=lambda f: (round(size[frozenset((f, label))] - redundancy(f), 12), -left.index(f)))
        placed.append((len(placed) + 1, best, size[frozenset((best, label))], redundancy(best)))
        left.remove(best)
    return placed


# ---------------------------------------------------------------- moments and the LASSO path

def moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, total): the sums of the products of every two columns and of every
    column with 1 (b = ''), and the number of rows (a = b = ''); rows with a missing
    value are left out.  Tasks add up matrices; one row for each pair leaves a task."""
    names = ["", *columns]
    n = len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n, n))
        for batch in batches:
            x = np.column_stack([np.ones(batch.num_rows), *(c.to_numpy(zero_copy_only=False) for c in batch.columns)])
            total += x.T @ x
        i, j = np.triu_indices(n)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])],
                                         ["i", "j", "s"])

    rows = df.select(*[_number(c).alias(f"c{i}") for i, c in enumerate(columns)]).dropna()
    sums = rows.mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("total"))
    name = F.array(*[F.lit(c) for c in names])
    return sums.select(F.get(name, F.col("j")).alias("a"), F.get(name, F.col("i")).alias("b"), "total")


def _standard(table: DataFrame, features: Sequence[str], label: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(correlations of the features, their covariances with the label at unit
    spread, spreads) from the moments; a feature without spread has zeros."""
    got = {(r["a"], r["b"]): r["total"] for r in table.collect()}           # a row for each pair of columns
    names = [*features, label]
    n = got.get(("", ""), 0.0)
    if not n:
        raise ValueError("no row without missing values")
    mean = np.array([got[c, ""] for c in names]) / n
    second = np.array([[got.get((x, y), got.get((y, x))) for y in names] for x in names]) / n
    cov = second - np.outer(mean, mean)
    spread = np.sqrt(np.maximum(np.diag(cov), 0))
    spread[spread <= 1e-12 * np.sqrt(np.maximum(np.diag(second), 1e-300))] = 0
    scale = np.where(spread > 0, spread, np.inf)[:-1]
    return cov[:-1, :-1] / np.outer(scale, scale), cov[:-1, -1] / scale, spread[:-1]


def lasso_path(gram: np.ndarray, target: np.ndarray, steps: int = 50, least: float = 1e-3,
               tolerance: float = 1e-12) -> tuple[np.ndarray, np.ndarray]:
    """(penalties, coefficients: steps x features) of 1/2 b'Gb - t'b + penalty |b|_1 by
    coordinate descent, each step from the last, penalties falling from the least one
    that keeps all at 0 to ``least`` times it."""
    d = len(target)
    top = float(np.abs(target).max(initial=0.0))
    penalties = top * np.geomspace(1.0, least, steps) if top else np.zeros(steps)
    beta, out = np.zeros(d), np.zeros((steps, d))
    for s, penalty in enumerate(penalties):
        for _ in range(100_000):
            moved = 0.0
            for j in np.flatnonzero(np.diag(gram) > 0):
                rest = target[j] - gram[j] @ beta + gram[j, j] * beta[j]
                new = np.sign(rest) * max(abs(rest) - penalty, 0.0) / gram[j, j]
                moved = max(moved, abs(new - beta[j]))
                beta[j] = new
            if moved <= tolerance * max(1.0, top):
                break
        out[s] = beta
    return penalties, out


def lasso_ranking(df: DataFrame, features: Sequence[str], label: str, steps: int = 50,
                  at: float = 0.01) -> list[tuple[str, float, bool, int | None]]:
    """(feature, coefficient, selected, entered): coefficients in the features' own
    units at the last penalty not below ``at``, and the order in which features enter
    the path (1 first; ties by the larger coefficient on entry; None: never)."""
    gram, target, spread = _standard(moments(df, [*features, label]), features, label)
    penalties, path = lasso_path(gram, target, steps)
    here = int(np.flatnonzero(penalties >= at).max(initial=0))
    first = [int(np.flatnonzero(path[:, j]).min(initial=steps)) for j in range(len(features))]
    order = sorted((j for j in range(len(features)) if first[j] < steps), key=lambda j: (first[j], -abs(path[first[j], j]), j))
    entered = {j: i + 1 for i, j in enumerate(order)}
    return [(f, float(path[here, j] / spread[j]) if spread[j] else 0.0, bool(path[here, j]), entered.get(j))
            for j, f in enumerate(features)]


# ---------------------------------------------------------------- recursive elimination

def eliminate(df: DataFrame, features: Sequence[str], keep_n: int = 1, model_type: str = "decision_tree",
              params: Mapping | None = None, step: int = 1) -> list[tuple[str, int]]:
    """(feature, ranking) by recursive elimination: fit on what is left, drop the
    ``step`` features of least importance (ties: the later one), until ``keep_n`` are
    left; those have ranking 1, the last dropped 2 and so on.  ``df`` (features and
    ``label``) is read once a round: cache it."""
    if not 1 <= keep_n <= len(features):
        raise ValueError("keep_n must be between 1 and the number of features")
    left, gone = list(features), []
    while len(left) > keep_n:
        frame = md.assembler(left).transform(df.withColumn("label", F.col("label").cast("double")))
        model = ConfiguredClassifier(model_type, params).fit(frame)
        values = model.featureImportances if hasattr(model, "featureImportances") else model.coefficients
        values = np.abs(values.toArray())
        order = sorted(range(len(left)), key=lambda i: (values[i], -i))[:min(step, len(left) - keep_n)]
        gone.append([left[i] for i in order])
        left = [f for i, f in enumerate(left) if i not in order]
    ranking = {f: 1 for f in left}
    for place, names in enumerate(reversed(gone), 2):
        ranking |= dict.fromkeys(names, place)
    return [(f, ranking[f]) for f in features]


