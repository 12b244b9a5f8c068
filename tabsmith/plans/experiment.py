"""Configured experiments: train, cross-validate, evaluate, save; search and refit.

A configuration has the sections of the reference's experiment files: ``model``
(one type with its parameters, or a stack with selector, bases and meta learner),
``cross_validation`` and, for searches, ``<kind>_search_params``.  Single models and
stacks go the same way, as one Spark ML pipeline.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.operators import metrics as met
from tabsmith.operators import models as md
from tabsmith.operators import sampling as sm
from tabsmith.operators import tuning as tu
from tabsmith.operators.stacking import nested_space, pipeline_from_config, prepared
from tabsmith.session import even, materialize
from tabsmith.sources.io import write_table

#: The kinds of search by the names that configurations use.
SEARCHES = ("grid", "random", "halving_grid", "halving_random", "bayesian")


FITS_AT_A_TIME = 4


@dataclass
class Experiment:
    """A fitted pipeline, its metric rows and where both were written."""
    model: PipelineModel
    metrics: DataFrame
    paths: dict[str, str]
    trials: DataFrame | None = None
    best_params: dict | None = None


def _seed(config: Mapping) -> int:
    return int((config["model"].get("params") or {}).get("random_state", 42))


def _score(model, rows: DataFrame, kind: str) -> DataFrame:
    return met.evaluate(md.predict(model, rows, keep=["label"]), digits=None).select(F.lit(kind).alias("metrics_type"), *met.METRIC_COLUMNS)


def train(config: Mapping, rows: DataFrame, features: Sequence[str], key: str = "row_id", test: DataFrame | None = None,
          path: str | None = None) -> Experiment:
    """Fits the configured model on all rows, cross-validates it, evaluates it on the
    rows and on ``test``, and writes model and metrics under ``path``.  The model that
    is kept is the one fitted on all rows, not that of the last fold."""
    folds = int((config.get("cross_validation") or {}).get("n_splits", 5))
    pipe = pipeline_from_config(config["model"], features, folds, key)
    rows = rows.select(*dict.fromkeys([key, "label", *features])).withColumn("label", F.col("label").cast("double"))
    folded = even(sm.kfold(rows, key, folds, _seed(config)), rows.count())
    heads, rest, kept = prepared(pipe, folded, ["fold"])          # assembled once for all fits
    kept = kept.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        with ThreadPoolExecutor(max_workers=FITS_AT_A_TIME) as pool:
            fits = list(pool.map(lambda k: rest.fit(kept.where(F.col("fold") != k) if k else kept), range(folds + 1)))
        scored = None
        for k in range(1, folds + 1):
            part = md.predict(fits[k], kept.where(F.col("fold") == k), keep=["fold", "label"])
            scored = part if scored is None else scored.unionByName(part)
        per_fold = met.evaluate(scored, ["fold"], digits=None)
        model = PipelineModel(stages=[*heads, *fits[0].stages])
        table = met.summarize_folds(per_fold, []).unionByName(_score(fits[0], kept, "train"))
        if test is not None:
            table = table.unionByName(_score(model, test.withColumn("label", F.col("label").cast("double")), "test"))
        table = materialize(table, "experiment-metrics")          # a few rows, while the folds are cached
    finally:
        kept.unpersist()
    return Experiment(model, table, _write(model, table, path))


def _write(model: PipelineModel, table: DataFrame, path: str | None) -> dict[str, str]:
    if path is None:
        return {}
    model.write().overwrite().save(f"{path}/model")
    return {"model": f"{path}/model", "metrics": write_table(table, f"{path}/metrics")}


def candidates(kind: str, section: Mapping, n_rows: int, seed: int = 42) -> list[dict]:
    """The candidates of a search section."""
    if kind == "bayesian":
        space = section.get("search_spaces") or nested_space(section)
        typed = {k: v if isinstance(v, Mapping) else {"type": "categorical", "categories": md.expand_range(v)} for k, v in space.items()}
        return tu.space_candidates(typed, int(section.get("n_iter", 50)), seed)
    space = nested_space(section)
    if kind == "random":
        return tu.random_candidates(space, int(section.get("n_iter", 10)), seed)
    if kind == "halving_random":
        return tu.halving_candidates(space, n_rows, section.get("n_candidates", "exhaust"), int(section.get("factor", 3)),
                                     section.get("min_resources", "smallest"), cv=int(section.get("cv", 5)), seed=seed)
    return tu.grid_candidates(space)


def tune(config: Mapping, kind: str, rows: DataFrame, features: Sequence[str], key: str = "row_id", test: DataFrame | None = None,
         path: str | None = None, parallelism: int = 4) -> Experiment:
    """Searches as the configuration's ``<kind>_search_params`` say, refits the best
    candidate on all rows, evaluates it and writes trials, best row, model and
    metrics under ``path``."""
    if kind not in SEARCHES:
        raise ValueError(f"unsupported search {kind}; there are {SEARCHES}")
    section = config[f"{kind}_search_params"]
    seed, cv, metric = int(section.get("random_state", 42)), int(section.get("cv", 5)), section.get("scoring", "recall")
    pipe = pipeline_from_config(config["model"], features, int((config.get("cross_validation") or {}).get("n_splits", 5)), key)
    rows = rows.select(*dict.fromkeys([key, "label", *features])).withColumn("label", F.col("label").cast("double"))
    n = rows.count() if kind.startswith("halving") else 0
    found = candidates(kind, section, n, seed)
    if kind.startswith("halving"):
        start = section.get("min_resources", "smallest" if kind == "halving_random" else "exhaust")
        rounds = tu.halving_schedule(n, len(found), int(section.get("factor", 3)), start, cv=cv)
        trials = materialize(tu.halving_search(sm.nested_order(rows, "label", key, seed), features, pipe, found, rounds, cv, metric,
                                               seed, parallelism=parallelism, key=key), "trials")
        last = trials.where(F.col("run_id") == trials.agg(F.max("run_id")).head()[0])
    else:
        folded = even(sm.kfold(rows, key, cv, seed, strata=["label"]), rows.count())
        trials = last = materialize(tu.score_candidates(
            folded, features, pipe, found, range(1, cv + 1), metric, parallelism=parallelism,
            return_train_score=bool(section.get("return_train_score"))), "trials")
    _, best, fitted = tu.refit_best(rows, features, pipe, found, last, metric)
    table = _score(fitted.model, rows, "train")
    if test is not None:
        table = table.unionByName(_score(fitted.model, test.withColumn("label", F.col("label").cast("double")), "test"))
    table = materialize(table, "experiment-metrics")
    paths = {}
    if path is not None:
        paths = tu.save_search(trials, path, metric, fitted) | {"metrics": write_table(table, f"{path}/metrics")}
    return Experiment(fitted.model, table, paths, trials, best)
