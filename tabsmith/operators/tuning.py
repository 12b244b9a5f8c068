"""Hyper-parameter search on Spark.

Candidates are enumerated on the driver (a bounded list; the full grid is
never materialised).  The expensive part -- (candidate x fold) fits and the
scoring of their predictions -- runs on Spark: fits from a small thread pool
so their jobs overlap, predictions unioned with (trial_id, fold) and scored
in one grouped aggregation.  Results form one experiment log
``trials(run_id, trial_id, params map<string,string>, fold, metric, value)``.
"""

from __future__ import annotations

import itertools
import math
import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.ml import Estimator
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabsmith.operators import metrics as met
from tabsmith.operators import models as md
from tabsmith.operators.stacking import NothingSelected, fit_kept, prepared, route
from tabsmith.session import even, is_written, materialize, output_path
from tabsmith.sources.io import read_table, write_table


class TooManyTrials(ValueError):
    pass


def _values(space: Mapping) -> list[tuple[str, list]]:
    out = []
    for k, v in space.items():
        v = md.expand_range(v)
        out.append((k, list(v) if isinstance(v, (list, tuple, range)) else [v]))
    return out


def grid_size(space: Mapping) -> int:
    return math.prod(len(v) for _, v in _values(space))


def grid_candidates(space: Mapping, max_trials: int | None = None) -> list[dict]:
    """Cartesian product of the value lists (``range(...)`` strings expanded);
    refuses grids larger than ``max_trials``, if given."""
    n = grid_size(space)
    if max_trials is not None and n > max_trials:
        raise TooManyTrials(f"grid has {n} candidates (> max_trials={max_trials})")
    vals = _values(space)
    return [dict(zip([k for k, _ in vals], combo)) for combo in itertools.product(*[v for _, v in vals])]


def decode_index(space_vals: Sequence[tuple[str, list]], index: int) -> dict:
    """Mixed-radix decoding of a grid index (last parameter varies fastest)."""
    out = {}
    for k, v in reversed(space_vals):
        index, r = divmod(index, len(v))
        out[k] = v[r]
    return dict(reversed(list(out.items())))


def random_candidates(space: Mapping, n_iter: int, seed: int = 42) -> list[dict]:
    """``n_iter`` distinct grid points drawn without replacement by index."""
    vals = _values(space)
    n = math.prod(len(v) for _, v in vals)
    idx = random.Random(seed).sample(range(n), min(n_iter, n))
    return [decode_index(vals, i) for i in idx]


def space_candidates(space: Mapping[str, Mapping], n_trials: int, seed: int = 42) -> list[dict]:
    """Seeded draws from a typed space: ``{"type": "int"|"real", "low", "high",
    "prior": "uniform"|"log-uniform"}`` or ``{"type": "categorical", "categories": [...]}``."""
    rng = random.Random(seed)
    out = []
    for _ in range(n_trials):
        c = {}
        for name, s in space.items():
            t = s.get("type", "categorical")
            if t == "categorical":
                c[name] = rng.choice(list(s["categories"]))
                continue
            lo, hi = float(s["low"]), float(s["high"])
            if s.get("prior", "uniform") in ("log-uniform", "log_uniform", "log"):
                x = math.exp(rng.uniform(math.log(lo), math.log(hi)))
            else:
                x = rng.uniform(lo, hi)
            c[name] = int(min(hi, max(lo, round(x)))) if t == "int" else x
        out.append(c)
    return out


def flatten_namespaced(tree: Mapping, prefix: str = "") -> dict:
    """Nested stage maps -> ``stage__sub__param`` keys."""
    out = {}
    for k, v in tree.items():
        key = f"{prefix}__{k}" if prefix else str(k)
        if isinstance(v, Mapping):
            out.update(flatten_namespaced(v, key))
        else:
            out[key] = v
    return out


def route_namespaced(params: Mapping) -> dict:
    """``stage__sub__param`` keys -> nested maps (inverse of flatten)."""
    out: dict = {}
    for k, v in params.items():
        parts = k.split("__")
        node = out
        for p in parts[:-1]:
            node = node.setdefault(p, {})
        node[parts[-1]] = v
    return out


def _param_map(params: Mapping):
    items = sorted(params.items())
    if not items:
        return F.create_map().cast("map<string,string>")
    return F.create_map(*[x for k, v in items for x in (F.lit(str(k)), F.lit(str(v)))])


def fit_candidate(train: DataFrame, features: Sequence[str], model: str | Estimator, params: Mapping,
                  keep_rows: bool = False) -> md.FittedModel:
    """A candidate fitted: a model type of the registry with its parameters, or any
    Estimator with the candidate's parameters set by nested name."""
    if isinstance(model, str):
        return md.fit_model(train, features, model, params, keep_rows=keep_rows)
    train = train.withColumn("label", F.col("label").cast("double"))
    fitted = fit_kept(model, train, params) if keep_rows else model.fit(train, route(model, params))
    return md.FittedModel(fitted, type(model).__name__, list(features))


def _prepared(folded: DataFrame, features: Sequence[str], model: str | Estimator, fold_col: str):
    """(rows with all that doesn't depend on a candidate worked out, a function that fits
    a candidate on such rows and returns the model that scores them)."""
    if isinstance(model, str):
        rows = md.assembled(folded, features, [fold_col])
        return rows, lambda train, params: md.fit_assembled(train, features, model, params).classifier
    _, rest, rows = prepared(model, folded.withColumn("label", F.col("label").cast("double")), [fold_col])
    return rows, lambda train, params: rest.fit(train, route(rest, params))


def score_candidates(folded: DataFrame, features: Sequence[str], model_type: str | Estimator,
                     candidates: Sequence[Mapping], folds: Sequence[int], metric: str = "recall",
                     run_id: int = 0, base_params: Mapping | None = None, fold_col: str = "fold",
                     parallelism: int = 4, return_train_score: bool = False) -> DataFrame:
    """Trials log rows for every (candidate, fold).  The rows are kept here, assembled,
    for all fits; ``folded`` need not be cached.
    ``model_type`` is one of the registry or an Estimator, whose candidates name
    its parameters (``stacking__rf__max_depth``); one whose selector keeps no
    feature has a missing score."""
    jobs = [(t, k) for t in range(len(candidates)) for k in folds]
    spark = folded.sparkSession
    out_path = output_path(spark, "trial-scores")
    rows, fit = _prepared(folded, features, model_type, fold_col)
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    fold = F.col(fold_col)

    def one(job):
        t, k = job
        params = {**(base_params or {}), **candidates[t]}
        try:
            model = fit(rows.filter(fold != k), params)
        except NothingSelected:
            return                      # the candidate has no score here
        asked = rows.filter(fold.isNotNull() if return_train_score else fold == k)
        split = F.when(fold == k, F.lit("test")).otherwise(F.lit("train"))
        scored = md.predict(model, asked.withColumn("split", split), keep=["split", "label"])
        # each (trial, fold) lands in its own folder of one table: counts for every distinct
        # score, from which all metrics follow, not a row for each prediction
        met.score_histogram(scored, ["split"]).write.mode("overwrite").parquet(f"{out_path}/trial_id={t}/fold={k}")

    try:
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            list(pool.map(one, jobs))
    finally:
        rows.unpersist()
    splits = ("test", "train") if return_train_score else ("test",)
    asked = spark.createDataFrame([(t, k, s) for t, k in jobs for s in splits], "trial_id int, fold int, split string")
    if is_written(spark, out_path):
        scored = met.evaluate_histogram(spark.read.parquet(out_path), ["trial_id", "fold", "split"], digits=None)
        scored = asked.join(scored, ["trial_id", "fold", "split"], "left")
    else:
        scored = asked.withColumn(metric, F.lit(None).cast("double"))
    params = folded.sparkSession.createDataFrame(
        [(i, dict((str(k), str(v)) for k, v in c.items())) for i, c in enumerate(candidates)],
        "trial_id int, params map<string,string>")
    return scored.join(F.broadcast(params), "trial_id").select(
        F.lit(run_id).alias("run_id"), "trial_id", "params", "fold",
        F.concat(F.lit(metric), F.when(F.col("split") == "train", F.lit("_train")).otherwise(F.lit("")))
        .alias("metric"), F.col(metric).alias("value"))


def rank_trials(trials: DataFrame, metric: str = "recall", digits: int | None = 6) -> DataFrame:
    """mean / population std over folds and min-rank per run (missing scores last)."""
    t = trials.filter(F.col("metric") == metric).groupBy("run_id", "trial_id").agg(
        F.avg("value").alias("mean_test_score"), F.stddev_pop("value").alias("std_test_score"))
    if digits is not None:
        t = t.withColumns({c: F.round(c, digits) for c in ("mean_test_score", "std_test_score")})
    w = Window.partitionBy("run_id").orderBy(F.col("mean_test_score").desc_nulls_last())
    return t.withColumn("rank_test_score", F.rank().over(w).cast("int"))


def best_trials(ranked: DataFrame) -> DataFrame:
    """First trial by (score desc, trial_id) per run."""
    w = Window.partitionBy("run_id").orderBy(F.col("mean_test_score").desc_nulls_last(), "trial_id")
    return ranked.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def best_with_params(trials: DataFrame, metric: str = "recall") -> DataFrame:
    """(run_id, trial_id, best_score, params): the best trial of each run."""
    params = trials.select("run_id", "trial_id", "params").dropDuplicates(["run_id", "trial_id"])
    return best_trials(rank_trials(trials, metric)).join(params, ["run_id", "trial_id"]).select(
        "run_id", "trial_id", F.col("mean_test_score").alias("best_score"), "params")


def save_search(trials: DataFrame, path: str, metric: str = "recall",
                fitted: md.FittedModel | None = None) -> dict[str, str]:
    """Write a search: its trial log, the ranked trials, the best parameters and
    score of each run, and the refitted model if given; what -> path."""
    paths = {"trials": write_table(trials, f"{path}/trials", partition_by=["run_id"])}
    back = read_table(trials.sparkSession, paths["trials"])
    paths["cv_results"] = write_table(rank_trials(back, metric), f"{path}/cv_results")
    paths["best"] = write_table(best_with_params(back, metric), f"{path}/best")
    if fitted is not None:
        paths["model"] = f"{path}/model"
        fitted.model.write().overwrite().save(paths["model"])
    return paths


def trial_history(ranked: DataFrame, digits: int | None = 6) -> DataFrame:
    """Per run, in trial order: score, std and the running best so far."""
    w = Window.partitionBy("run_id").orderBy("trial_id").rowsBetween(Window.unboundedPreceding, 0)
    out = ranked.select("run_id", F.col("trial_id").alias("iteration"), "mean_test_score", "std_test_score",
                        F.max("mean_test_score").over(w).alias("best_so_far"))
    return out


def trial_params(ranked: DataFrame, params: DataFrame) -> DataFrame:
    """(run_id, trial_id, param, param_value, score) long table."""
    return ranked.join(params, ["run_id", "trial_id"]).select(
        "run_id", "trial_id", F.explode("params").alias("param", "param_value"),
        F.col("mean_test_score").alias("score"))


IMPORTANCE_BINS = 10


def param_importance(slices: DataFrame, digits: int | None = 6, bins: int = IMPORTANCE_BINS) -> DataFrame:
    """Share of the trial-score variance that each parameter explains, normalised to
    sum to 1 per run: the variance between the parameter's groups less what groups
    of these sizes show by chance (epsilon squared).  Groups are the values; a
    numeric parameter of more than ``bins`` values is cut at its quantiles."""
    s = slices.filter(F.col("score").isNotNull())
    by = ["run_id", "param"]
    number = F.col("param_value").try_cast("double")
    of_param, in_order = Window.partitionBy(*by), Window.partitionBy(*by).orderBy("_x")
    s = s.withColumn("_x", number).withColumns({
        "_many": (F.size(F.collect_set("param_value").over(of_param)) > bins) & (F.count("_x").over(of_param) == F.count(F.lit(1)).over(of_param)),
        "_bin": F.floor((F.rank().over(in_order) - 1) * bins / F.count(F.lit(1)).over(of_param))})
    s = s.withColumn("param_value", F.when(F.col("_many"), F.col("_bin").cast("string")).otherwise(F.col("param_value")))
    tot = s.groupBy("run_id", "param").agg(F.avg("score").alias("_mu"), F.var_pop("score").alias("_var"),
                                           F.count(F.lit(1)).alias("_n"))
    grp = s.groupBy("run_id", "param", "param_value").agg(F.avg("score").alias("_gm"),
                                                          F.count(F.lit(1)).alias("_gn"))
    between = grp.join(tot, ["run_id", "param"]).groupBy("run_id", "param").agg(
        (F.sum(F.col("_gn") * (F.col("_gm") - F.col("_mu")) ** 2) / F.first("_n")).alias("_b"),
        F.first("_var").alias("_var"), F.first("_n").alias("_n"), F.count(F.lit(1)).alias("_k"))
    chance = F.greatest(F.col("_var") - F.col("_b"), F.lit(0.0)) * (F.col("_k") - 1) / (F.col("_n") - F.col("_k"))
    raw = between.withColumn("_r", F.when((F.col("_var") > 0) & (F.col("_n") > F.col("_k")), F.greatest(
        (F.col("_b") - chance) / F.col("_var"), F.lit(0.0))).otherwise(F.lit(0.0)))
    w = Window.partitionBy("run_id")
    imp = F.when(F.sum("_r").over(w) > 0, F.col("_r") / F.sum("_r").over(w)).otherwise(F.lit(0.0))
    out = raw.select("run_id", "param", imp.alias("importance"))
    return out.withColumn("importance", F.round("importance", digits)) if digits is not None else out


def param_histogram(slices: DataFrame, bins: int = 20) -> DataFrame:
    """Counts of numeric parameter values in ``bins`` equal-width bins per
    (run, param); the last bin is closed."""
    v = slices.withColumn("_v", F.col("param_value").try_cast("double")).filter(F.col("_v").isNotNull())
    r = v.groupBy("run_id", "param").agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    x = v.join(r, ["run_id", "param"])
    b = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * bins), F.lit(bins - 1)))
    return x.withColumn("bin", b.cast("int")).groupBy("run_id", "param", "bin") \
        .agg(F.count(F.lit(1)).alias("n_trials"))


def halving_schedule(n_rows: int, n_candidates: int, factor: int = 2, min_resources="exhaust",
                     n_classes: int = 2, cv: int = 5) -> list[tuple[int, int, int]]:
    """(round, resources, candidates) of successive halving over rows."""
    n_required = 1 + int(math.floor(math.log(n_candidates, factor) + 1e-12)) if n_candidates > 1 else 1
    if min_resources == "exhaust":
        r0 = max(1, n_rows // factor ** (n_required - 1))
    elif min_resources == "smallest":
        r0 = 2 * cv * n_classes
    else:
        r0 = int(min_resources)
    n_possible = 1 + int(math.floor(math.log(max(1, n_rows // r0), factor) + 1e-12))
    n_iter = min(n_possible, n_required)
    out = []
    for i in range(n_iter):
        out.append((i, r0 * factor ** i, math.ceil(n_candidates / factor ** i)))
    return out


def halving_candidates(space: Mapping, n_rows: int, n_candidates: int | str = "exhaust", factor: int = 2,
                       min_resources="smallest", n_classes: int = 2, cv: int = 5, seed: int = 42) -> list[dict]:
    """Random candidates of a halving search; ``exhaust`` draws as many as the rows
    allow at the size of the first round."""
    if n_candidates == "exhaust":
        first = halving_schedule(n_rows, 1, factor, min_resources, n_classes, cv)[0][1]
        n_candidates = max(1, n_rows // first)
    return random_candidates(space, int(n_candidates), seed)


def halving_search(ranked_rows: DataFrame, features: Sequence[str], model_type: str | Estimator,
                   candidates: Sequence[Mapping], schedule, k: int = 3, metric: str = "recall",
                   seed: int = 42, rank_col: str = "sample_rank", parallelism: int = 4, key: str = "row_id") -> DataFrame:
    """Successive halving: round i scores the surviving candidates on the rows
    with ``sample_rank <= resources_i`` (nested samples; ``sampling.nested_order``
    keeps the label's shares in each) and keeps the best
    ``ceil(n / factor)``.  Returns the trials log of every round (run_id = round)."""
    from tabsmith.operators.sampling import kfold
    ranked_rows = materialize(ranked_rows, "halving-order")     # every round reads a prefix of it
    alive = list(range(len(candidates)))
    logs = []
    for i, (rnd, resources, _) in enumerate(schedule):
        sample = ranked_rows.filter(F.col(rank_col) <= resources)
        folded = even(kfold(sample, key, k, seed, strata=["label"]), resources)
        trials = score_candidates(folded, features, model_type, [candidates[j] for j in alive],
                                  range(1, k + 1), metric, run_id=rnd, parallelism=parallelism)
        ids = F.array(*[F.lit(j) for j in alive])
        trials = materialize(trials.withColumn("trial_id", F.element_at(ids, F.col("trial_id") + 1)), "halving-round")
        ranked = rank_trials(trials, metric).orderBy(F.col("mean_test_score").desc_nulls_last(), "trial_id")
        order = [r["trial_id"] for r in ranked.select("trial_id").collect()]   # one row per candidate
        logs.append(trials)
        if i + 1 < len(schedule):
            alive = order[:schedule[i + 1][2]]
    out = logs[0]
    for part in logs[1:]:
        out = out.unionByName(part)
    return out


def refit_best(train: DataFrame, features: Sequence[str], model_type: str | Estimator, candidates: Sequence[Mapping],
               trials: DataFrame, metric: str = "recall", base_params: Mapping | None = None):
    """Pick the first trial by (mean score desc, trial_id) and fit it on all
    training rows; returns (trial_id, params, FittedModel)."""
    ranked = rank_trials(trials, metric).orderBy(F.col("mean_test_score").desc_nulls_last(), "trial_id")
    best = ranked.select("trial_id").first()["trial_id"]
    params = {**(base_params or {}), **candidates[best]}
    return best, params, fit_candidate(train, features, model_type, params, keep_rows=True)
