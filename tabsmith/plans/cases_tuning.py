"""Registered checks: hyper-parameter search (T1-T10) and the trials sink (K5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.operators import models as md
from tabsmith.operators import sampling as sm
from tabsmith.operators import tuning as tu
from tabsmith.plans import fixtures as fx
from tabsmith.plans.cases_models import FEATURES, _train_test
from tabsmith.plans.cases_sampling import keyed_orders
from tabsmith.session import even, materialize, output_path
from tabsmith.sources import io

N_TRIALS = 40
N_RUNS = 3
N_FOLDS = 5
NULL_TRIAL = 7
# The search spaces of the fitted checks (small, like a
# tune config's grid) and the halving grid.
TREE_GRID = {"max_depth": [3, 5], "min_samples_leaf": "range(5, 30, 20)"}
TREE_SPACE = {"max_depth": {"type": "int", "low": 2, "high": 6},
              "min_info_gain": {"type": "real", "low": 1e-4, "high": 1e-1, "prior": "log-uniform"},
              "criterion": {"type": "categorical", "categories": ["gini", "entropy"]}}
HALVING_GRID = {"solver": ["lbfgs", "sag", "saga"], "max_iter": [100, 500, 1000]}


def trials_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Experiment log derived from ``events``: run = event_id % 3, trial =
    event_id % 40, fold = user_id % 5 + 1, value = attendance rate; params are
    formulas of the trial number; one trial's score is missing."""
    e = fx.table(spark, sf_dir, "events").select(
        (F.col("event_id") % N_RUNS).cast("int").alias("run_id"),
        (F.col("event_id") % N_TRIALS).cast("int").alias("trial_id"),
        (F.col("user_id") % N_FOLDS + 1).cast("int").alias("fold"),
        (F.col("event_type") != "error").cast("int").alias("attended"))
    g = e.groupBy("run_id", "trial_id", "fold").agg(F.avg("attended").alias("value"))
    t = F.col("trial_id")
    params = F.create_map(
        F.lit("max_depth"), (t % 5 + 2).cast("string"),
        F.lit("learning_rate"), ((t % 4 + 1) / 100.0).cast("string"),
        F.lit("criterion"), F.when(t % 2 == 0, F.lit("gini")).otherwise(F.lit("entropy")))
    return g.select("run_id", "trial_id", params.alias("params"), "fold", F.lit("recall").alias("metric"),
                    F.when(t == NULL_TRIAL, F.lit(None).cast("double")).otherwise(F.col("value")).alias("value"))


def _params(spark, sf_dir):
    return trials_log(spark, sf_dir).select("run_id", "trial_id", "params").dropDuplicates(["run_id", "trial_id"])


def trial_rank(spark, sf_dir):
    return tu.rank_trials(trials_log(spark, sf_dir))


def best_trial(spark, sf_dir):
    b = tu.best_trials(trial_rank(spark, sf_dir)).join(_params(spark, sf_dir), ["run_id", "trial_id"])
    return b.select("run_id", "trial_id", F.col("mean_test_score").alias("best_score"),
                    *[F.col("params")[k].alias(k) for k in ("max_depth", "learning_rate", "criterion")])


def trial_history(spark, sf_dir):
    return tu.trial_history(trial_rank(spark, sf_dir))


def param_slice(spark, sf_dir):
    return tu.trial_params(trial_rank(spark, sf_dir), _params(spark, sf_dir))


def param_importance(spark, sf_dir):
    return tu.param_importance(param_slice(spark, sf_dir))


def param_histogram(spark, sf_dir):
    return tu.param_histogram(param_slice(spark, sf_dir))


PARAMS = ("max_depth", "learning_rate", "criterion")


def _write_trials(spark, sf_dir):
    return tu.save_search(trials_log(spark, sf_dir), output_path(spark, "trials"))


def write_trials(spark, sf_dir):
    """Write the trial log, the ranked trials and each run's best row; read the
    log back.  ``write_best_trials`` reads the best rows."""
    back = io.read_table(spark, _write_trials(spark, sf_dir)["trials"])
    return back.select("run_id", "trial_id", "fold", "metric", F.round("value", 6).alias("value"),
                       *[F.col("params")[k].alias(k) for k in PARAMS])


def write_best_trials(spark, sf_dir):
    back = io.read_table(spark, _write_trials(spark, sf_dir)["best"])
    return back.select("run_id", "trial_id", "best_score", *[F.col("params")[k].alias(k) for k in PARAMS])


# ---- fitted searches on the model fixture


def _folded(spark, sf_dir, k=3):
    train = _train_test(spark, sf_dir)[0].select("row_id", "label", *FEATURES)
    return even(sm.kfold(train, "row_id", k, fx.SEED, strata=["label"]), train.count())


def _search(spark, sf_dir, candidates, k=3):
    trials = tu.score_candidates(_folded(spark, sf_dir, k), FEATURES, "decision_tree", candidates, range(1, k + 1),
                                 "recall", base_params={"random_state": 42}, return_train_score=True)
    return materialize(trials, "trials")


def grid_search(spark, sf_dir):
    return tu.rank_trials(_search(spark, sf_dir, tu.grid_candidates(TREE_GRID, max_trials=16)))


def write_tuned_model(spark, sf_dir):
    """Grid search, refit of the best candidate on all training rows, all of it
    written; the model read back scores the test rows."""
    train, test = _train_test(spark, sf_dir)
    cands = tu.grid_candidates(TREE_GRID, max_trials=16)
    trials = _search(spark, sf_dir, cands)
    _, _, fm = tu.refit_best(train, FEATURES, "decision_tree", cands, trials, base_params={"random_state": 42})
    paths = tu.save_search(trials, output_path(spark, "search"), fitted=fm)
    loaded = md.FittedModel(md.PipelineModel.load(paths["model"]), fm.model_type, fm.features)
    return md.predict(loaded, test, keep=["row_id", "label"])


def random_search(spark, sf_dir):
    return tu.rank_trials(_search(spark, sf_dir, tu.random_candidates(TREE_GRID, 3, fx.SEED)))


def space_search(spark, sf_dir):
    cands = [{"max_depth": c["max_depth"], "min_impurity_decrease": c["min_info_gain"],
              "criterion": c["criterion"]} for c in tu.space_candidates(TREE_SPACE, 3, fx.SEED)]
    return tu.rank_trials(_search(spark, sf_dir, cands))


def trial_scores(spark, sf_dir):
    return _search(spark, sf_dir, tu.grid_candidates(TREE_GRID, max_trials=16))


def halving_samples(spark, sf_dir):
    """Rows and positives in each round's nested sample, for both starts of a search
    over the halving grid: as small as it may be, or so that the last round takes
    all rows."""
    rows = sm.nested_order(keyed_orders(spark, sf_dir), "label", "row_id", fx.SEED, tag="halving")
    n = rows.count()
    rounds = [(start, *r) for start in ("exhaust", "smallest")
              for r in tu.halving_schedule(n, tu.grid_size(HALVING_GRID), factor=2, min_resources=start)]
    agg = rows.agg(*[F.count_if(F.col("sample_rank") <= r).alias(f"n{i}") for i, (_, _, r, _) in enumerate(rounds)],
                   *[F.count_if((F.col("sample_rank") <= r) & (F.col("label") == 1)).alias(f"p{i}")
                     for i, (_, _, r, _) in enumerate(rounds)])
    stack = ", ".join(f"'{s}', {k}, CAST({r} AS BIGINT), {c}, n{i}, p{i}" for i, (s, k, r, c) in enumerate(rounds))
    return agg.selectExpr(f"stack({len(rounds)}, {stack}) AS (start, round, n_resources, n_candidates, n_rows, n_positive)")


def _halve(spark, sf_dir, candidates, min_resources):
    train = _train_test(spark, sf_dir)[0].select("row_id", "label", *FEATURES)
    ranked = sm.nested_order(train, "label", "row_id", fx.SEED, tag="halving")
    sched = tu.halving_schedule(train.count(), len(candidates), factor=2, min_resources=min_resources, cv=3)
    return tu.halving_search(ranked, FEATURES, "decision_tree", candidates, sched, k=3, seed=fx.SEED)


def halving_search(spark, sf_dir):
    """Halving over a decision-tree grid on the model fixture (rows = resource)."""
    return _halve(spark, sf_dir, tu.grid_candidates(TREE_GRID, max_trials=16), "exhaust")


def halving_random_search(spark, sf_dir):
    """Halving over random candidates, from the smallest sample on."""
    train, _ = _train_test(spark, sf_dir)
    return _halve(spark, sf_dir, tu.halving_candidates(TREE_GRID, train.count(), 4, cv=3, seed=fx.SEED), "smallest")


QUERIES = {
    "trial_rank": trial_rank,
    "best_trial": best_trial,
    "trial_history": trial_history,
    "param_slice": param_slice,
    "param_importance": param_importance,
    "param_histogram": param_histogram,
    "write_trials": write_trials,
    "write_best_trials": write_best_trials,
    "write_tuned_model": write_tuned_model,
    "grid_search": grid_search,
    "random_search": random_search,
    "space_search": space_search,
    "trial_scores": trial_scores,
    "halving_samples": halving_samples,
    "halving_search": halving_search,
    "halving_random_search": halving_random_search,
}

# ---------------------------------------------------------------- SQL twins

TRIALS = f"""e AS (SELECT CAST(event_id % {N_RUNS} AS INTEGER) AS run_id, CAST(event_id % {N_TRIALS} AS INTEGER) AS trial_id,
      CAST(user_id % {N_FOLDS} + 1 AS INTEGER) AS fold, CAST(event_type <> 'error' AS INTEGER) AS attended FROM events),
  tl AS (SELECT run_id, trial_id, fold, CASE WHEN trial_id = {NULL_TRIAL} THEN NULL ELSE avg(attended) END AS value
      FROM e GROUP BY run_id, trial_id, fold),
  rk0 AS (SELECT run_id, trial_id, round(avg(value), 6) AS mean_test_score, round(stddev_pop(value), 6) AS std_test_score
      FROM tl GROUP BY run_id, trial_id),
  rk AS (SELECT *, CAST(rank() OVER (PARTITION BY run_id ORDER BY mean_test_score DESC NULLS LAST) AS INTEGER)
      AS rank_test_score FROM rk0),
  pr AS (SELECT DISTINCT run_id, trial_id, CAST(trial_id % 5 + 2 AS VARCHAR) AS max_depth,
      CAST((trial_id % 4 + 1) / 100.0 AS VARCHAR) AS learning_rate,
      CASE WHEN trial_id % 2 = 0 THEN 'gini' ELSE 'entropy' END AS criterion FROM tl),
  sl AS (SELECT rk.run_id, rk.trial_id, p.param, p.param_value, rk.mean_test_score AS score FROM rk JOIN (
        SELECT run_id, trial_id, 'max_depth' AS param, max_depth AS param_value FROM pr
        UNION ALL SELECT run_id, trial_id, 'learning_rate', learning_rate FROM pr
        UNION ALL SELECT run_id, trial_id, 'criterion', criterion FROM pr) p
      ON rk.run_id = p.run_id AND rk.trial_id = p.trial_id)"""

_N_HALV = tu.grid_size(HALVING_GRID)
_SCHED_ROUNDS = 1 + int(__import__("math").floor(__import__("math").log(_N_HALV, 2) + 1e-12))

SQL = {
    "write_trials": f"""WITH {TRIALS} SELECT tl.run_id, tl.trial_id, tl.fold, 'recall' AS metric,
        round(tl.value, 6) AS value, pr.max_depth, pr.learning_rate, pr.criterion
        FROM tl JOIN pr ON tl.run_id = pr.run_id AND tl.trial_id = pr.trial_id""",
    "trial_rank": f"WITH {TRIALS} SELECT * FROM rk",
    "best_trial": f"""WITH {TRIALS}, b AS (SELECT *, row_number() OVER (PARTITION BY run_id
        ORDER BY mean_test_score DESC NULLS LAST, trial_id) AS r FROM rk)
        SELECT b.run_id, b.trial_id, b.mean_test_score AS best_score, pr.max_depth, pr.learning_rate, pr.criterion
        FROM b JOIN pr ON b.run_id = pr.run_id AND b.trial_id = pr.trial_id WHERE r = 1""",
    "trial_history": f"""WITH {TRIALS} SELECT run_id, trial_id AS iteration, mean_test_score, std_test_score,
        max(mean_test_score) OVER (PARTITION BY run_id ORDER BY trial_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        AS best_so_far FROM rk""",
    "param_slice": f"WITH {TRIALS} SELECT * FROM sl",
    "param_importance": f"""WITH {TRIALS}, s0 AS (SELECT *, try_cast(param_value AS DOUBLE) AS x FROM sl WHERE score IS NOT NULL),
        s AS (SELECT run_id, param, score, CASE WHEN (SELECT count(DISTINCT o.param_value) FROM s0 o
                  WHERE o.run_id = s0.run_id AND o.param = s0.param) > 10 AND bool_and(x IS NOT NULL) OVER (PARTITION BY run_id, param)
                THEN CAST((rank() OVER (PARTITION BY run_id, param ORDER BY x) - 1) * 10 // count(*) OVER (PARTITION BY run_id, param)
                  AS VARCHAR) ELSE param_value END AS param_value FROM s0),
        tot AS (SELECT run_id, param, avg(score) AS mu, var_pop(score) AS v, count(*) AS n FROM s GROUP BY run_id, param),
        grp AS (SELECT run_id, param, param_value, avg(score) AS gm, count(*) AS gn FROM s GROUP BY run_id, param, param_value),
        btw AS (SELECT g.run_id, g.param, sum(g.gn * (g.gm - t.mu) * (g.gm - t.mu)) / max(t.n) AS b, max(t.v) AS v,
                max(t.n) AS n, count(*) AS k FROM grp g JOIN tot t ON g.run_id = t.run_id AND g.param = t.param GROUP BY g.run_id, g.param),
        raw AS (SELECT run_id, param, CASE WHEN v > 0 AND n > k
            THEN greatest((b - greatest(v - b, 0e0) * (k - 1) / (n - k)) / v, 0e0) ELSE 0e0 END AS r FROM btw)
        SELECT run_id, param, round(CASE WHEN sum(r) OVER (PARTITION BY run_id) > 0
            THEN r / sum(r) OVER (PARTITION BY run_id) ELSE 0.0 END, 6) AS importance FROM raw""",
    "param_histogram": f"""WITH {TRIALS}, v AS (SELECT *, try_cast(param_value AS DOUBLE) AS x FROM sl),
        v2 AS (SELECT * FROM v WHERE x IS NOT NULL),
        r AS (SELECT run_id, param, min(x) AS lo, max(x) AS hi FROM v2 GROUP BY run_id, param)
        SELECT v2.run_id, v2.param, CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((x - lo) / (hi - lo) * 20), 19) END
            AS INTEGER) AS bin, count(*) AS n_trials
        FROM v2 JOIN r ON v2.run_id = r.run_id AND v2.param = r.param GROUP BY ALL""",
    "halving_samples": f"""WITH o AS (SELECT o_orderkey AS row_id, CAST(o_orderpriority = '5-LOW' AS INTEGER) AS label FROM orders),
        c AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(CAST(row_id AS VARCHAR) || '|{fx.SEED}|halving'), row_id) AS r,
                count(*) OVER (PARTITION BY label) AS n_class FROM o),
        p AS (SELECT *, row_number() OVER (ORDER BY CAST(2 * r - 1 AS DOUBLE) / n_class, label) AS sample_rank FROM c),
        n AS (SELECT count(*) AS n FROM o),
        st AS (SELECT 'exhaust' AS start, n, n // CAST(pow(2, {_SCHED_ROUNDS} - 1) AS BIGINT) AS first FROM n
               UNION ALL SELECT 'smallest', n, 20 FROM n),
        sch AS (SELECT start, CAST(i AS INTEGER) AS round, first * CAST(pow(2, i) AS BIGINT) AS n_resources,
                CAST(ceil({_N_HALV} / pow(2, i)) AS INTEGER) AS n_candidates FROM st, range({_SCHED_ROUNDS}) t(i)
                WHERE first * CAST(pow(2, i) AS BIGINT) <= n)
        SELECT start, round, n_resources, n_candidates, count_if(sample_rank <= n_resources) AS n_rows,
               count_if(sample_rank <= n_resources AND label = 1) AS n_positive
        FROM sch, p GROUP BY start, round, n_resources, n_candidates""",
}
SQL["write_best_trials"] = SQL["best_trial"]
