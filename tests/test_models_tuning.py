"""Model registry, fits, attribution and search helpers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabsmith.operators import explain as ex
from tabsmith.operators import models as md
from tabsmith.operators import tuning as tu


def _planted(spark, n=2000):
    df = spark.range(n).select(
        "id", (F.col("id") % 97 / 97.0).alias("x1"), (F.col("id") * 7 % 13 / 13.0).alias("x2"),
        (F.col("id") % 5).cast("double").alias("x3"))
    return df.withColumn("label", ((F.col("x1") + 0.3 * F.col("x2")) > 0.6).cast("int")) \
        .withColumnRenamed("id", "row_id")


def test_range_expansion_and_unknown_type(spark):
    assert md.expand_range("range(3, 30, 2)") == list(range(3, 30, 2))
    assert md.expand_range("range(5)") == [0, 1, 2, 3, 4]
    assert md.expand_range("__import__('os')") == "__import__('os')"
    with pytest.raises(ValueError):
        md.create_estimator("svm", {})
    est, ignored = md.create_estimator("xgboost", {"max_depth": 4, "reg_lambda": 1.0, "gamma": 0.1})
    assert est.getMaxDepth() == 4 and set(ignored) == {"reg_lambda", "gamma"}
    est, _ = md.create_estimator("lightgbm", {"num_leaves": 31})
    assert est.getMaxDepth() == 5


def test_fit_planted_signal_and_round_trip(spark, tmp_path):
    from tabsmith.operators.metrics import roc_auc
    df = _planted(spark)
    fm = md.fit_model(df, ["x1", "x2", "x3"], "decision_tree", {"max_depth": 4})
    p = md.predict(fm, df, keep=["row_id", "label"])
    assert roc_auc(p).first()["auc_roc"] > 0.9
    path = str(tmp_path / "m")
    fm.model.write().overwrite().save(path)
    loaded = md.predict(md.PipelineModel.load(path), df, keep=["row_id"])
    assert p.select("row_id", "probability").exceptAll(loaded.select("row_id", "probability")).count() == 0


def test_tree_shapley_efficiency(spark):
    df = _planted(spark, 600)
    feats = ["x1", "x2", "x3"]
    fm = md.fit_model(df, feats, "decision_tree", {"max_depth": 3})
    tables, weights = ex.tree_tables(fm.classifier)
    X = np.array([[r[f] for f in feats] for r in df.limit(50).collect()])
    Z = np.array([[r[f] for f in feats] for r in df.orderBy(F.rand(1)).limit(20).collect()])
    phi = ex.shapley_batch(X, Z, tables, weights)
    fx = np.array([ex._predict_tree(tables[0], x) for x in X])
    base = np.mean([ex._predict_tree(tables[0], z) for z in Z])
    assert np.allclose(phi.sum(axis=1), fx - base, atol=1e-9)


def test_linear_attribution_sums_to_centered_margin(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 6.0)], "a double, b double")
    out = ex.linear_contributions(df, ["a", "b"], [2.0, -1.0], digits=None).collect()
    assert out[0]["contrib_a"] == -2.0 and out[0]["contrib_b"] == 2.0


def test_top_k_tie_break_by_position(spark):
    df = spark.createDataFrame([(1.0, -1.0, 0.5)], "a double, b double, c double")
    r = df.select(*ex.top_k_columns(["a", "b", "c"], [F.col("a"), F.col("b"), F.col("c")], k=2)).first()
    assert (r["Feature_1_Name"], r["Feature_2_Name"]) == ("a", "b")


def test_grid_guard_random_and_namespaced():
    space = {"a": [1, 2, 3], "b": "range(0, 4)"}
    assert tu.grid_size(space) == 12 and len(tu.grid_candidates(space)) == 12
    with pytest.raises(tu.TooManyTrials):
        tu.grid_candidates({"x": list(range(1000)), "y": list(range(1000))}, max_trials=100)
    r = tu.random_candidates({"x": list(range(1000)), "y": list(range(1000))}, 5, seed=1)
    assert len({tuple(sorted(c.items())) for c in r}) == 5
    flat = tu.flatten_namespaced({"stacking": {"xgb": {"max_depth": [3, 4]}}, "meta": {"C": [1.0]}})
    assert flat == {"stacking__xgb__max_depth": [3, 4], "meta__C": [1.0]}
    assert tu.route_namespaced(flat)["stacking"]["xgb"]["max_depth"] == [3, 4]
    c = tu.space_candidates({"d": {"type": "int", "low": 2, "high": 6},
                             "lr": {"type": "real", "low": 1e-3, "high": 1.0, "prior": "log-uniform"}}, 10, 3)
    assert all(2 <= x["d"] <= 6 and 1e-3 <= x["lr"] <= 1.0 for x in c)


def test_halving_schedule():
    s = tu.halving_schedule(8000, 9, factor=2, min_resources="exhaust")
    assert [r for _, r, _ in s] == [1000, 2000, 4000, 8000]
    assert [c for _, _, c in s] == [9, 5, 3, 2]
    s = tu.halving_schedule(10000, 20, factor=2, min_resources="smallest", n_classes=2, cv=5)
    assert s[0][1] == 20


def test_scorer_accepts_records(spark):
    from tabsmith.plans import scoring
    df = _planted(spark, 500)
    fm = md.fit_model(df, ["x1", "x2", "x3"], "logistic_reg", {"C": 10.0})
    sc = scoring.make_scorer(fm, {"x1": {"method": "standard", "shift": 0.5, "scale": 0.3}}, threshold=0.4)
    out = sc.score([{"row_id": 1, "x1": 0.9, "x2": 0.5, "x3": 1.0}, {"row_id": 2, "x1": 0.1, "x2": 0.1, "x3": 0.0}],
                   id_col="row_id").collect()
    assert [r["row_id"] for r in out] == [1, 2]
    assert all(r["prediction"] == int(r["probability"] >= 0.4) for r in out)


def test_score_candidates_and_refit_best(spark):
    from tabsmith.operators.sampling import kfold
    df = _planted(spark, 800)
    folded = kfold(df, "row_id", 3).cache()
    cands = [{"max_depth": 1}, {"max_depth": 4}]
    trials = tu.score_candidates(folded, ["x1", "x2", "x3"], "decision_tree", cands, [1, 2, 3], "f1")
    assert trials.filter("metric = 'f1'").count() == 6
    ranked = {r["trial_id"]: r for r in tu.rank_trials(trials, "f1").collect()}
    assert ranked[1]["mean_test_score"] >= ranked[0]["mean_test_score"]
    best, params, fm = tu.refit_best(folded, ["x1", "x2", "x3"], "decision_tree", cands, trials, "f1")
    assert best == 1 and params == {"max_depth": 4} and fm.classifier.getMaxDepth() == 4
    folded.unpersist()
