"""Rows that learners read: even parts, assembled once; searches keep counts of scores."""

import threading
import time

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabsmith import session
from tabsmith.operators import metrics as met
from tabsmith.operators import models as md
from tabsmith.operators import sampling as sm
from tabsmith.operators import tree_shap as ts
from tabsmith.operators import tuning as tu
from tabsmith.plans import cases_models as cm

from tests.conftest import SF001

FEATS = ["x1", "x2"]


def _rows(spark, n):
    x1, x2 = F.col("id") % 97 / 97.0, F.col("id") * 7 % 13 / 13.0
    return spark.range(n).select(F.col("id").alias("row_id"), x1.alias("x1"), x2.alias("x2"), (x1 + 0.3 * x2 > 0.6).cast("int").alias("label"))


def test_parts_do_not_grow_with_the_rows(spark):
    cores = spark.sparkContext.defaultParallelism
    few, many = (session.learner_partitions(spark, n) for n in (10_000_000 // 8 * cores, 1_000_000 * cores))
    assert few == many == session.LEARNER_ROUNDS * cores
    assert session.learner_partitions(spark, 9_000) == 1
    assert session.learner_partitions(spark, 10 * session.MOST_ROWS_PER_PARTITION * cores) == 10 * cores   # parts stay below their size


def test_parts_are_even(spark):
    n = 45_000
    folded = session.even(sm.kfold(_rows(spark, n), "row_id", 3, strata=["label"]), n)
    sizes = [r["n"] for r in folded.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == n and len(sizes) == 5 and max(sizes) < 1.01 * min(sizes)


def test_metrics_from_counts_of_scores(spark):
    scored = _rows(spark, 3_000).select("label", (F.col("row_id") % 2).cast("int").alias("prediction"), (F.col("x2") * F.col("x1")).alias("probability"), (F.col("row_id") % 3).alias("g"))
    whole = met.evaluate(scored, ["g"], digits=None).orderBy("g").collect()
    counts = met.evaluate_histogram(met.score_histogram(scored, ["g"]), ["g"], digits=None).orderBy("g").collect()
    assert whole == counts


def test_search_keeps_a_row_for_a_score_not_for_a_prediction(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tu, "output_path", lambda *_: str(tmp_path / "scores"))
    folded = sm.kfold(_rows(spark, 2_000), "row_id", 2, strata=["label"])
    trials = tu.score_candidates(folded, FEATS, "decision_tree", [{"max_depth": 2}], [1, 2], "recall", return_train_score=True).collect()
    assert len(trials) == 4 and all(0 <= r["value"] <= 1 for r in trials)
    kept = spark.read.parquet(str(tmp_path / "scores"))
    assert kept.count() <= 4 * 4 and kept.agg(F.sum("n")).first()[0] == 4_000


def test_fit_assembled_is_fit_model(spark):
    rows = _rows(spark, 3_000)
    fm = md.fit_model(rows, FEATS, "decision_tree", {"max_depth": 3})
    same = md.fit_assembled(md.assembled(rows, FEATS), FEATS, "decision_tree", {"max_depth": 3})
    p = [np.array(sorted(tuple(r) for r in md.predict(m, rows, keep=["row_id"]).collect())) for m in (fm, same)]
    assert np.array_equal(*p)
    packed = md.assembled(rows, FEATS).select(vector_to_array(md.FEATURES).alias("v")).first()["v"]
    assert packed == [rows.first()[f] for f in FEATS]


def test_patterns_give_what_every_row_gives(monkeypatch):
    rng, inf = np.random.default_rng(3), np.inf
    leaves = [ts.Leaf(float(rng.random()), np.arange(d), rng.uniform(0.05, 0.95, d), np.where(rng.random(d) < 0.5, -inf, 0.3),
                      np.where(rng.random(d) < 0.5, inf, 0.8)) for d in (0, 1, 2, 5, ts.MAX_PATTERN, ts.MAX_PATTERN + 2) for _ in range(4)]
    forest, rows = ts.TreeEnsemble(leaves, 0.0), rng.random((500, ts.MAX_PATTERN + 2))
    rows[rng.random(rows.shape) < 0.05] = np.nan
    rows[0], rows[1] = -inf, inf
    tables = ts.pattern_tables(forest)
    assert [t is None for t in tables] == [len(leaf.features) in (0, ts.MAX_PATTERN + 2) for leaf in leaves]
    monkeypatch.setattr(ts, "MAX_TESTS", 3)
    assert np.array_equal(ts.path_shapley(rows, forest, tables), ts.path_shapley(rows, forest, [None] * len(leaves)))


def test_halving_ranks_its_rows_once(spark, monkeypatch):
    names, write = [], tu.materialize
    monkeypatch.setattr(tu, "materialize", lambda df, name: names.append(name) or write(df, name))
    ranked = sm.nested_order(_rows(spark, 2_000), "label", "row_id")
    trials = tu.halving_search(ranked, FEATS, "decision_tree", [{"max_depth": d} for d in (1, 2)], [(0, 1_000, 2), (1, 2_000, 1)], k=2)
    assert trials.count() == 6 and names.count("halving-order") == 1
    log = trials._jdf.queryExecution().analyzed().toString()
    assert "Window" not in log


def test_models_of_one_table_share_its_rows(spark, monkeypatch):
    dealt, deal = [], md.even
    monkeypatch.setattr(md, "even", lambda df, n: dealt.append(n) or deal(df, n))
    monkeypatch.setattr(cm, "CONFIGS", {m: cm.CONFIGS[m] for m in ("decision_tree", "logistic_reg")})
    scored = cm.scored_rows(spark, SF001)
    assert len(dealt) == 1                                                                   # not once for every model
    assert {r["model"] for r in scored.select("model").distinct().collect()} == {"decision_tree", "logistic_reg"}
    assert scored.filter("in_range").count() == scored.count() == 2 * cm._train_test(spark, SF001)[1].count()


def test_models_fitted_together_are_those_fitted_alone(spark):
    rows = _rows(spark, 12_000)
    configs = {"decision_tree": {"max_depth": 3}, "gbdt": {"n_estimators": 3, "subsample": 0.8, "n_iter_no_change": 2},
               "logistic_reg": {"C": 10.0}, "random_forest": {"n_estimators": 4, "max_depth": 3}}
    together = md.fit_models(rows, FEATS, configs)
    assert list(together) == list(configs)
    for model_type, params in configs.items():
        fms = together[model_type], md.fit_model(rows, FEATS, model_type, params)
        p = [np.array(sorted(tuple(r) for r in md.predict(fm, rows, keep=["row_id"]).collect())) for fm in fms]
        assert np.allclose(*p, rtol=0, atol=1e-9)
    assert not spark.sparkContext._jsc.sc().getPersistentRDDs().size()


def _fits_under_way(monkeypatch, levels, most):
    lock, now = threading.Lock(), [0]
    fit = md.fit_assembled

    def watched(rows, *args, **kwargs):
        with lock:
            now[0] += 1
            most.append(now[0])
            levels.append(rows.storageLevel)
        time.sleep(0.5)
        try:
            return fit(rows, *args, **kwargs)
        finally:
            with lock:
                now[0] -= 1
    monkeypatch.setattr(md, "fit_assembled", watched)


def test_fits_that_memory_does_not_hold_run_one_at_a_time(spark, monkeypatch):
    rows, configs = _rows(spark, 2_000), {"decision_tree": {"max_depth": 2}, "logistic_reg": {}, "random_forest": {"n_estimators": 2, "max_depth": 2}}
    need = 2_000 * (md.BYTES_OF_A_FIT + 8 * len(FEATS))
    for memory, at_once in ((need // 2, 1), (2 * need - 1, 1), (2 * need, 2), (20 * need, 2)):
        levels, most = [], []
        with monkeypatch.context() as m:
            m.setattr(md, "storage_memory", lambda _: memory)
            _fits_under_way(m, levels, most)
            assert list(md.fit_models(rows, FEATS, configs)) == list(configs)
        assert max(most) == at_once
        assert len(levels) == 3 and not any(level.useMemory for level in levels)     # learners keep their own copy in memory
    assert md.fits_at_a_time(spark, 2_000, 2) == 2 and 0 < session.storage_memory(spark) < 8 << 30
