"""Stacking, selection and nested parameter names as Spark ML stages."""

import time

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import functions as F

from tabsmith.functions.hashing import hash_hex, hash_unit
from tabsmith.operators import metrics as met
from tabsmith.operators import models as md
from tabsmith.operators import stacking as st
from tabsmith.operators import tuning as tu

FEATS = ["x1", "x2", "x3", "noise"]
CONFIG = {
    "is_stacking": True,
    "feature_selector": {"enabled": True, "type": "decision_tree", "params": {"max_depth": 4}, "threshold": "0.5*mean"},
    "base_models": [{"name": "tree", "type": "decision_tree", "params": {"max_depth": 3}},
                    {"name": "line", "type": "logistic_reg", "params": {"C": 1.0}}],
    "meta_learner": {"type": "logistic_reg", "params": {"penalty": "l2", "C": 1.0}},
}


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(900).select(F.col("id").alias("row_id"), (F.col("id") % 97 / 97.0).alias("x1"),
                                 (F.col("id") * 7 % 13 / 13.0).alias("x2"), (F.col("id") % 5).cast("double").alias("x3"),
                                 hash_unit(hash_hex(["id"], "n")).alias("noise"))
    out = df.withColumn("label", ((F.col("x1") + 0.3 * F.col("x2")) > 0.6).cast("double")).cache()
    yield out
    out.unpersist()


def scores(model, rows):
    return {r["row_id"]: r["probability"] for r in md.predict(model, rows, keep=["row_id"]).collect()}


def test_pipeline_saves_loads_and_scores_alike(rows, tmp_path):
    fitted = st.pipeline_from_config(CONFIG, FEATS, 3).fit(rows)
    selector, stack = fitted.stages[1:]
    assert "x1" in selector.selected and "x3" not in selector.selected
    assert met.roc_auc(md.predict(fitted, rows, keep=["row_id", "label"])).first()["auc_roc"] > 0.95
    fitted.write().overwrite().save(str(tmp_path / "m"))
    back = PipelineModel.load(str(tmp_path / "m"))
    assert scores(back, rows) == scores(fitted, rows)
    assert back.stages[1].selected == selector.selected and back.stages[1].importances == selector.importances
    assert back.stages[2].names == ["tree", "line"] == stack.names
    # only the model's own columns are added
    added = set(fitted.transform(rows).columns) - set(rows.columns)
    assert added == {md.FEATURES, "selected", "raw_prediction", md.PROB_VEC, "prediction_d"}


def test_unfitted_pipeline_saves_and_loads(rows, tmp_path):
    pipe = st.pipeline_from_config(CONFIG, FEATS, 3)
    pipe.write().overwrite().save(str(tmp_path / "p"))
    back = Pipeline.load(str(tmp_path / "p"))
    stack = back.getStages()[2]
    assert [b.getOrDefault("modelType") for b in stack.getOrDefault("bases")] == ["decision_tree", "logistic_reg"]
    assert stack.getOrDefault("numFolds") == 3 and back.getStages()[1].getOrDefault("threshold") == "0.5*mean"
    assert scores(back.fit(rows), rows) == scores(pipe.fit(rows), rows)


def test_no_meta_row_sees_a_base_that_saw_it(spark, rows):
    """A base that learns its rows by heart: in-fold scores would be the labels."""
    coin = rows.withColumn("label", (hash_unit(hash_hex(["row_id"], "coin")) < 0.5).cast("double"))
    heart = DecisionTreeClassifier(maxDepth=20, maxBins=1000, minInstancesPerNode=1)
    frame = md.assembler(["noise"]).transform(coin)
    stack = st.StackingClassifier([("heart", heart)], numFolds=3)
    own = _auc(heart.setFeaturesCol(md.FEATURES).fit(frame).transform(frame).select(
        "label", F.element_at(st.vector_to_array("probability"), 2).alias("probability")))
    assert own > 0.9
    out = stack.out_of_fold(frame)
    assert out.count() == 900 and out.select("id").distinct().count() == 900
    assert abs(_auc(out.select("label", F.col(f"{stack.uid}_p0").alias("probability"))) - 0.5) < 0.1


def _auc(df):
    return met.roc_auc(df.withColumn("prediction", (F.col("probability") >= 0.5).cast("int"))).first()["auc_roc"]


def test_folds_are_stratified_or_the_rows_own(rows):
    frame = md.assembler(FEATS).transform(rows)
    stack = st.StackingClassifier([("a", st.ConfiguredClassifier("decision_tree"))], numFolds=4)
    got = {(r["fold"], r["label"]): r["count"] for r in stack._folded(frame)[0].groupBy("fold", "label").count().collect()}
    for label in (0.0, 1.0):
        sizes = [got[k, label] for k in range(1, 5)]
        assert max(sizes) - min(sizes) <= 1
    own = st.StackingClassifier([("a", st.ConfiguredClassifier("decision_tree"))], foldCol="x3")
    assert {r["fold"] for r in own.out_of_fold(frame).select("fold").distinct().collect()} == {0, 1, 2, 3, 4}
    with pytest.raises(ValueError, match="two folds"):
        st.StackingClassifier([("a", st.ConfiguredClassifier("decision_tree"))], foldCol="one").out_of_fold(
            frame.withColumn("one", F.lit(1)))


def test_input_columns_never_clash(rows):
    """Rows that already hold columns named like a classifier's outputs of a base."""
    extra = rows.withColumns({"probability": F.lit(7.0), "fold": F.lit("x"), "id": F.lit(1), "meta": F.lit(2)})
    fitted = st.pipeline_from_config(CONFIG, FEATS, 2).fit(extra)
    out = fitted.transform(extra)
    assert out.where("probability = 7.0 and fold = 'x' and meta = 2").count() == 900


def test_selector_thresholds(rows):
    frame = md.assembler(FEATS).transform(rows)
    inner = st.ConfiguredClassifier("logistic_reg")
    for threshold, least in (("mean", None), ("median", None), (0.0, 4)):
        fitted = st.ImportanceSelector(inner, threshold).fit(frame)
        t = md.selection_threshold(fitted.importances, threshold)
        assert fitted.selected == [f for f, v in zip(FEATS, fitted.importances) if v >= t]
        assert least is None or len(fitted.selected) == least
        assert fitted.transform(frame).select("selected").first()[0].size == len(fitted.selected)
    with pytest.raises(ValueError, match="no feature reaches"):
        st.ImportanceSelector(inner, 1e9).fit(frame)


def test_route_by_nested_name():
    pipe = st.pipeline_from_config(CONFIG, FEATS, 3)
    maps = st.route(pipe, {"feature_selection__threshold": 0.1, "feature_selection__estimator__max_depth": 2,
                           "stacking__tree__max_depth": 7, "stacking__tree__criterion": "entropy",
                           "stacking__final_estimator__C": 0.5, "stacking__numFolds": 2})
    got = pipe.copy(maps)
    selector, stack = got.getStages()[1:]
    assert selector.getOrDefault("threshold") == 0.1
    assert selector.getOrDefault("estimator").getOrDefault("modelParams") == {"max_depth": 2}
    tree, line = stack.getOrDefault("bases")
    assert tree.getOrDefault("modelParams") == {"max_depth": 7, "criterion": "entropy"}
    assert line.getOrDefault("modelParams") == {"C": 1.0} and stack.getOrDefault("numFolds") == 2
    assert stack.getOrDefault("finalEstimator").getOrDefault("modelParams") == {"penalty": "l2", "C": 0.5}
    # the pipeline itself is untouched
    assert pipe.getStages()[1].getOrDefault("threshold") == "0.5*mean"
    with pytest.raises(ValueError, match="no stage"):
        st.route(pipe, {"stacking__forest__max_depth": 1})
    with pytest.raises(ValueError, match="no parameter"):
        st.route(pipe, {"stacking__depth": 1})
    single = st.pipeline_from_config({"type": "decision_tree", "params": {"max_depth": 3}}, FEATS)
    assert single.copy(st.route(single, {"max_depth": 9})).getStages()[-1].getOrDefault("modelParams") == {"max_depth": 9}


def test_nested_space_of_a_search_section():
    section = {"feature_selector_param_grid": {"max_depth": [3]}, "feature_selector_threshold": [0.1, 0.2],
               "base_models_param_grid": {"tree": {"max_depth": "range(2, 4)"}}, "meta_learner_param_grid": {"C": [1.0]}}
    assert st.nested_space(section) == {"feature_selection__estimator__max_depth": [3], "feature_selection__threshold": [0.1, 0.2],
                                        "stacking__tree__max_depth": "range(2, 4)", "stacking__final_estimator__C": [1.0]}
    assert st.nested_space({"param_grid": {"a": [1]}, "cv": 5}) == {"a": [1]}


def test_search_over_the_whole_pipeline(rows):
    from tabsmith.operators.sampling import kfold
    folded = kfold(rows, "row_id", 2, strata=["label"]).cache()
    pipe = st.pipeline_from_config(CONFIG, FEATS, 2)
    cands = [{"stacking__tree__max_depth": 1, "feature_selection__threshold": 0.9}, {"stacking__tree__max_depth": 5}]
    trials = tu.score_candidates(folded, FEATS, pipe, cands, [1, 2], "f1")
    got = {(r["trial_id"], r["fold"]): r["value"] for r in trials.collect()}
    assert set(got) == {(t, k) for t in (0, 1) for k in (1, 2)}
    assert got[0, 1] is None and got[1, 1] > 0.8              # no feature reaches 0.9
    best, params, fitted = tu.refit_best(folded, FEATS, pipe, cands, trials, "f1")
    assert best == 1 and params == cands[1]
    assert met.roc_auc(md.predict(fitted, rows, keep=["label"])).first()["auc_roc"] > 0.9
    folded.unpersist()


def test_nested_order_keeps_shares_in_every_prefix(spark):
    from tabsmith.operators.sampling import nested_order
    df = spark.range(157).select("id", F.when(F.col("id") % 10 == 0, F.lit(None)).when(F.col("id") % 3 == 0, 1).otherwise(0).alias("c"))
    got = [(r["sample_rank"], r["c"]) for r in nested_order(df, "c", "id").orderBy("sample_rank").collect()]
    assert [p for p, _ in got] == list(range(1, 158))
    total = {c: sum(x == c for _, x in got) for c in (None, 0, 1)}
    seen = dict.fromkeys(total, 0)
    for p, c in got:
        seen[c] += 1
        assert all(abs(seen[c] - p * total[c] / 157) < 1.01 for c in total)


def test_importance_of_continuous_parameters(spark):
    import random
    r = random.Random(2)
    trials = [(i, r.random(), r.random()) for i in range(60)]
    rows = [(0, i, p, str(v), a) for i, a, b in trials for p, v in (("a", a), ("b", b), ("kind", "xy"[i % 2]))]
    got = {x["param"]: x["importance"] for x in tu.param_importance(spark.createDataFrame(
        rows, "run_id int, trial_id int, param string, param_value string, score double")).collect()}
    assert got["a"] > 0.9 and got["b"] < 0.1 and got["kind"] < 0.1


def test_random_halving_candidates():
    space = {"a": [1, 2, 3, 4], "b": "range(0, 100)"}
    assert len(tu.halving_candidates(space, 1000, cv=5)) == 50
    assert tu.halving_candidates(space, 1000, 3, seed=1) == tu.halving_candidates(space, 1000, 3, seed=1)
    assert len(tu.grid_candidates({"x": list(range(60)), "y": list(range(60))})) == 3600


def test_bagging_draws_saves_and_averages(rows, tmp_path):
    frame = md.assembler(FEATS).transform(rows)
    fitted = st.BaggingClassifier(st.ConfiguredClassifier("decision_tree", {"max_depth": 2}), 3).fit(frame)
    out = fitted.transform(frame)
    assert set(out.columns) - set(frame.columns) == {"raw_prediction", md.PROB_VEC, "prediction_d"}
    own = [m.transform(frame).select("row_id", st.vector_to_array(F.col(m.getProbabilityCol()))[1].alias("p")).collect() for m in fitted.bases]
    assert len({tuple(r.p for r in x) for x in own}) > 1                       # draws differ
    mean = {r.row_id: sum(x[i].p for x in own) / 3 for i, r in enumerate(own[0])}
    fitted.write().overwrite().save(str(tmp_path / "b"))
    for model in (fitted, st.BaggingModel.load(str(tmp_path / "b"))):
        got = model.transform(frame).select("row_id", "prediction_d", st.vector_to_array(md.PROB_VEC)[1].alias("p")).collect()
        assert all(abs(r.p - mean[r.row_id]) < 1e-12 and r.prediction_d == float(r.p >= 0.5) for r in got)
    total = frame.select(F.sum(st.bootstrap_weight("row_id", "42|bag0"))).head()[0]
    assert 800 < total < 1000


def test_whole_fits_do_not_wait_for_the_meta_model(rows, monkeypatch):
    """The bases' fits on all rows are under way while the meta model learns."""
    asked, meta_began, fit = [], [], st.ConfiguredClassifier._fit
    bases = ("line", "tree")

    def traced(self, dataset):
        name = self.getOrDefault("name")
        if name == "final_estimator":
            meta_began.append(True)
            until = time.monotonic() + 60
            while time.monotonic() < until and sum(n in bases for n in asked) < 8:
                time.sleep(0.01)
            assert sum(n in bases for n in asked) == 8          # 2 bases in 3 folds and on all rows
        asked.append(name)
        return fit(self, dataset)

    monkeypatch.setattr(st.ConfiguredClassifier, "_fit", traced)
    st.pipeline_from_config({**CONFIG, "feature_selector": {"enabled": False}}, FEATS, 3).fit(rows)
    assert meta_began and asked[-1] == "final_estimator"
