"""Attribution of ensembles, feature selection, CSV scans, early stopping, stream scoring,
experiments and the report over saved models."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabsmith.functions.hashing import hash_hex, hash_unit
from tabsmith.operators import ensemble as ens
from tabsmith.operators import models as md
from tabsmith.operators import selection as sel
from tabsmith.operators import tree_shap as ts

FEATS = ["x1", "x2", "x3"]


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(700).select(F.col("id").alias("row_id"), (F.col("id") % 97 / 97.0).alias("x1"),
                                 (F.col("id") * 7 % 13 / 13.0).alias("x2"), hash_unit(hash_hex(["id"], "n")).alias("x3"))
    out = df.withColumn("label", ((F.col("x1") + 0.3 * F.col("x2") + 0.2 * F.col("x3")) > 0.7).cast("int")).cache()
    yield out
    out.unpersist()


# ---------------------------------------------------------------- Shapley values by path weights

def expected(nodes, value, x, given):
    """A tree's output when only some features are known."""
    def walk(i):
        n = nodes[i]
        if n["leftChild"] < 0:
            return value(n)
        left, right = n["leftChild"], n["rightChild"]
        if n["feature"] in given:
            return walk(left if x[n["feature"]] <= n["split"][0] else right)
        a, b = nodes[left]["rawCount"], nodes[right]["rawCount"]
        return (a * walk(left) + b * walk(right)) / (a + b)
    return walk(0)


@pytest.mark.parametrize("model_type, params", [("decision_tree", {"max_depth": 4}), ("random_forest", {"n_estimators": 5, "max_depth": 4}),
                                                ("gbdt", {"n_estimators": 4, "max_depth": 3})])
def test_path_shapley_is_the_definition(spark, rows, tmp_path, model_type, params):
    fm = md.fit_model(rows, FEATS, model_type, params)
    ensemble = ts.ensemble_of(fm.classifier, spark)
    x = np.array([[r[f] for f in FEATS] for r in rows.limit(12).collect()])
    got = ts.path_shapley(x, ensemble)
    fm.classifier.write().overwrite().save(str(tmp_path / "m"))
    trees = ts.saved_nodes(spark, str(tmp_path / "m"))
    boosted = model_type == "gbdt"
    weights = list(fm.classifier.treeWeights) if boosted else [1 / len(trees)] * len(trees)
    value = (lambda n: n["prediction"]) if boosted else (lambda n: n["impurityStats"][1] / sum(n["impurityStats"]))
    d = len(FEATS)
    for row, phi in zip(x, got):
        def f(given):
            return sum(w * expected(trees[t], value, row, given) for t, w in zip(sorted(trees), weights))
        for j in range(d):
            others = [i for i in range(d) if i != j]
            want = sum(math.factorial(k) * math.factorial(d - 1 - k) / math.factorial(d) * (f({*s, j}) - f(set(s)))
                       for k in range(d) for s in itertools.combinations(others, k))
            assert abs(phi[j] - want) < 1e-9
        assert abs(phi.sum() + ensemble.base - f(set(range(d)))) < 1e-9
    told = ts.margins(fm.classifier, md.assembler(FEATS).transform(rows), ["row_id", *FEATS])
    sums = ts.path_contributions(told, FEATS, fm.classifier, ["row_id", "margin"], k=2, total="total").collect()
    assert len(sums) == 700 and all(abs(r["total"] - r["margin"]) < 1e-9 for r in sums)
    assert {"Feature_1_Name", "Feature_2_Contribution", "base_value"} <= set(sums[0].asDict())
    assert all(abs(r["Feature_1_Contribution"]) >= abs(r["Feature_2_Contribution"]) for r in sums)


def test_size_of_shipped_nodes_is_checked(spark, rows, monkeypatch):
    fm = md.fit_model(rows, FEATS, "decision_tree", {"max_depth": 4})
    monkeypatch.setattr(ts, "MAX_NODES", 3)
    with pytest.raises(ValueError, match="nodes"):
        ts.ensemble_of(fm.classifier, spark)


# ---------------------------------------------------------------- selection

def test_ranks_and_spearman_with_ties_nulls_and_hot_values(spark):
    r = np.random.default_rng(1)
    data = [(i, float(r.integers(0, 5)), None if i % 11 == 0 else float(r.normal()), 7.0 if r.random() < 0.6 else float(r.integers(0, 100)),
             float("nan") if i % 13 == 0 else 1.0) for i in range(400)]
    df = spark.createDataFrame(data, "id long, a double, b double, c double, d double")
    names = ["a", "b", "c", "d"]
    got = {x["id"]: x for x in sel.average_ranks(df, "id", names, cells=6).collect()}
    pandas = df.toPandas().set_index("id")
    want = pandas.rank(method="average")
    for c in names:
        for i in range(400):
            mine = got[i][f"{c}_rank"]
            assert (mine is None and np.isnan(want[c][i])) or mine == want[c][i]
    table = {(x["feature_a"], x["feature_b"]): x["corr"] for x in sel.spearman(df, "id", names).collect()}
    for x, y in itertools.combinations(names[:3], 2):
        both = want[[x, y]].dropna()
        # ranks of all rows that have the value, correlated over the rows that have both
        assert abs(table[x, y] - both[x].corr(both[y])) < 1e-9
    assert len(table) == 6 and table["a", "d"] is None


def test_greedy_ranking_avoids_copies(spark):
    rows = [("a", "y", 0.9), ("b", "y", 0.85), ("c", "y", 0.5), ("a", "b", 0.99), ("a", "c", 0.05), ("b", "c", 0.1), ("d", "y", None),
            ("a", "d", 0.0), ("b", "d", 0.0), ("c", "d", 0.0)]
    got = sel.rank_features(spark.createDataFrame(rows, "feature_a string, feature_b string, corr double"), "y")
    assert [f for _, f, _, _ in got] == ["a", "c", "b", "d"] and got[1][2:] == (0.5, 0.05)


def test_lasso_path_meets_the_optimality_conditions(spark):
    r = np.random.default_rng(2)
    x = r.normal(size=(300, 5))
    x[:, 3] = x[:, 0] + 0.1 * r.normal(size=300)
    x[:, 4] = 2.5
    y = 2 * x[:, 0] - x[:, 1] + 0.1 * r.normal(size=300)
    df = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)] + [(None, 1.0, 1.0, 1.0, 1.0, 1.0)],
                               "a double, b double, c double, d double, e double, y double")
    names = list("abcde")
    table = sel.moments(df, [*names, "y"])
    sums = {(t["a"], t["b"]): t["total"] for t in table.collect()}
    assert sums["", ""] == 300 and abs(sums["b", "a"] - (x[:, 0] * x[:, 1]).sum()) < 1e-8 and len(sums) == 28
    gram, target, spread = sel._standard(table, names, "y")
    assert spread[4] == 0 and np.allclose(np.diag(gram)[:4], 1)
    penalties, path = sel.lasso_path(gram, target)
    assert not path[0].any() and list(penalties) == sorted(penalties, reverse=True)
    for penalty, beta in zip(penalties, path):
        slope = target - gram @ beta
        for j in range(4):
            if beta[j]:
                assert abs(slope[j] - penalty * np.sign(beta[j])) < 1e-8
            else:
                assert abs(slope[j]) <= penalty + 1e-8
    got = {f: (c, chosen, entered) for f, c, chosen, entered in sel.lasso_ranking(df, names, "y")}
    assert got["a"][1] and got["b"][1] and got["e"] == (0.0, False, None) and got["a"][2] == 1
    assert abs(got["b"][0] + 1) < 0.1
    with pytest.raises(ValueError, match="no row"):
        sel._standard(sel.moments(df.limit(0), names), names[:-1], "e")


def test_elimination_drops_noise_first(rows):
    got = dict(sel.eliminate(rows.withColumn("zero", F.lit(0.0)), [*FEATS, "zero"], 1, "decision_tree", {"max_depth": 5}))
    assert got["x1"] == 1 and got["zero"] == 4 and sorted(got.values()) == [1, 2, 3, 4]
    two = dict(sel.eliminate(rows, FEATS, 1, "logistic_reg", {"C": 10.0}, step=2))
    assert sorted(two.values()) == [1, 2, 2]
    with pytest.raises(ValueError):
        sel.eliminate(rows, FEATS, 0)


# ---------------------------------------------------------------- early stopping

def test_boosting_stops_early(rows):
    noisy = rows.withColumn("label", (hash_unit(hash_hex(["row_id"], "coin")) < 0.5).cast("int"))
    params = {"n_estimators": 40, "max_depth": 4, "validation_fraction": 0.3, "n_iter_no_change": 5, "tol": 1e-4}
    fm = md.fit_model(noisy, FEATS, "gbdt", params)
    assert fm.ignored_params == {} and fm.classifier.getNumTrees < 40
    assert md.fit_model(noisy, FEATS, "gbdt", {"n_estimators": 8, "max_depth": 4}).classifier.getNumTrees == 8
    from tabsmith.operators.stacking import ConfiguredClassifier
    frame = md.assembler(FEATS).transform(noisy.withColumn("label", F.col("label").cast("double")))
    assert ConfiguredClassifier("gbdt", params).fit(frame).getNumTrees < 40
    est, ignored = md.create_estimator("xgboost", {"early_stopping_rounds": 10})
    assert ignored == {} and est.isSet("validationIndicatorCol")


# ---------------------------------------------------------------- CSV

def test_csv_of_two_header_orders_with_broken_lines(spark, tmp_path):
    from pyspark.sql.types import StructType
    from tabsmith.sources import io
    (tmp_path / "a.csv").write_text("t.x,t.y,z\n" + "".join(f"{i},{i}.5,w{i}\n" for i in range(2000)))
    (tmp_path / "b.csv").write_text("\"z\",x,y\n\"q,r\",7,1.5\nbad,seven,2\n")
    (tmp_path / "c.csv").write_text("x,y\n9,2.5\n")
    (tmp_path / "d.txt").write_text("no,table\n1,2\n")
    types = StructType.fromDDL("x INT, y DOUBLE, z STRING")
    groups = io._headers(spark, str(tmp_path), "*.csv")
    assert [h for h, _ in groups] == ['"z",x,y', "t.x,t.y,z", "x,y"]
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") != "1"          # the session's own settings stay
    got = io.scan_directory(spark, str(tmp_path), "csv", "*.csv", schema=types, corrupt="broken")
    assert [f.dataType.simpleString() for f in got.schema.fields][:3] == ["int", "double", "string"]
    out = got.collect()
    assert len(out) == 2003
    assert [(r.x, r.z, r.broken) for r in out if r.source.endswith("b.csv")] == [(7, "q,r", None), (None, "bad", "bad,seven,2")]
    assert [(r.x, r.y, r.z, r.broken) for r in out if r.source.endswith("c.csv")] == [(9, 2.5, None, None)]
    one = io.scan_project(spark, str(tmp_path / "a.csv"), ["t.y", "x"], "csv", types)
    assert one.columns == ["y", "x"] and one.agg(F.sum("y")).head()[0] == sum(i + 0.5 for i in range(2000))
    with pytest.raises(KeyError):
        io.scan_project(spark, str(tmp_path / "a.csv"), ["nothing"], "csv")
    with pytest.raises(ValueError, match="names"):
        io.union_sources({"a": spark.range(1)}, {"a": ["x", "y"]})


# ---------------------------------------------------------------- scoring on a stream

def test_replayed_batch_adds_no_row(spark, rows, tmp_path):
    from tabsmith.plans import scoring
    from tabsmith.sources import io
    from tabsmith.streaming import scoring as st
    from tabsmith.streaming.stateless import read_stream
    path = scoring.make_scorer(md.fit_model(rows, FEATS, "logistic_reg", {"C": 1.0})).save(spark, str(tmp_path / "scorer"))
    source = str(tmp_path / "in")
    rows.repartition(4).write.parquet(source)
    stream = read_stream(spark, source, rows.schema, max_files_per_trigger=1)
    query, run = st.score_stream(stream, path, str(tmp_path / "out"), str(tmp_path / "ckpt"), id_col="row_id")
    query.awaitTermination()
    back = io.read_table(spark, run)
    assert back.count() == 700 and back.select("batch_id").distinct().count() == 4
    write = st.batch_writer(scoring.BatchScorer.load(spark, path), run, "row_id")
    again = rows.where(F.col("row_id").isin([r.row_id for r in back.where("batch_id = 2").collect()]))
    for _ in range(2):
        write(again, 2)
    got = {r.row_id: (r.prediction, r.probability) for r in io.read_table(spark, run).collect()}
    want = {r.row_id: (r.prediction, r.probability) for r in scoring.score_batch(spark, path, rows, id_col="row_id").collect()}
    assert got == want and io.read_table(spark, run).count() == 700
    # going on with the run after new input: what was scored stays
    rows.limit(10).withColumn("row_id", F.col("row_id") + 10_000).write.mode("append").parquet(source)
    query, same = st.score_stream(stream, path, str(tmp_path / "out"), str(tmp_path / "ckpt"), run, id_col="row_id")
    query.awaitTermination()
    assert same == run and io.read_table(spark, run).count() == 710


# ---------------------------------------------------------------- ensembles, experiments, report

@pytest.mark.parametrize("strict", [False, True])
def test_grouped_ensemble_is_the_join(spark, strict):
    data = [(m, k, k % 2, (k + i) % 2, 0.1 * i + 0.01 * k) for i, m in enumerate("abc") for k in range(20) if not (m == "b" and k == 7)]
    data += [] if strict else [("a", 3, 1, 1, 0.9), ("c", 3, 0, 0, 0.8)]
    long = spark.createDataFrame(data, "model string, key long, label int, prediction int, probability double")
    joined = ens.ensemble_join({m: long.where(F.col("model") == m).drop("model") for m in "abc"}, ["key"], strict=strict)
    got = ens.ensemble_rows(long, ["key"], list("abc"), strict=strict)
    assert got.columns == joined.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, joined.collect()))
    if strict:
        with pytest.raises(Exception, match="repeats the key"):
            ens.ensemble_rows(long.unionByName(long.limit(1)), ["key"], list("abc"), strict=True).collect()


def test_experiment_trains_evaluates_and_saves(spark, rows, tmp_path):
    from tabsmith.plans import experiment as exp
    from tabsmith.sources import io
    config = {"model": {"type": "gbdt", "params": {"n_estimators": 5, "max_depth": 3, "random_state": 1}}, "cross_validation": {"n_splits": 3}}
    done = exp.train(config, rows, FEATS, test=rows.limit(200), path=str(tmp_path / "e"))
    table = {r["metrics_type"]: r for r in io.read_table(spark, done.paths["metrics"]).collect()}
    folds = [table[f"cross_validation_fold_{k}"]["accuracy"] for k in (1, 2, 3)]
    assert set(table) == {*(f"cross_validation_{k}" for k in ("fold_1", "fold_2", "fold_3", "mean", "std")), "train", "test"}
    assert abs(table["cross_validation_mean"]["accuracy"] - np.mean(folds)) < 1e-6 and table["train"]["accuracy"] >= np.mean(folds)
    back = md.PipelineModel.load(done.paths["model"])
    mine, theirs = ({r.row_id: r.probability for r in md.predict(m, rows, keep=["row_id"]).collect()} for m in (done.model, back))
    assert mine == theirs


@pytest.mark.parametrize("kind", ["grid", "random", "halving_grid", "halving_random", "bayesian"])
def test_experiment_searches(spark, rows, tmp_path, kind):
    from tabsmith.plans import experiment as exp
    from tabsmith.sources import io
    section = {"param_grid": {"max_depth": [1, 4], "min_samples_leaf": "range(1, 4, 2)"}, "n_iter": 2, "n_candidates": 3, "cv": 2, "factor": 2,
               "scoring": "f1", "min_resources": 300}
    config = {"model": {"type": "decision_tree", "params": {"random_state": 1}}, f"{kind}_search_params": section}
    done = exp.tune(config, kind, rows, FEATS, path=str(tmp_path / kind))
    trials = io.read_table(spark, done.paths["trials"])
    n = trials.where("run_id = 0").select("trial_id").distinct().count()
    assert n == {"grid": 4, "halving_grid": 4, "halving_random": 3}.get(kind, 2)
    assert set(done.best_params) == {"max_depth", "min_samples_leaf"} and trials.where("value is null").count() == 0
    assert io.read_table(spark, done.paths["metrics"]).head()["f1"] > 0.5
    assert io.read_table(spark, done.paths["best"]).count() == trials.select("run_id").distinct().count()
    with pytest.raises(ValueError):
        exp.tune(config, "guess", rows, FEATS)


def test_report_over_saved_models(spark, rows, tmp_path):
    from tabsmith.plans.cases_library import saved_model_report
    paths = {}
    for name, params in (("logistic_reg", {"C": 1.0}), ("decision_tree", {"max_depth": 3}), ("random_forest", {"n_estimators": 4, "max_depth": 3})):
        paths[name] = str(tmp_path / name)
        md.fit_model(rows, FEATS, name, params).model.write().overwrite().save(paths[name])
    got = {r["model_name"]: r for r in saved_model_report(spark, paths, rows, str(tmp_path / "r"), min_votes=2).collect()}
    assert set(got) == {*paths, "ensemble"} and all(r["total_predictions"] == 700 and r["prediction_time"] > 0 for r in got.values())
    assert got["ensemble"]["auc_roc"] > 0.9 and got["ensemble"]["positive_rate"].endswith("%")
