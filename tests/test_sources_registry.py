"""Sources, the driver contract and a few oracle checks at sf0.001."""

import math
import os
import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF001


def test_csv_scan_with_prefixed_header(spark, tmp_path):
    from tabsmith.sources import io
    p = tmp_path / "raw"
    p.mkdir()
    (p / "a.csv").write_text("t.x,t.y,z\n1,2,3\n4,5,6\n")
    (p / "._junk.csv").write_text("garbage\n")
    (p / "_skip.csv").write_text("t.x,t.y,z\n9,9,9\n")
    df = io.scan_project(spark, str(p / "a.csv"), ["t.y", "z"], fmt="csv")
    assert df.columns == ["y", "z"] and [tuple(r) for r in df.collect()] == [("2", "3"), ("5", "6")]
    d = io.scan_directory(spark, str(p), "csv", pattern="*.csv")
    assert d.count() == 2 and "source" in d.columns


def test_registry_complete():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 100


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 7 and "model_name" in df.columns


def _norm(v):
    if isinstance(v, float) and not math.isnan(v):
        return repr(round(v, 9))
    return "None" if v is None or isinstance(v, float) else str(v)


@pytest.mark.parametrize("key", ["binary_metrics", "roc_auc", "ensemble_join", "stratified_split",
                                 "feat_division", "fill_median", "historical_rate", "trial_rank",
                                 "top_k_contributions", "scale_robust"])
def test_oracle_sf0001(spark, duck, key):
    sdf = E.queries()[key](spark, SF001)
    res = duck.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    so = sorted(range(len(sdf.columns)), key=lambda i: sdf.columns[i])
    do = sorted(range(len(dcols)), key=lambda i: dcols[i])
    a = sorted(tuple(_norm(r[i]) for i in so) for r in sdf.collect())
    b = sorted(tuple(_norm(r[i]) for i in do) for r in res.fetchall())
    assert a == b


def test_tree_attribution_table_shape(spark):
    df = E.queries()["tree_attribution"](spark, SF001)
    cols = df.columns
    assert cols[:5] == ["user_id", "cutoff_ts", "label", "prediction", "probability"]
    assert "Feature_10_Name" in cols and "Feature_10_Contribution" in cols and cols[-1] == "base_value"
    r = df.first()
    mags = [abs(r[f"Feature_{i}_Contribution"]) for i in range(1, 11)]
    assert mags == sorted(mags, reverse=True)


@pytest.mark.parametrize("key", ["split_by_flag", "split_halves", "write_split", "write_split_tables",
                                 "write_predictions", "write_all_predictions", "write_trials", "write_best_trials"])
def test_sink_oracle_sf0001(spark, duck, key):
    test_oracle_sf0001(spark, duck, key)


def test_split_tables_hold_both_halves(spark, tmp_path):
    from tabsmith.sources import io
    df = spark.createDataFrame([(1, 1.0, 1, 0), (2, 2.0, 0, 1), (3, 3.0, 0, 0), (4, 4.0, None, 1)],
                               "id int, x double, is_train int, label int")
    paths = io.write_split_tables(df, str(tmp_path), "is_train", "label", ["id"])
    got = {name: io.read_table(spark, path) for name, path in paths.items()}
    ids = {name: sorted(r.id for r in rows.collect()) for name, rows in got.items()}
    assert ids == {"clean": [1, 2, 3, 4], "X_train": [1], "X_test": [2, 3], "y_train": [1], "y_test": [2, 3]}
    assert "label" not in got["X_test"].columns and sorted(got["y_test"].columns) == ["id", "label"]
    assert {r.id: r.is_train for r in got["clean"].collect()} == {1: 1, 2: 0, 3: 0, 4: None}


def test_predictions_of_all_models_in_stamped_runs(spark, tmp_path):
    from tabsmith.sources import io
    df = spark.createDataFrame([("a", 1, 0.5), ("b", 1, 0.7)], "model string, row_id int, probability double")
    first, second = io.write_predictions(df, str(tmp_path)), io.write_predictions(df.limit(1), str(tmp_path))
    assert first != second and re.fullmatch(r"predictions_\d{8}_\d{6}_\d{6}", os.path.basename(first))
    assert sorted(r.model for r in io.read_table(spark, first).collect()) == ["a", "b"]


def test_saved_search_has_best_row_and_model(spark, tmp_path):
    from tabsmith.operators import models as md
    from tabsmith.operators import tuning as tu
    from tabsmith.sources import io
    rows = [(0, 0, {"max_depth": "1"}, f, "recall", 0.5) for f in (1, 2)] + \
           [(0, 1, {"max_depth": "4"}, f, "recall", 0.9) for f in (1, 2)]
    trials = spark.createDataFrame(rows, "run_id int, trial_id int, params map<string,string>, fold int, "
                                         "metric string, value double")
    train = spark.range(60).selectExpr("CAST(id AS DOUBLE) AS x", "CAST(id % 2 AS INT) AS label")
    _, _, fm = tu.refit_best(train, ["x"], "decision_tree", [{"max_depth": 1}, {"max_depth": 4}], trials)
    paths = tu.save_search(trials, str(tmp_path), fitted=fm)
    best = io.read_table(spark, paths["best"]).collect()
    assert [(r.trial_id, r.best_score, r.params) for r in best] == [(1, 0.9, {"max_depth": "4"})]
    assert io.read_table(spark, paths["trials"]).count() == 4
    assert io.read_table(spark, paths["cv_results"]).count() == 2
    assert md.PipelineModel.load(paths["model"]).stages[-1].getMaxDepth() == 4
