"""Nulls, NaN and file headers that the first fixtures did not hold."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsmith.operators import explain, history
from tabsmith.operators.models import create_estimator
from tabsmith.sources import io


def test_csv_columns_match_by_name_in_every_file(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a,b\n1,2\n")
    (tmp_path / "two.csv").write_text("b,a\n3,30\n")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    got = io.scan_directory(spark, str(tmp_path), schema=schema).orderBy("b").select("a", "b").collect()
    assert [tuple(r) for r in got] == [(1, 2), (30, 3)]
    one = io.scan_project(spark, str(tmp_path / "two.csv"), ["t.a"], fmt="csv", schema=schema).collect()
    assert [r.a for r in one] == [30]


def test_nan_is_null_on_ingest(spark, tmp_path):
    path = str(tmp_path / "x")
    spark.createDataFrame([(1.0,), (float("nan"),)], "v double").write.parquet(path)
    assert io.scan_project(spark, path, ["v"]).where("v is null").count() == 1


def test_null_time_keeps_its_row(spark):
    df = spark.createDataFrame([(1, "u", "2024-01-01 00:00:00", 1.0), (2, "u", None, 0.0), (3, "u", "2024-01-02 00:00:00", 1.0)],
                               "id long, u string, ts string, y double").withColumn("ts", F.to_timestamp("ts"))
    x = history.running_sums(df, ["u"], [F.col("ts"), F.col("id")], F.floor(history.epoch_micros("ts") / 1_000_000),
                             {"n": F.lit(1)})
    assert sorted(r.cum_n for r in x.collect()) == [1, 2, 3]


def test_rolling_cells_with_null_entity_doubled_key_and_large_values(spark):
    rows = [(i, None if i < 3 else "u", f"2024-01-01 0{i % 5}:00:00", 1.7e9 + i % 3) for i in range(8)] + [(7, "u", "2024-01-01 06:00:00", 1.7e9)]
    df = spark.createDataFrame(rows, "id long, u string, ts string, v double").withColumn("ts", F.to_timestamp("ts"))
    got = history.rolling_stats_cells(df, ["u"], "ts", "v", 7200, "id").collect()
    assert len(got) == len(rows)
    for r in got:
        before = [x[3] for x in rows if x[1] == r.u and 0 < (r.ts - _ts(x[2])).total_seconds() <= 7200]
        assert r.roll_count == len(before)
        if len(before) > 1:
            mean = sum(before) / len(before)
            std = math.sqrt(sum((b - mean) ** 2 for b in before) / (len(before) - 1))
            assert abs(r.roll_std - std) < 1e-6


def _ts(s):
    from datetime import datetime
    return datetime.fromisoformat(s)


@pytest.mark.parametrize("kind, params, ignored", [
    ("decision_tree", {"max_depth": 50}, {"max_depth"}), ("decision_tree", {"max_depth": 5}, set()),
    ("gbdt", {"loss": "exponential"}, {"loss"}), ("gbdt", {"max_features": "sqrt"}, set()),
    ("mlp", {"solver": "adam"}, {"solver"}), ("random_forest", {"max_features": None}, set())])
def test_changed_parameters_are_reported(spark, kind, params, ignored):
    est, got = create_estimator(kind, params, 3, 10)
    assert set(got) == ignored
    if kind == "random_forest":
        assert est.getFeatureSubsetStrategy() == "all"


def test_boosted_leaves_are_predictions(spark):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    df = spark.range(200).select(F.col("id").cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"),
                                 (F.col("id") % 3 == 0).cast("double").alias("label"))
    x = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    model = GBTClassifier(maxIter=4, maxDepth=3, seed=1).fit(x)
    tables, weights = explain.tree_tables(model)

    def walk(nodes, row):
        i = 0
        while nodes[i][0] >= 0:
            i = nodes[i][2] if row[nodes[i][0]] <= nodes[i][1] else nodes[i][3]
        return nodes[i][4]

    for r in model.transform(x).limit(30).collect():
        margin = sum(w * walk(t, r.features) for t, w in zip(tables, weights, strict=True))
        assert abs(2 * margin - r.rawPrediction[1] * 2) < 1e-9 or abs(2 * margin - r.rawPrediction[1]) < 1e-9


def test_rows_without_a_time_have_no_earlier_rows(spark):
    from tabsmith.operators import history as hist
    rows = [(1, "u", "2024-01-01 00:00:00", 5.0), (2, "u", "2024-01-01 05:00:00", 7.0), (3, "u", None, 100.0), (4, "u", None, 9.0),
            (5, None, None, 1.0), (6, "v", "2024-01-02 00:00:00", 2.0)]
    df = spark.createDataFrame(rows, "id long, who string, ts string, v double").withColumn("ts", F.col("ts").cast("timestamp"))
    for stats in (hist.rolling_stats, hist.rolling_stats_cells):
        got = {r.id: (r.roll_count, r.roll_mean, r.roll_max) for r in stats(df, ["who"], "ts", "v", 86400, "id").collect()}
        assert got == {1: (0, None, None), 2: (1, 5.0, 5.0), 3: (0, None, None), 4: (0, None, None), 5: (0, None, None), 6: (0, None, None)}


def test_spread_of_scores_far_from_zero_and_one_positive_rate(spark):
    import numpy as np
    from tabsmith.operators import ensemble as ens
    from tabsmith.operators import metrics as met
    rng = np.random.default_rng(1)
    p = (0.7 + rng.random(2000) * 1e-7).tolist()
    df = spark.createDataFrame([(i % 2, i % 3 if i % 3 < 2 else None, x) for i, x in enumerate(p)], "label int, prediction int, probability double")
    a = met.evaluate(df, [], digits=None, with_stats=True).head()
    b = ens.prediction_stats(df, digits=None).head()
    assert abs(a.confidence_std / np.std(p, ddof=1) - 1) < 1e-6 and abs(a.average_confidence - np.mean(p)) < 1e-12
    assert a.positive_rate == b.positive_rate == a.positive_count / 2000
