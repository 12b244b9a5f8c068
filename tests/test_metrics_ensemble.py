"""Metrics against brute force; ensemble semantics."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from tabsmith.operators import ensemble as ens
from tabsmith.operators import metrics as met


def _brute_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


@pytest.mark.parametrize("cells", [1, 3, 50])
def test_auc_exact_with_ties(spark, cells):
    rnd = random.Random(7)
    rows = [(rnd.randint(0, 1), round(rnd.random(), 1)) for _ in range(300)]
    df = spark.createDataFrame(rows, "label int, probability double")
    got = met.roc_auc(df, digits=None, cells=cells).first()["auc_roc"]
    assert got == pytest.approx(_brute_auc(rows), abs=1e-12)
    flipped = df.withColumn("probability", 1 - F.col("probability"))
    assert met.roc_auc(flipped, digits=None).first()["auc_roc"] == pytest.approx(1 - got, abs=1e-12)


def test_auc_single_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.4)], "label int, probability double")
    assert met.roc_auc(df).first()["auc_roc"] is None


def test_metrics_zero_denominators(spark):
    df = spark.createDataFrame([(0, 0, 0.1), (0, 0, 0.2)], "label int, prediction int, probability double")
    r = met.binary_metrics(df).first()
    assert (r["accuracy"], r["precision"], r["recall"], r["f1"]) == (1.0, 0.0, 0.0, 0.0)


def test_roc_curve_endpoints(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, 0.4), (0, 0.4)], "label int, probability double")
    pts = sorted((r["fpr"], r["tpr"]) for r in met.roc_curve(df).collect())
    assert pts[0] == (0.0, 0.0) and pts[-1] == (1.0, 1.0)


def test_summarize_folds_population_std(spark):
    df = spark.createDataFrame([(1, 0.5, 0.5, 0.5, 0.5, 0.5), (2, 1.0, 1.0, 1.0, 1.0, 1.0)],
                               "fold int, accuracy double, precision double, recall double, f1 double, auc_roc double")
    rows = {r["metrics_type"]: r for r in met.summarize_folds(df).collect()}
    assert rows["cross_validation_mean"]["accuracy"] == 0.75
    assert rows["cross_validation_std"]["accuracy"] == 0.25


def test_row_mode_ties_smallest_and_nulls(spark):
    df = spark.createDataFrame([(1, 0, 1, 0), (2, 2, None, None), (None, None, None, None), (3, 1, 1, 3)],
                               "a int, b int, c int, d int")
    got = [r[0] for r in df.select(ens.row_mode(["a", "b", "c", "d"])).collect()]
    assert got == [0, 2, None, 1]


def test_votes(spark):
    df = spark.createDataFrame([(1, 1, 1, 0, 0, 0.2, None, 0.6)], "p1 int, p2 int, p3 int, p4 int, p5 int, q1 double, q2 double, q3 double")
    r = df.select(ens.majority_vote(["p1", "p2", "p3", "p4", "p5"]).alias("v"),
                  ens.soft_vote(["q1", "q2", "q3"]).alias("s")).first()
    assert r["v"] == 1 and r["s"] == pytest.approx(0.4)


def test_ensemble_join_strict_and_fanout(spark):
    a = spark.createDataFrame([(1, 1, 0, 0.1), (1, 1, 1, 0.9), (2, 0, 0, 0.2)], "user_id int, label int, prediction int, probability double")
    b = spark.createDataFrame([(1, 1, 1, 0.7), (1, 1, 0, 0.3), (2, 0, 1, 0.6)], "user_id int, label int, prediction int, probability double")
    assert ens.ensemble_join({"a": a, "b": b}, ["user_id"]).count() == 5   # 2*2 + 1
    with pytest.raises(ens.DuplicateKeyError):
        ens.ensemble_join({"a": a, "b": b}, ["user_id"], strict=True)


def test_prediction_stats_and_percent(spark):
    df = spark.createDataFrame([(1, 0.95), (0, 0.05), (1, 0.5), (0, 0.45)], "prediction int, probability double")
    r = ens.prediction_stats(df).first()
    assert r["total_predictions"] == 4 and r["positive_count"] == 2
    assert r["high_confidence_predictions"] == 2 and r["low_confidence_predictions"] == 2
    h = met.stats_from_histogram(met.score_histogram(df.withColumn("label", F.lit(1)), []), []).first()
    assert h["confidence_std"] == pytest.approx(r["confidence_std"], abs=1e-6)
    assert df.select(ens.percent(F.lit(0.58797))).first()[0] == "58.80%"
