"""Registered checks: estimators (L*), CV and importance (E6-E8),
attribution (E10-E12), batch scoring (B1), model persistence (K3) and the
documented selection / clustering / bagging experiments (D10-D12)."""

from __future__ import annotations

import functools

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler as _VecScaler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.functions.hashing import hash_hex, hash_unit
from tabsmith.operators import explain as ex
from tabsmith.operators import metrics as met
from tabsmith.operators import models as md
from tabsmith.operators import sampling as sm
from tabsmith.operators import scaling as sc
from tabsmith.operators import selection as sel
from tabsmith.operators.stacking import BaggingClassifier, ConfiguredClassifier, ImportanceSelector, fit_kept, pipeline_from_config
from tabsmith.plans import fixtures as fx
from tabsmith.plans import scoring
from tabsmith.plans.cases_documented import attendance
from tabsmith.session import even, materialize, output_path

FEATURES = ["total_price_k", "acctbal_k", "nation", "order_month", "order_dow", "order_year",
            "status_f", "status_o", "priority_high", "segment_building", "noise_a"]
# The configs the checks fit with (shapes follow the
# reference's experiment configs, sizes kept small for the fixture).
CONFIGS = {
    "decision_tree": {"criterion": "gini", "max_depth": 5, "min_samples_leaf": 5, "random_state": 42},
    "gbdt": {"n_estimators": 20, "learning_rate": 0.1, "max_depth": 3, "subsample": 0.8, "random_state": 42},
    "logistic_reg": {"penalty": "l2", "C": 1.0, "max_iter": 100, "solver": "lbfgs", "random_state": 42},
    "mlp": {"hidden_layer_sizes": [16, 8], "activation": "relu", "solver": "adam", "max_iter": 100,
            "alpha": 0.0001, "random_state": 42},
    "random_forest": {"n_estimators": 30, "max_depth": 6, "max_features": "sqrt", "random_state": 42},
    "xgboost": {"max_depth": 3, "learning_rate": 0.1, "n_estimators": 20, "subsample": 0.8,
                "colsample_bytree": 0.8, "reg_lambda": 1.0, "tree_method": "hist", "random_state": 42},
    "lightgbm": {"num_leaves": 15, "learning_rate": 0.1, "n_estimators": 20, "feature_fraction": 0.8,
                 "reg_alpha": 0.1, "random_state": 42},
}


def model_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders joined to customer, a planted signal, and a stratified split."""
    o = fx.table(spark, sf_dir, "orders")
    c = fx.table(spark, sf_dir, "customer")
    x = o.join(c, o.o_custkey == c.c_custkey)
    noise = hash_unit(hash_hex(["o_orderkey"], "noise"))
    noise_b = hash_unit(hash_hex(["o_orderkey"], "noise_b"))
    x = x.select(
        F.col("o_orderkey").alias("row_id"), F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("cutoff_ts"),
        (F.col("o_totalprice") / 1000.0).alias("total_price_k"),
        (F.col("c_acctbal") / 1000.0).alias("acctbal_k"),
        F.col("c_nationkey").cast("double").alias("nation"),
        F.month("o_orderdate").cast("double").alias("order_month"),
        F.weekday("o_orderdate").cast("double").alias("order_dow"),
        (F.year("o_orderdate") - 1995).cast("double").alias("order_year"),
        (F.col("o_orderstatus") == "F").cast("double").alias("status_f"),
        (F.col("o_orderstatus") == "O").cast("double").alias("status_o"),
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").cast("double").alias("priority_high"),
        (F.col("c_mktsegment") == "BUILDING").cast("double").alias("segment_building"),
        noise_b.alias("noise_a"), noise.alias("_noise"))
    signal = (F.col("total_price_k") / 300.0 + (F.col("acctbal_k") + 1.0) * 0.3
              + F.col("priority_high") * 0.3 + F.col("_noise") * 0.6)
    x = x.withColumn("label", (signal > 1.0).cast("int")).drop("_noise")
    return sm.stratified_split(x, [], "label", "row_id", 0.3, fx.SEED)


_PREPARED: dict = {}


def prepared_table(spark, sf_dir):
    """The model fixture written once per session and data folder to the
    shared checkpoint folder; every fit, search and score reads that table
    instead of recomputing the join and the split."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _PREPARED:
        _PREPARED[key] = materialize(model_table(spark, sf_dir), "model-fixture")
    return _PREPARED[key]


def _train_test(spark, sf_dir):
    t = prepared_table(spark, sf_dir)
    return t.filter("is_train = 1"), t.filter("is_train = 0")


def _fit_and_score(model_type):
    def run(spark, sf_dir):
        train, test = _train_test(spark, sf_dir)
        fm = md.fit_model(train, FEATURES, model_type, CONFIGS[model_type])
        return md.predict(fm, test, keep=["row_id", "label"])
    run.__name__ = f"fit_{model_type}"
    return run


def cross_validate(spark, sf_dir, model_type="decision_tree", k=5):
    """k fold fits, one grouped evaluation of all fold predictions, mean /
    population-std rows, and the full-data fit's train row."""
    from tabsmith.plans import experiment as exp
    train, _ = _train_test(spark, sf_dir)
    config = {"model": {"type": model_type, "params": CONFIGS[model_type]}, "cross_validation": {"n_splits": k}}
    return exp.train(config, train, FEATURES, "row_id").metrics


def feature_importance(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir)
    fm = md.fit_model(train, FEATURES, "random_forest", CONFIGS["random_forest"])
    return md.importance_frame(spark, fm)


def top_importance(spark, sf_dir, n=20):
    return feature_importance(spark, sf_dir).orderBy(F.col("importance").desc(), "feature").limit(n)


def select_from_model(spark, sf_dir, threshold="mean"):
    """Importances, and which features the fitted selector keeps."""
    train, _ = _train_test(spark, sf_dir)
    selector = ImportanceSelector(ConfiguredClassifier("lightgbm", CONFIGS["lightgbm"]), threshold)
    fitted = selector.fit(md.assembler(FEATURES).transform(train.withColumn("label", F.col("label").cast("double"))))
    kept = set(fitted.selected)
    return spark.createDataFrame([(f, v, f in kept) for f, v in zip(fitted.names, fitted.importances)],
                                 "feature string, importance double, selected boolean")


STACK_BASES = ["decision_tree", "logistic_reg", "gbdt"]
# Shaped like the reference's stacked experiments: selector, named bases, meta learner.
STACK_CONFIG = {
    "is_stacking": True,
    "feature_selector": {"enabled": True, "type": "lightgbm", "params": CONFIGS["lightgbm"], "threshold": "mean"},
    "base_models": [{"name": name, "type": name, "params": {**CONFIGS[name], **({"n_estimators": 8} if name == "gbdt" else {})}}
                    for name in STACK_BASES],
    "meta_learner": {"type": "logistic_reg", "params": {"penalty": "l2", "C": 1.0}},
}
STACK_FOLDS = 3
# Candidates by nested name, one at least of the selector, a base and the meta learner.
STACK_GRID = {"feature_selection__threshold": ["mean", 0.01], "stacking__decision_tree__max_depth": [3],
              "stacking__final_estimator__C": [0.1]}
SEARCH_CONFIG = {**STACK_CONFIG, "base_models": STACK_CONFIG["base_models"][:2],
                 "feature_selector": {"enabled": True, "type": "decision_tree", "params": CONFIGS["decision_tree"], "threshold": "mean"}}


def stack_pipeline(selector: bool = True):
    config = STACK_CONFIG if selector else {**STACK_CONFIG, "feature_selector": {"enabled": False}}
    return pipeline_from_config(config, FEATURES, STACK_FOLDS, "row_id")


def _fit_stack(train: DataFrame, selector: bool):
    rows = train.select("row_id", F.col("label").cast("double").alias("label"), *FEATURES)
    return fit_kept(stack_pipeline(selector), rows) if selector else stack_pipeline(selector).fit(rows)


def stacking_oof(spark, sf_dir):
    """The stack over all features: out-of-fold base scores under a meta model."""
    train, test = _train_test(spark, sf_dir)
    return md.predict(_fit_stack(train, False), test, keep=["row_id", "label"])


def pipeline_stack(spark, sf_dir):
    """Feature selection (importance >= mean) followed by the stack, one Pipeline."""
    train, test = _train_test(spark, sf_dir)
    return md.predict(_fit_stack(train, True), test, keep=["row_id", "label"])


def stack_round_trip(spark, sf_dir):
    """The fitted pipeline of selector and stack, saved and loaded, scores alike."""
    train, test = _train_test(spark, sf_dir)
    fitted, path = _fit_stack(train, True), output_path(spark, "stack")
    fitted.write().overwrite().save(path)
    before = md.predict(fitted, test, keep=["row_id"]).withColumnRenamed("probability", "p_before")
    both = md.predict(md.PipelineModel.load(path), before.select("row_id", "p_before").join(test, "row_id"), keep=["row_id", "p_before"])
    return both.select("row_id", (F.col("p_before") == F.col("probability")).alias("same"))


def stack_rows(spark, sf_dir):
    """What both stacks must give for the test rows, whatever they learned (see ``scored_rows``)."""
    p, parts = F.col("probability"), []
    for name, query in (("stacking", stacking_oof), ("pipeline_stack", pipeline_stack)):
        parts.append(query(spark, sf_dir).select(
            F.lit(name).alias("model"), "row_id", "label", p.between(0.0, 1.0).alias("in_range"),
            (F.col("prediction").cast("int") == (p >= 0.5).cast("int")).alias("decided")))
    return functools.reduce(DataFrame.unionByName, parts)


def stack_fold_rows(spark, sf_dir):
    """The meta model's training rows: every training row once, in the fold that the
    hash order gives it, each base's score a probability."""
    train, _ = _train_test(spark, sf_dir)
    stack = stack_pipeline(False).getStages()[-1]
    rows = md.assembler(FEATURES).transform(train.withColumn("label", F.col("label").cast("double")))
    folded = stack._folded(rows)[0].cache()
    try:
        scored = stack.out_of_fold(rows, folded)
        scores = [F.col(f"{stack.uid}_p{i}") for i in range(len(STACK_BASES))]
        out = scored.select(F.col("id").alias("row_id"), "fold", F.col("label").cast("int").alias("label"),
                            functools.reduce(lambda a, b: a & b, [c.between(0.0, 1.0) for c in scores]).alias("in_range"))
        return materialize(out, "stack-folds")
    finally:
        folded.unpersist()


def stack_search(spark, sf_dir):
    """Grid search over selector, base and meta learner by nested names: the trial
    log's rows, each score a share."""
    from tabsmith.operators import tuning as tu
    train = _train_test(spark, sf_dir)[0].select("row_id", "label", *FEATURES)
    folded = even(sm.kfold(train, "row_id", 2, fx.SEED, strata=["label"]), train.count())
    pipe = pipeline_from_config(SEARCH_CONFIG, FEATURES, 2, "row_id")
    trials = tu.score_candidates(folded, FEATURES, pipe, tu.grid_candidates(STACK_GRID), [1, 2], "recall")
    return materialize(trials.select("trial_id", "fold", "metric", F.col("value").between(0.0, 1.0).alias("in_range"),
                                     *[F.col("params")[k].alias(k) for k in STACK_GRID]), "stack-search")


SCALING = {"total_price_k": "标准化", "acctbal_k": "min-max变换", "order_month": "robustscaler变换"}


def batch_score(spark, sf_dir):
    """Fit scaler + model, save, load, and score the test rows in one pass."""
    train, test = _train_test(spark, sf_dir)
    stats = sc.fit_scaling(train, SCALING)
    fm = md.fit_model(sc.apply_scaling(train, stats), FEATURES, "logistic_reg", CONFIGS["logistic_reg"])
    path = output_path(spark, "scorer")
    scoring.make_scorer(fm, stats, threshold=0.5).save(spark, path)
    return scoring.score_batch(spark, path, test, id_col="row_id", keep=["label"])


def model_round_trip(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    fm = md.fit_model(train, FEATURES, "random_forest", CONFIGS["random_forest"])
    path = output_path(spark, "model")
    fm.model.write().overwrite().save(path)
    loaded = md.FittedModel(md.PipelineModel.load(path), fm.model_type, fm.features)
    a = md.predict(fm, test, keep=["row_id"]).withColumnRenamed("probability", "p_before")
    b = md.predict(loaded, test, keep=["row_id"]).withColumnRenamed("probability", "p_after")
    return a.select("row_id", "p_before").join(b.select("row_id", "p_after"), "row_id") \
        .select("row_id", (F.col("p_before") == F.col("p_after")).alias("same"))


def scored_rows(spark, sf_dir):
    """What every model type must give for the test rows, whatever it learned: one
    row per model and test row, its label untouched, a probability in [0, 1] and
    the prediction that the probability implies."""
    train, test = _train_test(spark, sf_dir)
    parts = []
    for model_type, fm in md.fit_models(train, FEATURES, CONFIGS).items():
        scored = md.predict(fm, test, keep=["row_id", "label"])
        p = F.col("probability")
        parts.append(scored.select(
            F.lit(model_type).alias("model"), "row_id", "label", p.between(0.0, 1.0).alias("in_range"),
            (F.col("prediction").cast("int") == (p >= 0.5).cast("int")).alias("decided")))
    return functools.reduce(DataFrame.unionByName, parts)


# ---- attribution

ATTR_FEATURES = ["f_price", "f_year", "f_month", "f_day", "f_dow", "f_cust", "f_status_f", "f_status_o",
                 "f_urgent", "f_high", "f_low", "f_key"]
# The linear weights of the attribution check.
ATTR_WEIGHTS = [0.8, -0.5, 0.3, 0.05, -0.2, 0.01, 1.0, -1.0, 0.7, 0.4, -0.6, 0.1]


def attribution_table(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders")
    d = F.col("o_orderdate")
    return o.select(
        F.col("o_orderkey").alias("row_id"),
        (F.col("o_totalprice") / 1000.0).alias("f_price"),
        (F.year(d) - 1995).cast("double").alias("f_year"),
        F.month(d).cast("double").alias("f_month"),
        F.dayofmonth(d).cast("double").alias("f_day"),
        F.weekday(d).cast("double").alias("f_dow"),
        F.pmod(F.col("o_custkey"), F.lit(97)).cast("double").alias("f_cust"),
        (F.col("o_orderstatus") == "F").cast("double").alias("f_status_f"),
        (F.col("o_orderstatus") == "O").cast("double").alias("f_status_o"),
        (F.col("o_orderpriority") == "1-URGENT").cast("double").alias("f_urgent"),
        (F.col("o_orderpriority") == "2-HIGH").cast("double").alias("f_high"),
        (F.col("o_orderpriority") == "5-LOW").cast("double").alias("f_low"),
        F.pmod(F.col("o_orderkey"), F.lit(13)).cast("double").alias("f_key"))


def linear_attribution(spark, sf_dir):
    t = attribution_table(spark, sf_dir)
    out = ex.linear_contributions(t, ATTR_FEATURES, ATTR_WEIGHTS)
    return out.select("row_id", *[f"contrib_{f}" for f in ATTR_FEATURES])


def top_k_contributions(spark, sf_dir):
    """Top-10 per row of the contributions with the base value spread over the
    features (intercept 0: base = sum of w * mean)."""
    t = attribution_table(spark, sf_dir)
    c = ex.linear_contributions(t, ATTR_FEATURES, ATTR_WEIGHTS, spread_base=True)
    return c.select("row_id", *ex.top_k_columns(ATTR_FEATURES, [F.col(f"contrib_{f}") for f in ATTR_FEATURES]))


def user_attribution(spark, sf_dir):
    """Fitted logistic model: users, cut-off, label, prediction, probability
    and the top-10 linear contributions (log-odds scale)."""
    train, test = _train_test(spark, sf_dir)
    fm = md.fit_model(train, FEATURES, "logistic_reg", CONFIGS["logistic_reg"])
    w = fm.classifier.coefficients.toArray().tolist()
    row = train.agg(*[F.avg(f).alias(f) for f in FEATURES]).first()
    scored = md.predict(fm, test, keep=["row_id", "user_id", "cutoff_ts", "label", *FEATURES])
    c = ex.linear_contributions(scored, FEATURES, w, {f: row[f] for f in FEATURES}, digits=None,
                                spread_base=True, intercept=float(fm.classifier.intercept))
    return c.select("user_id", "cutoff_ts", "label", "prediction", "probability",
                    *ex.top_k_columns(FEATURES, [F.col(f"contrib_{f}") for f in FEATURES]))


def tree_attribution(spark, sf_dir, n_background=100):
    """The per-user table for a tree model: users, cut-off, label, prediction,
    probability and the top-10 Shapley contributions (base value spread)."""
    train, test = _train_test(spark, sf_dir)
    fm = md.fit_model(train, FEATURES, "decision_tree", CONFIGS["decision_tree"])
    bg = sm.background_sample(train, "row_id", n_background, fx.SEED).select(*FEATURES).collect()
    Z = np.array([[float(r[f]) for f in FEATURES] for r in bg])
    scored = md.predict(fm, test, keep=["row_id", "user_id", "cutoff_ts", "label", *FEATURES])
    keep = ["user_id", "cutoff_ts", "label", "prediction", "probability"]
    return ex.tree_contributions(scored, FEATURES, fm.classifier, Z, keep=keep)


# ---- documented selection / clustering / ensembles


def lasso_select(spark, sf_dir, at=0.01):
    """Coefficients of the LASSO path at one penalty."""
    train, _ = _train_test(spark, sf_dir)
    return spark.createDataFrame([row[:3] for row in sel.lasso_ranking(train, FEATURES, "label", at=at)],
                                 "feature string, coefficient double, selected boolean")


def rfe(spark, sf_dir, keep_n=4):
    """Recursive elimination: refit, drop the least important feature, repeat."""
    train, _ = _train_test(spark, sf_dir)
    train = train.select("label", *FEATURES).cache()
    try:
        ranking = sel.eliminate(train, FEATURES, keep_n, "decision_tree", CONFIGS["decision_tree"])
        return spark.createDataFrame(sorted(ranking, key=lambda t: (t[1], t[0])), "feature string, ranking int")
    finally:
        train.unpersist()


def course_clusters(spark, sf_dir, k=4):
    """KMeans on standardised per-course aggregates."""
    a = attendance(spark, sf_dir)
    agg = a.groupBy("course_id").agg(F.avg("attended").alias("rate"), F.avg("value").alias("mean_value"),
                                     F.count(F.lit(1)).cast("double").alias("n_events"))
    vec = md.assembler(["rate", "mean_value", "n_events"]).transform(agg)
    vec = _VecScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True).fit(vec).transform(vec)
    km = KMeans(k=k, seed=fx.SEED, featuresCol="scaled", predictionCol="cluster").fit(vec)
    return km.transform(vec).select("course_id", "rate", "mean_value", "n_events", "cluster")


def bagging(spark, sf_dir, n_models=5):
    """Trees on bootstrap weights of the rows, probabilities averaged."""
    train, test = _train_test(spark, sf_dir)
    bags = BaggingClassifier(ConfiguredClassifier("decision_tree", CONFIGS["decision_tree"]), n_models, "row_id", seed=fx.SEED)
    frame = md.assembler(FEATURES).transform(train.withColumn("label", F.col("label").cast("double")))
    return md.predict(md.PipelineModel(stages=[md.assembler(FEATURES), bags.fit(frame)]), test, keep=["row_id", "label"]).select(
        "row_id", "label", "probability", "prediction")


QUERIES = {
    "fit_decision_tree": _fit_and_score("decision_tree"),
    "fit_gbt": _fit_and_score("gbdt"),
    "fit_logistic": _fit_and_score("logistic_reg"),
    "fit_mlp": _fit_and_score("mlp"),
    "fit_random_forest": _fit_and_score("random_forest"),
    "fit_boosted_a": _fit_and_score("xgboost"),
    "fit_boosted_b": _fit_and_score("lightgbm"),
    "cross_validate": cross_validate,
    "feature_importance": feature_importance,
    "top_importance": top_importance,
    "select_from_model": select_from_model,
    "stacking_oof": stacking_oof,
    "pipeline_stack": pipeline_stack,
    "stack_round_trip": stack_round_trip,
    "stack_rows": stack_rows,
    "stack_fold_rows": stack_fold_rows,
    "stack_search": stack_search,
    "batch_score": batch_score,
    "model_round_trip": model_round_trip,
    "scored_rows": scored_rows,
    "linear_attribution": linear_attribution,
    "top_k_contributions": top_k_contributions,
    "user_attribution": user_attribution,
    "tree_attribution": tree_attribution,
    "lasso_select": lasso_select,
    "rfe": rfe,
    "course_clusters": course_clusters,
    "bagging": bagging,
}

# ---------------------------------------------------------------- SQL twins

_ATTR_SQL = """t AS (SELECT o_orderkey AS row_id, o_totalprice / 1000.0 AS f_price,
      CAST(year(o_orderdate) - 1995 AS DOUBLE) AS f_year, CAST(month(o_orderdate) AS DOUBLE) AS f_month,
      CAST(day(o_orderdate) AS DOUBLE) AS f_day, CAST(isodow(o_orderdate) - 1 AS DOUBLE) AS f_dow,
      CAST(o_custkey % 97 AS DOUBLE) AS f_cust, CAST(o_orderstatus = 'F' AS DOUBLE) AS f_status_f,
      CAST(o_orderstatus = 'O' AS DOUBLE) AS f_status_o, CAST(o_orderpriority = '1-URGENT' AS DOUBLE) AS f_urgent,
      CAST(o_orderpriority = '2-HIGH' AS DOUBLE) AS f_high, CAST(o_orderpriority = '5-LOW' AS DOUBLE) AS f_low,
      CAST(o_orderkey % 13 AS DOUBLE) AS f_key FROM orders),
  mu AS (SELECT """ + ", ".join(f"avg({f}) AS m_{f}" for f in ATTR_FEATURES) + """ FROM t),
  c AS (SELECT row_id, """ + ", ".join(
    f"round(CAST({w} AS DOUBLE) * ({f} - m_{f}), 6) AS contrib_{f}" for f, w in zip(ATTR_FEATURES, ATTR_WEIGHTS)) + \
    " FROM t, mu)"

_BASE_SHARE = "(" + " + ".join(f"CAST({w} AS DOUBLE) * m_{f}" for f, w in zip(ATTR_FEATURES, ATTR_WEIGHTS)) + \
    f") / {len(ATTR_FEATURES)}"
_SPREAD = "cs AS (SELECT row_id, " + ", ".join(
    f"round(CAST({w} AS DOUBLE) * ({f} - m_{f}) + {_BASE_SHARE}, 6) AS contrib_{f}"
    for f, w in zip(ATTR_FEATURES, ATTR_WEIGHTS)) + " FROM t, mu)"
_UNPIV = " UNION ALL ".join(
    f"SELECT row_id, {i} AS idx, '{f}' AS name, contrib_{f} AS value FROM cs" for i, f in enumerate(ATTR_FEATURES))

# The test rows of the model fixture: label from the planted signal, quotas by
# largest remainder, order by hash.
_TEST_ROWS = f"""m AS (SELECT o_orderkey AS row_id, CAST(CAST(o_totalprice AS DOUBLE) / 1e3 / 3e2
      + (CAST(c_acctbal AS DOUBLE) / 1e3 + 1e0) * 3e-1 + CAST(o_orderpriority IN ('1-URGENT', '2-HIGH') AS DOUBLE) * 3e-1
      + CAST(CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|noise'), 1, 8) AS BIGINT) AS DOUBLE)
        / 4294967296e0 * 6e-1 > 1e0 AS INTEGER) AS label
      FROM orders JOIN customer ON o_custkey = c_custkey),
  cc AS (SELECT label, count(*) AS n_c, CAST(sum(count(*)) OVER () AS BIGINT) AS n FROM m GROUP BY label),
  ct AS (SELECT *, CAST(ceil(3e-1 * n) AS BIGINT) AS t FROM cc),
  cq AS (SELECT label, t * n_c // n AS base, t - sum(t * n_c // n) OVER () AS rest,
      row_number() OVER (ORDER BY (t * n_c) % n DESC, label) AS rr FROM ct),
  rk AS (SELECT *, row_number() OVER (PARTITION BY label
      ORDER BY md5(CAST(row_id AS VARCHAR) || '|{fx.SEED}|split'), row_id) AS r FROM m),
  test AS (SELECT rk.row_id, rk.label FROM rk JOIN cq ON rk.label = cq.label
      WHERE r <= base + CAST(rr <= rest AS BIGINT))"""

SQL = {
    "model_round_trip": f"WITH {_TEST_ROWS} SELECT row_id, true AS same FROM test",
    "scored_rows": f"""WITH {_TEST_ROWS} SELECT model, row_id, label, true AS in_range, true AS decided
      FROM test, (VALUES {", ".join(f"('{m}')" for m in CONFIGS)}) AS k(model)""",
    "stack_round_trip": f"WITH {_TEST_ROWS} SELECT row_id, true AS same FROM test",
    "stack_rows": f"""WITH {_TEST_ROWS} SELECT model, row_id, label, true AS in_range, true AS decided
      FROM test, (VALUES ('stacking'), ('pipeline_stack')) AS k(model)""",
    "stack_fold_rows": f"""WITH {_TEST_ROWS}, train AS (SELECT * FROM rk WHERE row_id NOT IN (SELECT row_id FROM test))
      SELECT row_id, CAST((row_number() OVER (PARTITION BY label ORDER BY md5(CAST(row_id AS VARCHAR) || '|{fx.SEED}|stack'), row_id) - 1)
        % {STACK_FOLDS} + 1 AS INTEGER) AS fold, label, true AS in_range FROM train""",
    "stack_search": """SELECT i AS trial_id, 'recall' AS metric, true AS in_range, t AS feature_selection__threshold,
        '3' AS stacking__decision_tree__max_depth, '0.1' AS stacking__final_estimator__C, f AS fold
      FROM (VALUES (0, 'mean'), (1, '0.01')) a(i, t), (VALUES (1), (2)) b(f)""",
    "linear_attribution": f"WITH {_ATTR_SQL} SELECT * FROM c",
    "top_k_contributions": f"""WITH {_ATTR_SQL}, {_SPREAD}, u AS ({_UNPIV}),
      r AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY -abs(value), idx) AS pos FROM u)
      SELECT row_id, """ + ", ".join(
        f"max(CASE WHEN pos = {i} THEN name END) AS Feature_{i}_Name, "
        f"max(CASE WHEN pos = {i} THEN value END) AS Feature_{i}_Contribution" for i in range(1, ex.TOP_K + 1)) +
    " FROM r GROUP BY row_id",
}
