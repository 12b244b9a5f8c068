"""Registered checks: attribution of ensembles (E10), feature selection (D9, D10), CSV
sources (S1, S2), early stopping (L2), scoring on a stream (B1), configured experiments
(train, tune) and the report over fitted, saved models."""

from __future__ import annotations

import functools
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tabsmith.operators import ensemble as ens
from tabsmith.operators import metrics as met
from tabsmith.operators import models as md
from tabsmith.operators import selection as sel
from tabsmith.operators import tree_shap as ts
from tabsmith.plans import experiment as exp
from tabsmith.plans import fixtures as fx
from tabsmith.plans import scoring
from tabsmith.plans.cases_documented import ATT, CORR_FEATURES, attendance, courses
from tabsmith.plans.cases_models import _TEST_ROWS, CONFIGS, FEATURES, SEARCH_CONFIG, _train_test
from tabsmith.session import materialize, output_path
from tabsmith.sources import io
from tabsmith.streaming.scoring import score_available
from tabsmith.streaming.stateless import read_stream

# ---------------------------------------------------------------- attribution of ensembles

ENSEMBLES = ("random_forest", "gbdt")
ATTRIBUTION_KEEP = ["user_id", "cutoff_ts", "label", "prediction", "probability"]


def _attributed(spark: SparkSession, sf_dir: str, model_type: str, keep, **options) -> DataFrame:
    train, test = _train_test(spark, sf_dir)
    fm = md.fit_model(train, FEATURES, model_type, CONFIGS[model_type])
    scored = md.predict(fm, test, keep=["row_id", "user_id", "cutoff_ts", "label", *FEATURES])
    return ts.path_contributions(scored, FEATURES, fm.classifier, keep, **options)


def forest_attribution(spark, sf_dir):
    """Users, cut-off, label, prediction, probability and the ten largest Shapley
    contributions to a forest's probability."""
    return _attributed(spark, sf_dir, "random_forest", ATTRIBUTION_KEEP)


def boosted_attribution(spark, sf_dir):
    """The same for the margin of boosted trees."""
    return _attributed(spark, sf_dir, "gbdt", ATTRIBUTION_KEEP)


def attribution_sums(spark, sf_dir):
    """Contributions add up to what the model itself gives, less its expected output."""
    parts = []
    train, test = _train_test(spark, sf_dir)
    for model_type, fm in md.fit_models(train, FEATURES, {m: CONFIGS[m] for m in ENSEMBLES}).items():
        told = ts.margins(fm.classifier, md.assembler(FEATURES).transform(test), ["row_id", "label", *FEATURES])
        out = ts.path_contributions(told, FEATURES, fm.classifier, ["row_id", "label", "margin"], k=0, total="total")
        parts.append(out.select(F.lit(model_type).alias("model"), "row_id", "label",
                                (F.abs(F.col("total") - F.col("margin")) < 1e-9).alias("adds_up")))
    return functools.reduce(DataFrame.unionByName, parts)


# ---------------------------------------------------------------- selection


def _measured(spark, sf_dir):
    return attendance(spark, sf_dir).join(courses(spark, sf_dir), "course_id", "left").withColumn("hour", F.hour("ts"))


def spearman_correlation(spark, sf_dir):
    """Rank correlations (ties averaged) of all pairs of features."""
    return sel.spearman(_measured(spark, sf_dir), "event_id", CORR_FEATURES).withColumn("corr", F.round("corr", 6))


def average_ranks(spark, sf_dir):
    """Every event's rank in each feature."""
    return sel.average_ranks(_measured(spark, sf_dir), "event_id", CORR_FEATURES)


def feature_ranking(spark, sf_dir):
    """Greedy order of the features: relevance for attendance less redundancy."""
    table = sel.spearman(_measured(spark, sf_dir), "event_id", CORR_FEATURES)
    return spark.createDataFrame(sel.rank_features(table, "attended"), "place int, feature string, relevance double, redundancy double")


MOMENT_COLUMNS = ["l_quantity", "l_discount", "l_tax"]


def moment_sums(spark, sf_dir):
    """The sums from which the LASSO path is solved."""
    return sel.moments(fx.table(spark, sf_dir, "lineitem"), MOMENT_COLUMNS).withColumn("total", F.round("total", 4))


def lasso_path(spark, sf_dir):
    """The whole path over falling penalties, and the order in which features enter."""
    train, _ = _train_test(spark, sf_dir)
    return spark.createDataFrame(sel.lasso_ranking(train, FEATURES, "label"), "feature string, coefficient double, selected boolean, entered int")


# ---------------------------------------------------------------- CSV sources

CSV_COLUMNS = ["o_orderkey", "o_totalprice", "o_orderstatus", "o_custkey"]
CSV_TYPES = StructType().add("o_orderkey", "long").add("o_totalprice", "double").add("o_orderstatus", "string").add("o_custkey", "long")


def _csv_folder(spark, sf_dir) -> str:
    """Orders as CSV files: one part with prefixed names, one in another order."""
    orders, path = fx.table(spark, sf_dir, "orders").select(*CSV_COLUMNS), output_path(spark, "csv")
    odd = F.col("o_orderkey") % 2 == 1
    io.write_table(orders.where(odd).toDF(*[f"t.{c}" for c in CSV_COLUMNS]), f"{path}/odd", "csv")
    io.write_table(orders.where(~odd).select(*CSV_COLUMNS[::-1]), f"{path}/even", "csv")
    return path


def scan_csv(spark, sf_dir):
    """A projected scan of CSV files: names matched in every file, declared types."""
    path = _csv_folder(spark, sf_dir)
    return io.scan_project(spark, f"{path}/*", ["o_orderkey", "t.o_orderstatus", "o_totalprice"], "csv", CSV_TYPES)


def scan_directory(spark, sf_dir):
    """A whole folder of CSV files as one table, each row with its file."""
    path = _csv_folder(spark, sf_dir)
    rows = io.scan_directory(spark, f"{path}/*", "csv", "*.csv", schema=CSV_TYPES, corrupt="broken")
    return rows.select(*CSV_COLUMNS, F.col("broken").isNotNull().alias("broken"),
                       F.regexp_extract("source", "/(odd|even)/", 1).alias("part"))


# ---------------------------------------------------------------- early stopping, streams


def fit_gbt_stopped(spark, sf_dir):
    """Boosting that watches held-back rows, as the reference's configuration asks."""
    train, test = _train_test(spark, sf_dir)
    params = {**CONFIGS["gbdt"], "n_estimators": 60, "validation_fraction": 0.1, "n_iter_no_change": 10}
    fm = md.fit_model(train, FEATURES, "gbdt", params)
    p = F.col("probability")
    return md.predict(fm, test, keep=["row_id", "label"]).select(
        "row_id", "label", p.between(0.0, 1.0).alias("in_range"),
        (F.col("prediction").cast("int") == (p >= 0.5).cast("int")).alias("decided"),
        F.lit(fm.classifier.getNumTrees <= 60 and not fm.ignored_params).alias("as_asked"))


def stream_scoring(spark, sf_dir):
    """The test rows scored as a stream of files, against the batch scorer."""
    train, test = _train_test(spark, sf_dir)
    fm = md.fit_model(train, FEATURES, "logistic_reg", CONFIGS["logistic_reg"])
    path = scoring.make_scorer(fm).save(spark, output_path(spark, "scorer"))
    source = io.write_table(test.select("row_id", "label", *FEATURES), output_path(spark, "stream-source"))
    rows = io.read_table(spark, source)
    scored = score_available(read_stream(spark, source, rows.schema, max_files_per_trigger=2), path, output_path(spark, "scored"), id_col="row_id")
    batch = scoring.score_batch(spark, path, rows, id_col="row_id").select("row_id", F.col("probability").alias("in_batch"))
    return scored.join(batch, "row_id", "left").select("row_id", (F.col("probability") == F.col("in_batch")).alias("same"))


def tuned_rows(spark, sf_dir):
    """The tuned, refitted model as read back from its sink: what it must give for the
    test rows, whatever was found."""
    from tabsmith.plans.cases_tuning import write_tuned_model
    p = F.col("probability")
    return write_tuned_model(spark, sf_dir).select(
        "row_id", "label", p.between(0.0, 1.0).alias("in_range"), (F.col("prediction").cast("int") == (p >= 0.5).cast("int")).alias("decided"))


def user_rows(spark, sf_dir):
    """The per-user attribution table: every test row's user and cut-off once, ten
    different features in falling order of size."""
    from tabsmith.plans.cases_models import user_attribution
    top = range(1, 11)
    names = F.array(*[F.col(f"Feature_{i}_Name") for i in top])
    sizes = [F.abs(F.col(f"Feature_{i}_Contribution")) for i in top]
    falling = functools.reduce(lambda a, b: a & b, [x >= y for x, y in zip(sizes, sizes[1:])])
    return user_attribution(spark, sf_dir).select("user_id", "cutoff_ts", "label", F.size(F.array_distinct(names)).alias("n_features"),
                                                  falling.alias("falling"))


# ---------------------------------------------------------------- experiments and the report

TRAIN_CONFIG = {"model": {"type": "decision_tree", "params": CONFIGS["decision_tree"]}, "cross_validation": {"n_splits": 3}}
TUNE_CONFIG = {
    "model": SEARCH_CONFIG, "cross_validation": {"n_splits": 2},
    "grid_search_params": {"feature_selector_param_grid": {"max_depth": [4]}, "feature_selector_threshold": ["mean"],
                           "base_models_param_grid": {"decision_tree": {"max_depth": [2, 4]}},
                           "meta_learner_param_grid": {"C": [1.0]}, "scoring": "recall", "cv": 2},
}


def _metric_rows(table: DataFrame) -> DataFrame:
    ok = functools.reduce(lambda a, b: a & b, [F.col(m).between(0.0, 1.0) for m in met.METRIC_COLUMNS])
    return table.select("metrics_type", ok.alias("in_range"))


def train_experiment(spark, sf_dir):
    """A configured run: train, cross-validate, evaluate, save; the metric rows read back."""
    train, test = _train_test(spark, sf_dir)
    done = exp.train(TRAIN_CONFIG, train, FEATURES, "row_id", test, output_path(spark, "experiment"))
    return _metric_rows(io.read_table(spark, done.paths["metrics"]))


def tune_experiment(spark, sf_dir):
    """A configured search over the stacked pipeline: the trial log's rows, read back."""
    train, test = _train_test(spark, sf_dir)
    done = exp.tune(TUNE_CONFIG, "grid", train, FEATURES, "row_id", test, output_path(spark, "experiment"))
    trials = io.read_table(spark, done.paths["trials"])
    return trials.select("trial_id", "fold", F.col("value").between(0.0, 1.0).alias("in_range"),
                         F.col("params")["stacking__decision_tree__max_depth"].alias("max_depth"))


REPORT_MODELS = ("logistic_reg", "decision_tree", "random_forest", "gbdt")


def saved_models(spark, sf_dir) -> tuple[dict[str, str], DataFrame]:
    train, test = _train_test(spark, sf_dir)
    paths = {}
    for name, fm in md.fit_models(train, FEATURES, {m: CONFIGS[m] for m in REPORT_MODELS}).items():
        paths[name] = output_path(spark, f"model-{name}")
        fm.model.write().overwrite().save(paths[name])
    return paths, test


def saved_model_report(spark: SparkSession, paths: dict[str, str], test: DataFrame, folder: str, key: str = "row_id",
                       min_votes: int = 2) -> DataFrame:
    """The report over saved models: each is loaded, scores the rows into the stamped
    sink and is timed; then one evaluation of all models and their vote.  The vote
    takes all models but the first, as the reference does."""
    rows, run = [], io.run_folder(folder)
    for name, path in paths.items():
        start = time.perf_counter()
        scored = md.predict(md.PipelineModel.load(path), test, keep=[key, "label"])
        io.write_table(scored, f"{run}/model={name}")
        rows.append((name, time.perf_counter() - start))
    start = time.perf_counter()
    every = io.read_table(spark, run)
    voters = list(paths)[1:]
    joined = ens.ensemble_rows(every, [key], voters, strict=True)
    voted = materialize(ens.vote(joined, [key], voters, min_votes), "voted")
    rows.append(("ensemble", time.perf_counter() - start))
    both = every.select("model", "label", "prediction", "probability").unionByName(
        voted.select(F.lit("ensemble").alias("model"), "label", "prediction", "probability"))
    times = spark.createDataFrame(rows, "model string, prediction_time double")           # a row for each model
    table = ens.format_stats(met.evaluate(both, ["model"], with_stats=True)).join(F.broadcast(times), "model")
    return table.withColumnRenamed("model", "model_name")


def fitted_report(spark, sf_dir):
    """The report's rows over fitted models: how many rows each scored, and whether its
    figures are in their ranges."""
    paths, test = saved_models(spark, sf_dir)
    table = saved_model_report(spark, paths, test, output_path(spark, "report"))
    ok = functools.reduce(lambda a, b: a & b, [F.col(m).between(0.0, 1.0) for m in met.METRIC_COLUMNS])
    return table.select("model_name", "total_predictions", ok.alias("in_range"), (F.col("prediction_time") > 0).alias("timed"))


QUERIES = {f.__name__: f for f in (
    forest_attribution, boosted_attribution, attribution_sums, spearman_correlation, average_ranks, feature_ranking, moment_sums,
    lasso_path, scan_csv, scan_directory, fit_gbt_stopped, stream_scoring, tuned_rows, user_rows, train_experiment, tune_experiment, fitted_report)}

# ---------------------------------------------------------------- SQL twins

_MEASURED = f"""WITH {ATT}, b AS (SELECT a.event_id, {", ".join("CAST(hour(a.ts) AS DOUBLE) AS hour" if c == "hour" else f"CAST({c} AS DOUBLE) AS {c}"
                                                                  for c in CORR_FEATURES)} FROM a LEFT JOIN crs USING (course_id)),
  r AS (SELECT event_id, {", ".join(f'''CASE WHEN {c} IS NOT NULL THEN rank() OVER (ORDER BY {c} NULLS LAST)
          + (count(*) OVER (PARTITION BY {c}) - 1) / 2e0 END AS {c}_rank''' for c in CORR_FEATURES)} FROM b)"""
_RANK_PAIRS = [(x, y) for i, x in enumerate(CORR_FEATURES) for y in CORR_FEATURES[i + 1:]]
_NAMES = ["", *MOMENT_COLUMNS]


def _moment_sql() -> str:
    x = lambda c: f"CAST({c} AS DOUBLE)" if c else "1e0"
    return " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(sum({x(a)} * {x(b)}), 4) AS total FROM lineitem"
                              for i, b in enumerate(_NAMES) for a in _NAMES[i:])


SQL = {
    "attribution_sums": f"""WITH {_TEST_ROWS} SELECT model, row_id, label, true AS adds_up
      FROM test, (VALUES {", ".join(f"('{m}')" for m in ENSEMBLES)}) AS k(model)""",
    "spearman_correlation": _MEASURED + " UNION ALL ".join(
        f" SELECT '{x}' AS feature_a, '{y}' AS feature_b, round(corr({x}_rank, {y}_rank), 6) AS corr FROM r" for x, y in _RANK_PAIRS),
    "average_ranks": f"{_MEASURED} SELECT * FROM r",
    "moment_sums": _moment_sql(),
    "scan_csv": "SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice FROM orders",
    "scan_directory": """SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice, o_orderstatus, o_custkey, false AS broken,
      CASE WHEN o_orderkey % 2 = 1 THEN 'odd' ELSE 'even' END AS part FROM orders""",
    "fit_gbt_stopped": f"WITH {_TEST_ROWS} SELECT row_id, label, true AS in_range, true AS decided, true AS as_asked FROM test",
    "stream_scoring": f"WITH {_TEST_ROWS} SELECT row_id, true AS same FROM test",
    "tuned_rows": f"WITH {_TEST_ROWS} SELECT row_id, label, true AS in_range, true AS decided FROM test",
    "user_rows": f"""WITH {_TEST_ROWS} SELECT o_custkey AS user_id, o_orderdate AS cutoff_ts, label, 10 AS n_features, true AS falling
      FROM test JOIN orders ON o_orderkey = row_id""",
    "train_experiment": """SELECT 'cross_validation_' || k AS metrics_type, true AS in_range
      FROM (VALUES ('fold_1'), ('fold_2'), ('fold_3'), ('mean'), ('std')) a(k)
      UNION ALL SELECT k, true FROM (VALUES ('train'), ('test')) b(k)""",
    "tune_experiment": """SELECT t AS trial_id, f AS fold, true AS in_range, d AS max_depth
      FROM (VALUES (0, '2'), (1, '4')) a(t, d), (VALUES (1), (2)) b(f)""",
    "fitted_report": f"""WITH {_TEST_ROWS} SELECT m AS model_name, count(*) AS total_predictions, true AS in_range, true AS timed
      FROM test, (VALUES {", ".join(f"('{m}')" for m in (*REPORT_MODELS, "ensemble"))}) k(m) GROUP BY m""",
}
