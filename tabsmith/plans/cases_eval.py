"""Registered checks: evaluation (E*) and report / ensemble (R*, S6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.operators import ensemble as ens
from tabsmith.operators import metrics as met
from tabsmith.operators.rank import hash_rank
from tabsmith.plans import fixtures as fx
from tabsmith.session import output_path

KEYS = ["user_id", "cutoff_ts"]
N_FOLDS = 5


def _pred(spark, sf_dir, extra=(), base=None):
    return fx.predictions(spark, sf_dir, extra, base)


def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return met.confusion_counts(_pred(spark, sf_dir), ["model"])


def binary_metrics(spark, sf_dir):
    return met.binary_metrics(_pred(spark, sf_dir), ["model"])


def roc_auc(spark, sf_dir):
    return met.roc_auc(_pred(spark, sf_dir), ["model"])


def roc_curve(spark, sf_dir):
    return met.roc_curve(_pred(spark, sf_dir), ["model"])


def _phase(df):
    return df.withColumn("metrics_type", F.when(F.col("cutoff_ts") < F.lit(fx.PHASE_CUTOFF).cast("timestamp_ntz"),
                                                "train").otherwise("test"))


def metrics_long(spark, sf_dir):
    p = _phase(_pred(spark, sf_dir))
    return met.evaluate(p, ["model", "metrics_type"])


def fold_base(spark, sf_dir, k=N_FOLDS):
    base = fx.order_labels(spark, sf_dir)
    r = hash_rank(base, [], "row_id", fx.SEED, size_col=None)
    return r.withColumn("fold", (F.pmod(F.col("rank") - 1, F.lit(k)) + 1).cast("int")).drop("rank")


def cv_summary(spark, sf_dir):
    p = _pred(spark, sf_dir, ("fold",), fold_base(spark, sf_dir))
    per_fold = met.evaluate(p, ["model", "fold"], digits=None)
    return met.summarize_folds(per_fold, ["model"])


def ensemble_join(spark, sf_dir):
    """All models' predictions of a key side by side, repeated keys combined."""
    return ens.ensemble_rows(fx.predictions(spark, sf_dir, models=fx.ENSEMBLE_MODELS), KEYS, fx.ENSEMBLE_MODELS)


def _voted(spark, sf_dir):
    j = ensemble_join(spark, sf_dir)
    return ens.vote(j, KEYS, fx.ENSEMBLE_MODELS, min_votes=3)


def row_mode(spark, sf_dir):
    return _voted(spark, sf_dir).select(*KEYS, "label")


def majority_vote(spark, sf_dir):
    return _voted(spark, sf_dir).select(*KEYS, "prediction")


def soft_vote(spark, sf_dir):
    return _voted(spark, sf_dir).select(*KEYS, F.round("probability", 6).alias("probability"))


def prediction_stats(spark, sf_dir):
    return ens.prediction_stats(_pred(spark, sf_dir), ["model"])


def percent_format(spark, sf_dir):
    s = ens.prediction_stats(_pred(spark, sf_dir), ["model"], digits=None)
    return ens.format_stats(s).select("model", "positive_rate", "average_confidence", "confidence_std")


def leaderboard(spark, sf_dir):
    """Per-model metrics and statistics plus the voted ensemble, one table."""
    p = _pred(spark, sf_dir)
    voted = _voted(spark, sf_dir).withColumn("model", F.lit("ensemble"))
    both = p.select("model", "label", "prediction", "probability").unionByName(
        voted.select("model", "label", "prediction", "probability"))
    return ens.format_stats(met.evaluate(both, ["model"], with_stats=True)) \
        .withColumnRenamed("model", "model_name")


def pivot_predictions(spark, sf_dir):
    return ens.pivot_models(_pred(spark, sf_dir), ["row_id"], fx.MODEL_NAMES)


def scoring_time(spark, sf_dir):
    """Wall time to load each saved model and to score and write the test rows with
    it, and that of the vote."""
    from tabsmith.plans import cases_library as lib
    paths, test = lib.saved_models(spark, sf_dir)
    table = lib.saved_model_report(spark, paths, test, output_path(spark, "report"))
    return table.select("model_name", "prediction_time")


QUERIES = {
    "confusion_matrix": confusion_matrix,
    "binary_metrics": binary_metrics,
    "roc_auc": roc_auc,
    "roc_curve": roc_curve,
    "metrics_long": metrics_long,
    "cv_summary": cv_summary,
    "ensemble_join": ensemble_join,
    "row_mode": row_mode,
    "majority_vote": majority_vote,
    "soft_vote": soft_vote,
    "prediction_stats": prediction_stats,
    "percent_format": percent_format,
    "leaderboard": leaderboard,
    "pivot_predictions": pivot_predictions,
    "scoring_time": scoring_time,
}

# ---------------------------------------------------------------- SQL twins

_P = fx.predictions_sql()


def _counts_sql(src: str, groups: str) -> str:
    return f"""SELECT {groups}, count_if(label=0 AND prediction=0) AS tn, count_if(label=0 AND prediction=1) AS fp,
           count_if(label=1 AND prediction=0) AS fn, count_if(label=1 AND prediction=1) AS tp
    FROM {src} GROUP BY {groups}"""


def _ratio(num, den, digits=True):
    e = f"CASE WHEN ({den}) = 0 THEN 0.0 ELSE CAST({num} AS DOUBLE) / ({den}) END"
    return f"round({e}, 6)" if digits else e


def _metrics_sql(groups: str, digits=True) -> str:
    return f"""SELECT {groups},
      {_ratio('tp+tn', 'tp+tn+fp+fn', digits)} AS accuracy,
      {_ratio('tp', 'tp+fp', digits)} AS precision,
      {_ratio('tp', 'tp+fn', digits)} AS recall,
      {_ratio('2*tp', '2*tp+fp+fn', digits)} AS f1 FROM c"""


def _auc_sql(src: str, groups: str, digits=True) -> str:
    auc = ("CASE WHEN sum(pos)=0 OR sum(neg)=0 THEN NULL ELSE "
           "sum(pos*(cum_neg + neg*0.5)) / (CAST(sum(pos) AS DOUBLE)*sum(neg)) END")
    if digits:
        auc = f"round({auc}, 6)"
    return f"""h AS (SELECT {groups}, probability, count_if(label=1) AS pos, count_if(label=0) AS neg
              FROM {src} GROUP BY {groups}, probability),
  hc AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY {groups} ORDER BY probability
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cum_neg FROM h),
  a AS (SELECT {groups}, {auc} AS auc_roc FROM hc GROUP BY {groups})"""


def _evaluate_sql(src: str, groups: str, digits=True) -> str:
    """CTEs c, m, a, e(groups, accuracy..auc_roc) over ``src``."""
    gcols = ", ".join(f"m.{g.strip()}" for g in groups.split(","))
    using = ", ".join(g.strip() for g in groups.split(","))
    return f"""c AS ({_counts_sql(src, groups)}),
  m AS ({_metrics_sql(groups, digits)}),
  {_auc_sql(src, groups, digits)},
  e AS (SELECT m.*, a.auc_roc FROM m JOIN a USING ({using}))"""


_PHASE = (f"CASE WHEN cutoff_ts < TIMESTAMP '{fx.PHASE_CUTOFF}' THEN 'train' ELSE 'test' END")

_FOLDS = f"""base_f AS (SELECT *, CAST((row_number() OVER (ORDER BY md5(CAST(row_id AS VARCHAR) || '|{fx.SEED}'), row_id) - 1) % {N_FOLDS} + 1 AS INTEGER) AS fold FROM base)"""


def _join_sql() -> str:
    parts = []
    for i, m in enumerate(fx.ENSEMBLE_MODELS):
        parts.append(f"(SELECT user_id, cutoff_ts, label AS label_{m}, prediction AS prediction_{m}, "
                     f"probability AS probability_{m} FROM pred WHERE model = '{m}') t{i}")
    sql = parts[0]
    for p in parts[1:]:
        sql += f"\n    JOIN {p} USING (user_id, cutoff_ts)"
    return f"j AS (SELECT * FROM {sql})"


def _vote_sql() -> str:
    ms = fx.ENSEMBLE_MODELS
    labels = ", ".join(f"label_{m}" for m in ms)
    mode = (f"(SELECT v FROM (SELECT unnest([{labels}]) AS v) u WHERE v IS NOT NULL "
            f"GROUP BY v ORDER BY count(*) DESC, v LIMIT 1)")
    votes = " + ".join(f"coalesce(prediction_{m}, 0)" for m in ms)
    psum = " + ".join(f"coalesce(probability_{m}, 0.0)" for m in ms)
    pcnt = " + ".join(f"CAST(probability_{m} IS NOT NULL AS INTEGER)" for m in ms)
    return f"""v AS (SELECT user_id, cutoff_ts, CAST({mode} AS INTEGER) AS label,
      CAST(CASE WHEN {votes} >= 3 THEN 1 ELSE 0 END AS INTEGER) AS prediction,
      CASE WHEN ({pcnt}) = 0 THEN NULL ELSE ({psum}) / ({pcnt}) END AS probability FROM j)"""


def _stats_sql(src: str, digits=True) -> str:
    r = (lambda e: f"round({e}, 6)") if digits else (lambda e: e)
    return f"""SELECT model, count(*) AS total_predictions, CAST(sum(prediction) AS BIGINT) AS positive_count,
      {r('avg(prediction)')} AS positive_rate, {r('avg(probability)')} AS average_confidence,
      {r('stddev_samp(probability)')} AS confidence_std,
      count_if(probability > 0.9) + count_if(probability < 0.1) AS high_confidence_predictions,
      count_if(probability >= 0.4 AND probability <= 0.6) AS low_confidence_predictions
    FROM {src} GROUP BY model"""


def _pct(c):
    return f"printf('%.2f%%', {c} * 100)"


def _combined_sql() -> str:
    """The rows of each key by model, combined by unnesting."""
    entry = "struct_pack(label := label, prediction := prediction, probability := probability)"
    lists = ", ".join(f"list({entry}) FILTER (WHERE model = '{m}') AS l{i}" for i, m in enumerate(fx.ENSEMBLE_MODELS))
    steps, n = "", len(fx.ENSEMBLE_MODELS)
    for i in range(n):
        held = [f"u{j}" for j in range(i)] + [f"l{j}" for j in range(i + 1, n)]
        steps += f", s{i} AS (SELECT user_id, cutoff_ts, {', '.join([*held, f'unnest(l{i}) AS u{i}'])} FROM {f's{i - 1}' if i else 'g'})"
    columns = ", ".join(f"u{i}.{c} AS {c}_{m}" for i, m in enumerate(fx.ENSEMBLE_MODELS) for c in ens.VALUE_COLUMNS)
    return f"""WITH {_P}, g AS (SELECT user_id, cutoff_ts, {lists} FROM pred GROUP BY user_id, cutoff_ts){steps}
      SELECT user_id, cutoff_ts, {columns} FROM s{n - 1}"""


SQL = {
    "confusion_matrix": f"WITH {_P} {_counts_sql('pred', 'model')}",
    "binary_metrics": f"WITH {_P}, c AS ({_counts_sql('pred', 'model')}) {_metrics_sql('model')}",
    "roc_auc": f"WITH {_P}, {_auc_sql('pred', 'model')} SELECT * FROM a",
    "roc_curve": f"""WITH {_P},
  h AS (SELECT model, probability, count_if(label=1) AS pos, count_if(label=0) AS neg FROM pred GROUP BY model, probability),
  hc AS (SELECT *, coalesce(sum(pos) OVER w, 0) AS cum_pos, coalesce(sum(neg) OVER w, 0) AS cum_neg,
                sum(pos) OVER (PARTITION BY model) AS total_pos, sum(neg) OVER (PARTITION BY model) AS total_neg
         FROM h WINDOW w AS (PARTITION BY model ORDER BY probability ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
  SELECT model, CAST(probability AS DOUBLE) AS threshold,
         round((total_neg - cum_neg) / CAST(total_neg AS DOUBLE), 6) AS fpr,
         round((total_pos - cum_pos) / CAST(total_pos AS DOUBLE), 6) AS tpr FROM hc
  UNION ALL SELECT DISTINCT model, CAST('inf' AS DOUBLE), 0.0, 0.0 FROM pred""",
    "metrics_long": f"""WITH {_P}, pp AS (SELECT *, {_PHASE} AS metrics_type FROM pred),
  {_evaluate_sql('pp', 'model, metrics_type')} SELECT * FROM e""",
    "ensemble_join": _combined_sql(),
    "row_mode": f"WITH {_P}, {_join_sql()}, {_vote_sql()} SELECT user_id, cutoff_ts, label FROM v",
    "majority_vote": f"WITH {_P}, {_join_sql()}, {_vote_sql()} SELECT user_id, cutoff_ts, prediction FROM v",
    "soft_vote": f"WITH {_P}, {_join_sql()}, {_vote_sql()} SELECT user_id, cutoff_ts, round(probability, 6) AS probability FROM v",
    "prediction_stats": f"WITH {_P} {_stats_sql('pred')}",
    "percent_format": f"""WITH {_P}, s AS ({_stats_sql('pred', digits=False)})
  SELECT model, {_pct('positive_rate')} AS positive_rate, {_pct('average_confidence')} AS average_confidence,
         {_pct('confidence_std')} AS confidence_std FROM s""",
    "leaderboard": f"""WITH {_P}, {_join_sql()}, {_vote_sql()},
  both_ AS (SELECT model, label, prediction, probability FROM pred
            UNION ALL SELECT 'ensemble' AS model, label, prediction, probability FROM v),
  {_evaluate_sql('both_', 'model')},
  s AS ({_stats_sql('both_', digits=False)})
  SELECT e.model AS model_name, e.accuracy, e.precision, e.recall, e.f1, e.auc_roc,
         s.total_predictions, s.positive_count, {_pct('s.positive_rate')} AS positive_rate,
         {_pct('s.average_confidence')} AS average_confidence, {_pct('s.confidence_std')} AS confidence_std,
         s.high_confidence_predictions, s.low_confidence_predictions
  FROM e JOIN s ON e.model = s.model""",
    "pivot_predictions": f"""WITH {_P} SELECT row_id, """ + ",\n  ".join(
        f"max(CASE WHEN model = '{m}' THEN {c} END) AS {c}_{m}"
        for m in fx.MODEL_NAMES for c in ("label", "prediction", "probability")) + " FROM pred GROUP BY row_id",
}

_PF = fx.predictions_sql(["fold"], _FOLDS, "base_f")
SQL["cv_summary"] = f"""WITH {_PF},
  {_evaluate_sql('pred', 'model, fold', digits=False)}
  SELECT model, 'cross_validation_fold_' || CAST(fold AS VARCHAR) AS metrics_type,
         round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall,
         round(f1, 6) AS f1, round(auc_roc, 6) AS auc_roc FROM e
  UNION ALL SELECT model, 'cross_validation_mean', round(avg(accuracy), 6), round(avg(precision), 6),
         round(avg(recall), 6), round(avg(f1), 6), round(avg(auc_roc), 6) FROM e GROUP BY model
  UNION ALL SELECT model, 'cross_validation_std', round(stddev_pop(accuracy), 6), round(stddev_pop(precision), 6),
         round(stddev_pop(recall), 6), round(stddev_pop(f1), 6), round(stddev_pop(auc_roc), 6) FROM e GROUP BY model"""
