"""Binary-classification evaluation as grouped aggregations.

Every metric is computed for any number of (model, phase, fold, ...) groups
in one pass, so k models or k folds cost one shuffle, not k jobs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.functions.nulls import ratio_or_zero
from tabsmith.operators.rank import default_cells, running_sums

METRIC_COLUMNS = ["accuracy", "precision", "recall", "f1", "auc_roc"]


def confusion_counts(df: DataFrame, group_cols: Sequence[str] = (), label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    """2x2 confusion matrix as columns tn, fp, fn, tp (one row per group)."""
    y, p = F.col(label), F.col(prediction)
    return df.groupBy(*group_cols).agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


def metrics_from_counts(counts: DataFrame, digits: int | None = 6) -> DataFrame:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    exprs = {
        "accuracy": ratio_or_zero(tp + tn, tp + tn + fp + fn),
        "precision": ratio_or_zero(tp, tp + fp),
        "recall": ratio_or_zero(tp, tp + fn),
        "f1": ratio_or_zero(2 * tp, 2 * tp + fp + fn),
    }
    if digits is not None:
        exprs = {k: F.round(v, digits) for k, v in exprs.items()}
    return counts.withColumns(exprs)


def binary_metrics(df: DataFrame, group_cols: Sequence[str] = (), label: str = "label",
                   prediction: str = "prediction", digits: int | None = 6) -> DataFrame:
    """accuracy, precision, recall, f1 per group (0 when a denominator is 0)."""
    counts = confusion_counts(df, group_cols, label, prediction)
    return metrics_from_counts(counts, digits).drop("tn", "fp", "fn", "tp")


def _score_cell(score: str, cells: int):
    # probabilities live in [0, 1]; clamping keeps the cell monotone for others
    s = F.least(F.greatest(F.col(score).cast("double"), F.lit(0.0)), F.lit(1.0))
    return F.least(F.floor(s * F.lit(cells)), F.lit(cells - 1))


def score_histogram(df: DataFrame, group_cols: Sequence[str], label: str = "label",
                    score: str = "probability", prediction: str | None = "prediction") -> DataFrame:
    """One map-side-combined pass: per (group, distinct score) the label /
    prediction counts every metric here derives from."""
    y = F.col(label)
    aggs = [F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")]
    if prediction is not None:
        p = F.col(prediction)
        aggs += [F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
                 F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"),
                 F.count(F.lit(1)).alias("n"), F.sum(p.cast("long")).alias("pred_sum")]
    return df.groupBy(*group_cols, score).agg(*aggs)


def counts_from_histogram(h: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    return h.groupBy(*group_cols).agg(*[F.sum(c).cast("long").alias(c) for c in ("tn", "fp", "fn", "tp")])


def auc_from_histogram(h: DataFrame, group_cols: Sequence[str], score: str = "probability",
                       digits: int | None = 6, cells: int | None = None) -> DataFrame:
    """Exact AUC from a score histogram.

    The area splits into a within-cell part (negatives below each score inside
    its cell: one window over (group, cell)) and a cross-cell part
    (positives of a cell times negatives of all lower cells: a running sum over
    the per-cell table, at most groups x cells rows).  Every term is a
    multiple of 1/2, so the sums are exact in any order.
    """
    group_cols = list(group_cols)
    cells = cells or default_cells(h)
    x = h.select(*group_cols, score, "pos", "neg").withColumn("_cell", _score_cell(score, cells))
    w = Window.partitionBy(*group_cols, "_cell").orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    loc = x.withColumn("_nb", F.coalesce(F.sum("neg").over(w), F.lit(0)))
    per_cell = loc.groupBy(*group_cols, "_cell").agg(
        F.sum(F.col("pos") * (F.col("_nb") + F.col("neg") * 0.5)).alias("_in"),
        F.sum("pos").alias("_pc"), F.sum("neg").alias("_nc"))
    wc = (Window.partitionBy(*group_cols) if group_cols else Window.partitionBy()) \
        .orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    per_cell = per_cell.withColumn("_below", F.coalesce(F.sum("_nc").over(wc), F.lit(0)))
    agg = per_cell.groupBy(*group_cols).agg(
        F.sum(F.col("_in") + F.col("_pc") * F.col("_below")).alias("_area"),
        F.sum("_pc").alias("_p"), F.sum("_nc").alias("_n"))
    auc = F.when((F.col("_p") == 0) | (F.col("_n") == 0), F.lit(None).cast("double")) \
        .otherwise(F.col("_area") / (F.col("_p").cast("double") * F.col("_n")))
    if digits is not None:
        auc = F.round(auc, digits)
    return agg.select(*group_cols, auc.alias("auc_roc"))


def _by_cell(p, n) -> list:
    """Sums of a cell from which means and spreads are put together: scores count from
    the cell's least one (``_low``), so that their squares stay small."""
    return [F.sum((p - F.col("_low")) * n).alias("_d1"), F.sum((p - F.col("_low")) * (p - F.col("_low")) * n).alias("_d2"),
            F.max("_low").alias("_low")]


def _with_spread(per_cell: DataFrame, group_cols: Sequence[str]) -> tuple[DataFrame, list]:
    """(cells with the group's mean, aggregates ``_mean`` and ``_m2`` of the group): the
    squares around the mean within cells and between them."""
    every = Window.partitionBy(*group_cols)
    out = per_cell.withColumn("_mean", F.col("_low") + F.col("_d1") / F.col("n"))
    # The group's mean is taken from its least cell on, for the same reason.
    out = out.withColumn("_base", F.min("_low").over(every))
    out = out.withColumn("_all", F.col("_base") + F.sum((F.col("_mean") - F.col("_base")) * F.col("n")).over(every) / F.sum("n").over(every))
    around = F.col("_d2") - F.col("_d1") * F.col("_d1") / F.col("n") + F.col("n") * F.pow(F.col("_mean") - F.col("_all"), F.lit(2.0))
    return out, [F.max("_all").alias("_mean"), F.sum(around).alias("_m2")]


def _stats_columns() -> dict:
    n = F.col("total_predictions").cast("double")
    var = F.greatest(F.col("_m2"), F.lit(0.0)) / F.when(n > 1, n - 1)
    return {"positive_rate": F.col("positive_count") / n, "average_confidence": F.col("_mean"), "confidence_std": F.sqrt(var)}


def _confidence(p, n) -> list:
    return [F.sum(F.when((p > 0.9) | (p < 0.1), n).otherwise(0)).alias("_hi"),
            F.sum(F.when((p >= 0.4) & (p <= 0.6), n).otherwise(0)).alias("_lo")]


STATS_COLUMNS = ["total_predictions", "positive_count", "positive_rate", "average_confidence", "confidence_std",
                 "high_confidence_predictions", "low_confidence_predictions"]


def stats_from_histogram(h: DataFrame, group_cols: Sequence[str], score: str = "probability",
                         digits: int | None = 6, cells: int | None = None) -> DataFrame:
    """Prediction statistics from the histogram."""
    group_cols, p, n = list(group_cols), F.col(score).cast("double"), F.col("n")
    x = h.withColumn("_cell", _score_cell(score, cells or default_cells(h)))
    x = x.withColumn("_low", F.min(p).over(Window.partitionBy(*group_cols, "_cell")))
    per_cell = x.groupBy(*group_cols, "_cell").agg(F.sum("n").alias("n"), F.sum("pred_sum").alias("pred_sum"),
                                                   *_by_cell(p, n), *_confidence(p, n))
    per_cell, spread = _with_spread(per_cell, group_cols)
    agg = per_cell.groupBy(*group_cols).agg(
        F.sum("n").cast("long").alias("total_predictions"), F.sum("pred_sum").cast("long").alias("positive_count"), *spread,
        F.sum("_hi").cast("long").alias("high_confidence_predictions"), F.sum("_lo").cast("long").alias("low_confidence_predictions"))
    exprs = _stats_columns()
    if digits is not None:
        exprs = {k: F.round(v, digits) for k, v in exprs.items()}
    return agg.withColumns(exprs).select(*group_cols, *STATS_COLUMNS)


def roc_auc(df: DataFrame, group_cols: Sequence[str] = (), label: str = "label",
            score: str = "probability", digits: int | None = 6,
            cells: int | None = None) -> DataFrame:
    """Exact ROC AUC per group; tied scores count one half.

    AUC = sum_s pos(s) * (neg(<s) + neg(s)/2) / (P * N).  The negatives below
    each distinct score are a running sum computed by ``running_sums`` so one
    model with many distinct scores is still spread over many tasks.
    NULL when a group has a single class.
    """
    h = score_histogram(df, group_cols, label, score, prediction=None)
    return auc_from_histogram(h, group_cols, score, digits, cells)


def roc_curve(df: DataFrame, group_cols: Sequence[str] = (), label: str = "label",
              score: str = "probability", digits: int | None = 6,
              cells: int | None = None) -> DataFrame:
    """ROC points per group: one per distinct score (threshold = score,
    predicted positive when score >= threshold) plus the (0, 0) start point
    at threshold +inf.  No collinear points are dropped.
    """
    group_cols = list(group_cols)
    cells = cells or default_cells(df)
    hist = score_histogram(df, group_cols, label, score, prediction=None)
    cum = running_sums(hist, group_cols, [F.col(score)], _score_cell(score, cells),
                       {"pos": F.col("pos"), "neg": F.col("neg")},
                       inclusive=False, totals=True)
    tp = F.col("total_pos") - F.col("cum_pos")
    fp = F.col("total_neg") - F.col("cum_neg")
    pts = cum.select(*group_cols, F.col(score).cast("double").alias("threshold"),
                     (fp / F.col("total_neg")).alias("fpr"),
                     (tp / F.col("total_pos")).alias("tpr"))
    start = hist.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_c")).select(
        *group_cols, F.lit(float("inf")).alias("threshold"),
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    out = pts.unionByName(start)
    if digits is not None:
        out = out.withColumns({"fpr": F.round("fpr", digits), "tpr": F.round("tpr", digits)})
    return out


def evaluate(df: DataFrame, group_cols: Sequence[str] = (), label: str = "label",
             prediction: str = "prediction", score: str = "probability",
             digits: int | None = 6, with_stats: bool = False, cells: int | None = None) -> DataFrame:
    """accuracy, precision, recall, f1, auc_roc (and optionally the prediction
    statistics) per group as ONE linear plan:

    score histogram (map-side combined) -> window inside (group, cell) ->
    per-cell sums (same partitioning) -> running sum over the per-cell table ->
    one final aggregation per group.  Nothing is read twice and no branch is
    joined back.
    """
    return evaluate_histogram(score_histogram(df, group_cols, label, score, prediction), group_cols, score, digits, with_stats, cells)


def evaluate_histogram(h: DataFrame, group_cols: Sequence[str] = (), score: str = "probability",
                       digits: int | None = 6, with_stats: bool = False, cells: int | None = None) -> DataFrame:
    """``evaluate`` from a score histogram on."""
    group_cols = list(group_cols)
    cells = cells or default_cells(h)
    x = h.withColumn("_cell", _score_cell(score, cells))
    w = Window.partitionBy(*group_cols, "_cell").orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    p, n = F.col(score).cast("double"), F.col("n")
    loc = x.withColumns({"_nb": F.coalesce(F.sum("neg").over(w), F.lit(0)),
                         "_low": F.min(p).over(Window.partitionBy(*group_cols, "_cell"))})
    per_cell = loc.groupBy(*group_cols, "_cell").agg(
        F.sum(F.col("pos") * (F.col("_nb") + F.col("neg") * 0.5)).alias("_in"),
        F.sum("pos").alias("_pc"), F.sum("neg").alias("_nc"),
        *[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn", "n", "pred_sum")], *_by_cell(p, n), *_confidence(p, n))
    wc = (Window.partitionBy(*group_cols) if group_cols else Window.partitionBy()) \
        .orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    per_cell = per_cell.withColumn("_below", F.coalesce(F.sum("_nc").over(wc), F.lit(0)))
    per_cell, spread = _with_spread(per_cell, group_cols)
    agg = per_cell.groupBy(*group_cols).agg(
        F.sum(F.col("_in") + F.col("_pc") * F.col("_below")).alias("_area"),
        F.sum("_pc").alias("_p"), F.sum("_nc").alias("_n"),
        *[F.sum(c).cast("long").alias(c) for c in ("tp", "fp", "fn", "tn")],
        F.sum("n").cast("long").alias("total_predictions"),
        F.sum("pred_sum").cast("long").alias("positive_count"), *spread,
        F.sum("_hi").cast("long").alias("high_confidence_predictions"),
        F.sum("_lo").cast("long").alias("low_confidence_predictions"))
    out = metrics_from_counts(agg, digits)
    auc = F.when((F.col("_p") == 0) | (F.col("_n") == 0), F.lit(None).cast("double")) \
        .otherwise(F.col("_area") / (F.col("_p").cast("double") * F.col("_n")))
    cols = [*group_cols, *METRIC_COLUMNS[:4], (F.round(auc, digits) if digits is not None else auc).alias("auc_roc")]
    if with_stats:
        own = _stats_columns()
        cols += [own[c].alias(c) if c in own else c for c in STATS_COLUMNS]
    return out.select(*cols)


def summarize_folds(fold_metrics: DataFrame, group_cols: Sequence[str] = (),
                    fold_col: str = "fold", metrics: Sequence[str] = METRIC_COLUMNS,
                    prefix: str = "cross_validation", digits: int | None = 6) -> DataFrame:
    """Fold rows plus ``_mean`` and population ``_std`` rows (metrics_type).

    One pass over the per-fold table: each group's fold rows (k of them, a
    bounded list) are collected next to their mean and std and exploded.
    """
    group_cols = list(group_cols)
    r = (lambda e: F.round(e, digits)) if digits is not None else (lambda e: e)
    row = lambda name, vals: F.struct(name.alias("metrics_type"),
                                      *[r(v.cast("double")).alias(m) for m, v in zip(metrics, vals)])
    agg = fold_metrics.groupBy(*group_cols).agg(
        F.collect_list(row(F.concat(F.lit(f"{prefix}_fold_"), F.col(fold_col).cast("string")),
                           [F.col(m) for m in metrics])).alias("_rows"),
        row(F.lit(f"{prefix}_mean"), [F.avg(m) for m in metrics]).alias("_mean"),
        row(F.lit(f"{prefix}_std"), [F.stddev_pop(m) for m in metrics]).alias("_std"))
    out = agg.select(*group_cols, F.explode(F.concat("_rows", F.array("_mean", "_std"))).alias("_r"))
    return out.select(*group_cols, "_r.*")
