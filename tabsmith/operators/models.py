"""Model registry, fitting and scoring on Spark ML.

Each reference model type maps onto a Spark ML classifier.  Parameters that
map are translated; the rest are returned in ``ignored_params`` (visible,
never silent).  Scoring keeps everything in the JVM: the class-1 probability
is ``vector_to_array(probability)[1]``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       MultilayerPerceptronClassifier, RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.session import even, storage_memory

FEATURES = "features"
PROB_VEC = "probability_vec"
SPARK_MAX_DEPTH = 30
_RANGE = re.compile(r"^\s*range\(\s*(-?\d+)\s*(?:,\s*(-?\d+)\s*)?(?:,\s*(-?\d+)\s*)?\)\s*$")


def expand_range(value):
    """``'range(a, b, c)'`` -> list(range(a, b, c)) (parsed, never evaluated)."""
    if isinstance(value, str):
        m = _RANGE.match(value)
        if m:
            nums = [int(g) for g in m.groups() if g is not None]
            return list(range(*nums))
    return value


def expand_params(params: Mapping) -> dict:
    return {k: expand_range(v) for k, v in (params or {}).items()}


def _common(est_kwargs, params, used, name, target, default=None, conv=lambda v: v):
    if name in params and params[name] is not None:
        est_kwargs[target] = conv(params[name])
        used.add(name)
    elif default is not None:
        est_kwargs[target] = default
    if name in params:
        used.add(name)


def _feature_strategy(v):
    if isinstance(v, str):
        return v if v in ("auto", "all", "onethird", "sqrt", "log2") else str(v)
    if isinstance(v, float):
        return str(v)
    if isinstance(v, int):
        return str(v)
    return "auto"


def _depth(v, default):
    if v is None or v == -1:
        return default
    return min(int(v), SPARK_MAX_DEPTH)


def _depth_used(p) -> set:
    """A depth that Spark can't reach is reported as ignored, not cut silently."""
    v = p.get("max_depth")
    return set() if v is not None and int(v) > SPARK_MAX_DEPTH else {"max_depth"}


def _only(p, name, accepted) -> set:
    """``name`` counts as used only where Spark does what its value asks for."""
    return {name} if p.get(name) in (None, *accepted) else set()


def _decision_tree(p, n_features, n_rows):
    kw, used = {}, {"random_state"}
    _common(kw, p, used, "criterion", "impurity", "gini")
    kw["maxDepth"] = _depth(p.get("max_depth"), SPARK_MAX_DEPTH)
    used |= _depth_used(p)
    _common(kw, p, used, "min_samples_leaf", "minInstancesPerNode", conv=int)
    _common(kw, p, used, "min_impurity_decrease", "minInfoGain", conv=float)
    _common(kw, p, used, "max_bins", "maxBins", conv=int)
    kw["seed"] = int(p.get("random_state", 42))
    return DecisionTreeClassifier(**kw), used


def _random_forest(p, n_features, n_rows):
    kw, used = {}, {"random_state"}
    _common(kw, p, used, "n_estimators", "numTrees", 100, int)
    _common(kw, p, used, "criterion", "impurity", "gini")
    kw["maxDepth"] = _depth(p.get("max_depth"), SPARK_MAX_DEPTH)
    used |= _depth_used(p)
    _common(kw, p, used, "max_features", "featureSubsetStrategy", "sqrt", _feature_strategy)
    if "max_features" in p and p["max_features"] is None:
        kw["featureSubsetStrategy"] = "all"
        used.add("max_features")
    _common(kw, p, used, "min_samples_leaf", "minInstancesPerNode", conv=int)
    _common(kw, p, used, "bootstrap", "bootstrap", conv=bool)
    _common(kw, p, used, "max_samples", "subsamplingRate", conv=float)
    kw["seed"] = int(p.get("random_state", 42))
    return RandomForestClassifier(**kw), used


#: Column that marks the rows on which boosting is watched.
VALIDATION = "_validation"
#: Hash of a row's inputs, kept where the inputs themselves are assembled.
ROW_HASH = "_row_hash"
EARLY_STOPPING = ("n_iter_no_change", "early_stopping_rounds")


def _early_stopping(est, p, used):
    """Boosting ends once a further tree no longer lowers the error on held-back rows
    by ``tol`` (Spark waits for one such tree, however many rounds are asked for)."""
    if any(p.get(name) for name in EARLY_STOPPING):
        est._set(validationIndicatorCol=VALIDATION, validationTol=float(p.get("tol") or 1e-4))
        used |= {*EARLY_STOPPING, "validation_fraction", "tol"}


def with_validation(df: DataFrame, est, params: Mapping, inputs) -> DataFrame:
    """The rows with their mark, if the estimator asks for one: ``validation_fraction``
    of them (a tenth, if not said) by a hash of ``inputs``, so equal rows stay together."""
    if not est.hasParam("validationIndicatorCol") or not est.isSet("validationIndicatorCol"):
        return df
    share = float((params or {}).get("validation_fraction") or 0.1)
    row = F.col(ROW_HASH) if ROW_HASH in df.columns else F.xxhash64(*inputs)
    return df.withColumn(VALIDATION, F.pmod(row, F.lit(1 << 20)) < share * (1 << 20))


def _gbt(p, n_features, n_rows, depth_default=3):
    kw, used = {}, {"random_state"}
    used |= _only(p, "loss", ("log_loss", "deviance", "logistic"))
    used |= _only(p, "objective", ("binary", "binary:logistic"))
    _common(kw, p, used, "n_estimators", "maxIter", 100, int)
    _common(kw, p, used, "learning_rate", "stepSize", 0.1, float)
    kw["maxDepth"] = _depth(p.get("max_depth"), depth_default)
    used |= _depth_used(p)
    if p.get("max_features") is not None:
        kw["featureSubsetStrategy"] = _feature_strategy(p["max_features"])
        used.add("max_features")
    _common(kw, p, used, "subsample", "subsamplingRate", conv=float)
    _common(kw, p, used, "min_samples_leaf", "minInstancesPerNode", conv=int)
    kw["seed"] = int(p.get("random_state", 42))
    est = GBTClassifier(**kw)
    _early_stopping(est, p, used)
    return est, used


def _xgboost(p, n_features, n_rows):
    est, used = _gbt(p, n_features, n_rows, 3)
    if p.get("colsample_bytree") is not None:
        est.setFeatureSubsetStrategy(str(float(p["colsample_bytree"])))
        used.add("colsample_bytree")
    used |= {"tree_method", "device", "eval_metric"}   # execution hints only
    return est, used


def _lightgbm(p, n_features, n_rows):
    q = dict(p)
    if q.get("max_depth") in (None, -1):
        q["max_depth"] = max(1, math.ceil(math.log2(int(q.get("num_leaves", 31)))))
    est, used = _gbt(q, n_features, n_rows, 5)
    used.add("num_leaves")
    for name in ("bagging_fraction", "subsample"):
        if q.get(name) is not None:
            est.setSubsamplingRate(float(q[name]))
            used.add(name)
    for name in ("feature_fraction", "colsample_bytree"):
        if q.get(name) is not None:
            est.setFeatureSubsetStrategy(str(float(q[name])))
            used.add(name)
    if q.get("min_child_samples") is not None:
        est.setMinInstancesPerNode(int(q["min_child_samples"]))
        used.add("min_child_samples")
    used |= {"verbose", "n_jobs"}
    return est, used


def _logistic(p, n_features, n_rows):
    kw, used = {"standardization": False}, {"random_state", "solver", "n_jobs"}
    penalty = p.get("penalty", "l2")
    used.add("penalty")
    c = float(p.get("C", 1.0))
    used.add("C")
    if penalty in (None, "none"):
        kw["regParam"] = 0.0
    else:
        kw["regParam"] = 1.0 / (c * max(1, n_rows))
        kw["elasticNetParam"] = {"l1": 1.0, "l2": 0.0}.get(penalty, float(p.get("l1_ratio", 0.5)))
        if penalty == "elasticnet":
            used.add("l1_ratio")
    _common(kw, p, used, "max_iter", "maxIter", 100, int)
    _common(kw, p, used, "tol", "tol", conv=float)
    return LogisticRegression(**kw), used


def _mlp(p, n_features, n_rows):
    kw, used = {}, {"random_state"}
    hidden = p.get("hidden_layer_sizes", (100,))
    if isinstance(hidden, int):
        hidden = (hidden,)
    used.add("hidden_layer_sizes")
    kw["layers"] = [n_features, *[int(h) for h in hidden], 2]
    _common(kw, p, used, "max_iter", "maxIter", 200, int)
    _common(kw, p, used, "tol", "tol", conv=float)
    if p.get("solver") == "sgd":
        kw["solver"] = "gd"
        _common(kw, p, used, "learning_rate_init", "stepSize", conv=float)
    used |= _only(p, "solver", ("sgd", "lbfgs", "l-bfgs"))      # adam runs as l-bfgs: reported
    kw["seed"] = int(p.get("random_state", 42))
    return MultilayerPerceptronClassifier(**kw), used


# Model type names as used in the reference's configs.
MODEL_TYPES = {
    "decision_tree": _decision_tree,
    "gbdt": _gbt,
    "logistic_reg": _logistic,
    "mlp": _mlp,
    "random_forest": _random_forest,
    "xgboost": _xgboost,
    "lightgbm": _lightgbm,
}


def create_estimator(model_type: str, params: Mapping | None = None, n_features: int = 1,
                     n_rows: int = 1):
    """(estimator, ignored_params) for a reference model type."""
    if model_type not in MODEL_TYPES:
        raise ValueError(f"Unsupported model type: {model_type}")
    p = expand_params(params or {})
    est, used = MODEL_TYPES[model_type](p, n_features, n_rows)
    est.setFeaturesCol(FEATURES).setLabelCol("label").setProbabilityCol(PROB_VEC) \
        .setRawPredictionCol("raw_prediction").setPredictionCol("prediction_d")
    ignored = {k: v for k, v in p.items() if k not in used}
    return est, ignored


@dataclass
class FittedModel:
    model: PipelineModel
    model_type: str
    features: list[str]
    ignored_params: dict = field(default_factory=dict)

    @property
    def classifier(self):
        return self.model.stages[-1]


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=FEATURES, handleInvalid="keep")


def assembled(df: DataFrame, features: Sequence[str], keep: Sequence[str] = (), label: str = "label") -> DataFrame:
    """What learners read: the feature vector, the label as a double and ``keep``, put
    together once for all passes and fits."""
    features = list(features)
    rows = df if label == "label" else df.withColumnRenamed(label, "label")
    rows = rows.withColumn("label", F.col("label").cast("double"))
    rows = rows.withColumn(ROW_HASH, F.xxhash64(*[F.col(f"`{c}`") for c in [*features, "label"]]))
    return assembler(features).transform(rows).select(FEATURES, "label", ROW_HASH, *keep)


def fit_assembled(rows: DataFrame, features: Sequence[str], model_type: str, params: Mapping | None = None,
                  n_rows: int | None = None, weight_col: str | None = None) -> FittedModel:
    """Fit on rows of ``assembled`` (kept by the caller); the model takes raw rows."""
    features = list(features)
    if model_type == "logistic_reg" and n_rows is None:
        n_rows = rows.count()
    est, ignored = create_estimator(model_type, params, len(features), n_rows or 1)
    if weight_col is not None:
        est.setWeightCol(weight_col)
    fitted = est.fit(with_validation(rows, est, params, [ROW_HASH]))
    return FittedModel(PipelineModel(stages=[assembler(features), fitted]), model_type, features, ignored)


#: Where rows wait for learners.  Each learner keeps its own form of them in memory for its passes and
#: reads these few times only: a second copy in memory would push out what every pass needs.
KEPT = StorageLevel.DISK_ONLY


def fit_model(df: DataFrame, features: Sequence[str], model_type: str, params: Mapping | None = None,
              label: str = "label", n_rows: int | None = None, weight_col: str | None = None,
              keep_rows: bool = True) -> FittedModel:
    """Fit ``assembler -> classifier`` on ``df`` (label column ``label``).  Where the
    caller has the rows cached already, ``keep_rows`` is False: no second copy."""
    rows = assembled(df, features, [weight_col] if weight_col else [], label)
    # the learners read their input several times: keep the assembled rows
    # (lost blocks are recomputed from lineage)
    if keep_rows:
        n_rows = n_rows or df.count()
        rows = even(rows, n_rows).persist(KEPT)
    try:
        return fit_assembled(rows, features, model_type, params, n_rows, weight_col)
    finally:
        if keep_rows:
            rows.unpersist()


#: Fits at a time over the same kept rows: one fills the cores that the other leaves idle between
#: its jobs, and no more than two learners' own copies of the rows are held at once.
FITS_AT_A_TIME = 2
#: Bytes that a learner keeps for a row besides 8 for every feature (boosting, the largest: its binned
#: row, its weight, four generations of its score).
BYTES_OF_A_FIT = 256


def fits_at_a_time(spark, n_rows: int, n_features: int) -> int:
    """``FITS_AT_A_TIME`` where memory holds so many learners' rows, else one: fits that push out each
    other's rows read them from disk in every pass."""
    most = storage_memory(spark) // max(1, n_rows * (BYTES_OF_A_FIT + 8 * n_features))
    return max(1, min(FITS_AT_A_TIME, most))


def fit_models(df: DataFrame, features: Sequence[str], configs: Mapping[str, Mapping], label: str = "label",
               n_rows: int | None = None, parallelism: int | None = None) -> dict[str, FittedModel]:
    """The model of every type in ``configs`` (type -> parameters) as ``fit_model`` gives it,
    the rows assembled, dealt and kept once for all of them."""
    n_rows = n_rows or df.count()
    parallelism = parallelism or fits_at_a_time(df.sparkSession, n_rows, len(features))
    rows = even(assembled(df, features, label=label), n_rows).persist(KEPT)
    try:
        rows.count()                    # kept before several fits ask for them at a time
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            fitted = pool.map(lambda c: fit_assembled(rows, features, *c, n_rows), configs.items())
            return dict(zip(configs, fitted, strict=True))
    finally:
        rows.unpersist()


def predict(fm: FittedModel | PipelineModel, df: DataFrame, keep: Sequence[str] = (),
            threshold: float | None = None) -> DataFrame:
    """Add ``prediction`` (int) and ``probability`` (class-1 probability).

    Without a threshold the model's own decision is used (argmax); with one,
    ``probability >= threshold``.
    """
    pm = fm.model if isinstance(fm, FittedModel) else fm
    out = pm.transform(df)
    prob = vector_to_array(F.col(PROB_VEC))[1]
    pred = (prob >= F.lit(threshold)) if threshold is not None else F.col("prediction_d")
    cols = list(keep) if keep else [c for c in df.columns]
    return out.select(*cols, pred.cast("int").alias("prediction"), prob.alias("probability"))


def importances(fm: FittedModel) -> list[tuple[str, float]]:
    """Impurity importances (trees) or |coefficient| (linear)."""
    m = fm.classifier
    if hasattr(m, "featureImportances"):
        vals = m.featureImportances.toArray().tolist()
    elif hasattr(m, "coefficients"):
        vals = [abs(v) for v in m.coefficients.toArray().tolist()]
    else:
        raise ValueError(f"{fm.model_type} has no feature importances")
    return list(zip(fm.features, [float(v) for v in vals]))


def importance_frame(spark, fm: FittedModel) -> DataFrame:
    rows = importances(fm)
    return spark.createDataFrame(rows, "feature string, importance double") \
        .orderBy(F.col("importance").desc(), F.col("feature"))


def selection_threshold(values: Sequence[float], threshold) -> float:
    """``'mean'``, ``'median'``, ``'k*mean'`` or a number."""
    vals = sorted(values)
    mean = sum(vals) / len(vals) if vals else 0.0
    if threshold is None or threshold == "mean":
        return mean
    if threshold == "median":
        n = len(vals)
        return (vals[(n - 1) // 2] + vals[n // 2]) / 2 if n else 0.0
    if isinstance(threshold, str) and threshold.endswith("*mean"):
        return float(threshold.split("*")[0]) * mean
    return float(threshold)


def select_features(fm: FittedModel, threshold="mean") -> list[str]:
    imp = importances(fm)
    t = selection_threshold([v for _, v in imp], threshold)
    return [f for f, v in imp if v >= t]


def fit_folds(df: DataFrame, features: Sequence[str], model_type: str, params: Mapping | None,
              folds: Sequence[int], fold_col: str = "fold", keep: Sequence[str] = (),
              parallelism: int = 4) -> DataFrame:
    """Out-of-fold predictions: for each fold, fit on the others and score it.

    The fold-tagged table should be cached by the caller; fits run from a
    small driver thread pool so their Spark jobs overlap.
    """
    def one(k):
        tr = df.filter(F.col(fold_col) != k)
        fm = fit_model(tr, features, model_type, params, keep_rows=False)
        return predict(fm, df.filter(F.col(fold_col) == k), keep=[*keep, fold_col, "label"])

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        parts = list(pool.map(one, folds))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
