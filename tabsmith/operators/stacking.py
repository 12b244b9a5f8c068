"""Configured classifiers, selection by importance and stacking as Spark ML stages.

* ``ConfiguredClassifier``: a model type of the registry with its parameters, an
  Estimator whose fitted model is the Spark ML model itself;
* ``ImportanceSelector``: fits an inner estimator and keeps the features whose
  importance reaches a threshold (a ``VectorSlicer`` with the figures beside it);
* ``StackingClassifier``: every base is fitted out of fold inside ``fit``, a meta
  model learns from the rows' out-of-fold probabilities, and the bases are fitted
  once more on all rows for scoring.  Bases write columns of their own, one after
  the other over the same rows, so neither fitting nor scoring joins anything.

All of them nest in a ``Pipeline``, save and load like any stage, and take
parameters by nested name (``stacking__rf__max_depth``): ``route`` turns a
candidate into a ParamMap for ``Estimator.fit`` / ``copy``.
"""

from __future__ import annotations

import functools
import itertools
import math
import os
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (HasFeaturesCol, HasLabelCol, HasOutputCol, HasPredictionCol, HasProbabilityCol,
                                     HasRawPredictionCol, HasWeightCol)
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.functions.hashing import hash_hex, hash_unit
from tabsmith.operators import models as md
from tabsmith.operators import sampling as sm
from tabsmith.session import even, learner_partitions

OUTPUTS = ("predictionCol", "probabilityCol", "rawPredictionCol")
NAME_DOC = "name of the stage in nested parameter names"


# ---------------------------------------------------------------- saving stages that hold stages

class _StageWriter(MLWriter):
    """Plain parameters as metadata; nested stages in folders of their own."""

    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        nested, facts = self.instance._nested(), self.instance._facts()
        plain = {p.name: v for p, v in self.instance._paramMap.items() if p.name not in self.instance.STAGE_PARAMS}
        extra = {"nested": {k: len(v) for k, v in nested.items()}, "facts": facts}
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession, extraMetadata=extra, paramMap=plain)
        for kind, stages in nested.items():
            for i, stage in enumerate(stages):
                stage.write().save(os.path.join(path, kind, str(i)))


class _StageReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        nested = {kind: [DefaultParamsReader.loadParamsInstance(os.path.join(path, kind, str(i)), self.sparkSession)
                         for i in range(n)] for kind, n in meta["nested"].items()}
        out = self.cls._of(nested, meta["facts"])
        out._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(out, meta)
        return out


class _Saved(MLReadable, MLWritable):
    """Saving for stages; ``STAGE_PARAMS`` are the params whose values are stages."""

    STAGE_PARAMS: tuple[str, ...] = ()

    def write(self):
        return _StageWriter(self)

    @classmethod
    def read(cls):
        return _StageReader(cls)

    def _nested(self) -> dict[str, list]:
        return {}

    def _facts(self) -> dict:
        return {}

    @classmethod
    def _of(cls, nested: dict[str, list], facts: dict):
        return cls()


def _with_columns(stage, **columns):
    """A copy of the stage with the given columns, as far as it has such params."""
    return stage.copy({stage.getParam(k): v for k, v in columns.items() if stage.hasParam(k)})


# ---------------------------------------------------------------- classifiers of the registry

class ConfiguredClassifier(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol,
                           HasRawPredictionCol, HasWeightCol, _Saved):
    """A model type of the registry; parameters that depend on the data (numbers of
    features and rows) are worked out in ``fit``, which gives the Spark ML model."""

    modelType = Param(Params._dummy(), "modelType", "model type of the registry", typeConverter=TypeConverters.toString)
    modelParams = Param(Params._dummy(), "modelParams", "its parameters by name")
    name = Param(Params._dummy(), "name", NAME_DOC, typeConverter=TypeConverters.toString)

    def __init__(self, modelType: str = "logistic_reg", modelParams: Mapping | None = None, name: str = "classifier"):
        super().__init__()
        self._setDefault(featuresCol=md.FEATURES, labelCol="label", predictionCol="prediction_d",
                         probabilityCol=md.PROB_VEC, rawPredictionCol="raw_prediction")
        self._set(modelType=modelType, modelParams=dict(modelParams or {}), name=name)

    def estimator(self, n_features: int = 1, n_rows: int = 1):
        """(Spark ML estimator, ignored parameters)."""
        est, ignored = md.create_estimator(self.getOrDefault("modelType"), self.getOrDefault("modelParams"), n_features, n_rows)
        for column in ("featuresCol", "labelCol", *OUTPUTS):
            est._set(**{column: self.getOrDefault(column)})
        if self.isSet("weightCol"):
            est.setWeightCol(self.getWeightCol())
        return est, ignored

    def _fit(self, dataset: DataFrame):
        kind = self.getOrDefault("modelType")
        n_features = len(vector_names(dataset, self.getFeaturesCol())) if kind == "mlp" else 1
        n_rows = dataset.count() if kind == "logistic_reg" else 1
        est, params = self.estimator(n_features, n_rows)[0], self.getOrDefault("modelParams")
        inputs = [vector_to_array(F.col(f"`{self.getFeaturesCol()}`")), F.col(f"`{self.getLabelCol()}`")]
        return est.fit(md.with_validation(dataset, est, params, inputs))


def vector_names(df: DataFrame, column: str) -> list[str]:
    """Names of a vector column's features, from its metadata or else its first row."""
    attrs = df.schema[column].metadata.get("ml_attr", {})
    groups = attrs.get("attrs", {})
    named = {a["idx"]: a.get("name", f"{column}_{a['idx']}") for group in groups.values() for a in group}
    if not named:
        first = df.select(column).head()
        named = dict.fromkeys(range(int(attrs.get("num_attrs", 0)) or (first[0].size if first else 0)))
    return [named[i] or f"{column}_{i}" for i in sorted(named)]


# ---------------------------------------------------------------- selection by importance

class NothingSelected(ValueError):
    """No feature reaches a selector's threshold."""


class ImportanceSelector(Estimator, HasFeaturesCol, HasLabelCol, HasOutputCol, _Saved):
    """Keeps the features whose importance (impurity importance or the absolute
    coefficient) in a fitted inner estimator is at least the threshold: ``mean``,
    ``median``, ``k*mean`` or a number."""

    STAGE_PARAMS = ("estimator",)
    estimator = Param(Params._dummy(), "estimator", "the estimator whose importances count")
    threshold = Param(Params._dummy(), "threshold", "mean, median, k*mean or a number")
    name = Param(Params._dummy(), "name", NAME_DOC, typeConverter=TypeConverters.toString)

    def __init__(self, estimator=None, threshold="mean", featuresCol: str = md.FEATURES, outputCol: str = "selected",
                 labelCol: str = "label", name: str = "feature_selection"):
        super().__init__()
        self._set(estimator=estimator or ConfiguredClassifier("decision_tree"), threshold=threshold,
                  featuresCol=featuresCol, outputCol=outputCol, labelCol=labelCol, name=name)

    def copy(self, extra=None):
        out = super().copy(extra)
        return out._set(estimator=out.getOrDefault("estimator").copy(extra))

    def _nested(self):
        return {"estimator": [self.getOrDefault("estimator")]}

    @classmethod
    def _of(cls, nested, facts):
        return cls(nested["estimator"][0])

    def _fit(self, dataset: DataFrame) -> ImportanceSelectorModel:
        inner = _with_columns(self.getOrDefault("estimator"), featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol())
        model = inner.fit(dataset)
        values = model.featureImportances if hasattr(model, "featureImportances") else model.coefficients
        values = [abs(float(v)) for v in values.toArray()]
        least = md.selection_threshold(values, self.getOrDefault("threshold"))
        kept = [i for i, v in enumerate(values) if v >= least]
        if not kept:
            raise NothingSelected(f"no feature reaches the threshold {least}; the largest importance is {max(values, default=0)}")
        names = vector_names(dataset, self.getFeaturesCol())
        out = ImportanceSelectorModel(kept, values, names if len(names) == len(values) else list(map(str, range(len(values)))))
        return out._set(featuresCol=self.getFeaturesCol(), outputCol=self.getOutputCol())


class ImportanceSelectorModel(Model, HasFeaturesCol, HasOutputCol, _Saved):
    """The kept features as a vector column; figures of all features beside it."""

    def __init__(self, indices: Sequence[int] = (), importances: Sequence[float] = (), names: Sequence[str] = ()):
        super().__init__()
        self.indices, self.importances, self.names = list(indices), list(importances), list(names)

    @property
    def selected(self) -> list[str]:
        return [self.names[i] for i in self.indices]

    def _facts(self):
        return {"indices": self.indices, "importances": self.importances, "names": self.names}

    @classmethod
    def _of(cls, nested, facts):
        return cls(**facts)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return VectorSlicer(inputCol=self.getFeaturesCol(), outputCol=self.getOutputCol(), indices=self.indices).transform(dataset)


# ---------------------------------------------------------------- stacking

class _StackColumns(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol):
    def _columns(self, i: int) -> dict[str, str]:
        """Columns that base ``i`` writes; none of the input can have their names."""
        return {c: f"{self.uid}_{i}_{c}" for c in OUTPUTS}

    def _add_base(self, df: DataFrame, model, i: int) -> DataFrame:
        """The rows with the base's class-1 probability, and nothing else of it."""
        out = model.transform(df)
        kept = [F.col(f"`{c}`") for c in df.columns]
        return out.select(*kept, vector_to_array(F.col(f"`{self._columns(i)['probabilityCol']}`"))[1].alias(self._meta(i)))

    def _meta(self, i: int) -> str:
        return f"{self.uid}_p{i}"

    def _assembled(self, df: DataFrame, n: int) -> DataFrame:
        return VectorAssembler(inputCols=[self._meta(i) for i in range(n)], outputCol=f"{self.uid}_meta").transform(df)


class StackingClassifier(Estimator, _StackColumns, _Saved):
    """Base classifiers under a meta classifier.

    Folds are the values of ``foldCol`` if set; else ``numFolds`` folds by the hash
    order of ``idCol``, stratified by label.  A base must be an Estimator with the
    usual classifier columns whose model writes a probability vector."""

    STAGE_PARAMS = ("bases", "finalEstimator")
    bases = Param(Params._dummy(), "bases", "base estimators, in order")
    baseNames = Param(Params._dummy(), "baseNames", "their names", typeConverter=TypeConverters.toListString)
    finalEstimator = Param(Params._dummy(), "finalEstimator", "the meta estimator")
    numFolds = Param(Params._dummy(), "numFolds", "folds for the out-of-fold scores", typeConverter=TypeConverters.toInt)
    idCol = Param(Params._dummy(), "idCol", "key by whose hash rows are dealt to folds", typeConverter=TypeConverters.toString)
    foldCol = Param(Params._dummy(), "foldCol", "column that holds the fold, if rows bring theirs", typeConverter=TypeConverters.toString)
    seed = Param(Params._dummy(), "seed", "seed of the fold order", typeConverter=TypeConverters.toInt)
    parallelism = Param(Params._dummy(), "parallelism", "fits at a time", typeConverter=TypeConverters.toInt)
    name = Param(Params._dummy(), "name", NAME_DOC, typeConverter=TypeConverters.toString)

    def __init__(self, bases: Sequence[tuple[str, Estimator]] = (), finalEstimator: Estimator | None = None, numFolds: int = 5,
                 idCol: str = "row_id", foldCol: str = "", featuresCol: str = md.FEATURES, labelCol: str = "label",
                 seed: int = 42, parallelism: int = 4, name: str = "stacking"):
        super().__init__()
        self._setDefault(predictionCol="prediction_d", probabilityCol=md.PROB_VEC, rawPredictionCol="raw_prediction")
        self._set(bases=[e for _, e in bases], baseNames=[n for n, _ in bases],
                  finalEstimator=finalEstimator or ConfiguredClassifier("logistic_reg"), numFolds=numFolds, idCol=idCol,
                  foldCol=foldCol, featuresCol=featuresCol, labelCol=labelCol, seed=seed, parallelism=parallelism, name=name)

    def copy(self, extra=None):
        out = super().copy(extra)
        return out._set(bases=[b.copy(extra) for b in out.getOrDefault("bases")],
                        finalEstimator=out.getOrDefault("finalEstimator").copy(extra))

    def _nested(self):
        return {"bases": self.getOrDefault("bases"), "finalEstimator": [self.getOrDefault("finalEstimator")]}

    @classmethod
    def _of(cls, nested, facts):
        return cls([("", b) for b in nested["bases"]], nested["finalEstimator"][0])

    def _folded(self, dataset: DataFrame) -> tuple[DataFrame, str]:
        fold = self.getOrDefault("foldCol")
        if fold:
            return dataset.select(F.col(f"`{fold}`").cast("int").alias("fold"), self.getFeaturesCol(), self.getLabelCol()), "fold"
        keyed = dataset.select(F.col(f"`{self.getOrDefault('idCol')}`").alias("id"), self.getFeaturesCol(), self.getLabelCol())
        strata = [self.getLabelCol()]
        return sm.kfold(keyed, "id", self.getOrDefault("numFolds"), self.getOrDefault("seed"), tag="stack", strata=strata), "fold"

    def _base(self, i: int) -> Estimator:
        return _with_columns(self.getOrDefault("bases")[i], featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol(),
                             **self._columns(i))

    def out_of_fold(self, dataset: DataFrame, folded: DataFrame | None = None) -> DataFrame:
        """The rows (fold, label, ...) with each base's probability from models that
        have not seen the row's fold, in columns ``<uid>_p<i>``."""
        with ThreadPoolExecutor(max_workers=max(1, self.getOrDefault("parallelism"))) as pool:
            return self._fold_scores(dataset, folded, pool)[0]

    def _fold_scores(self, dataset: DataFrame, folded: DataFrame | None, pool: ThreadPoolExecutor, whole: bool = False):
        """(``out_of_fold``'s rows, futures of the bases fitted on all rows if ``whole``):
        those fits wait behind the folds' and go on while the meta model learns."""
        folded, fold = (folded, "fold") if folded is not None else self._folded(dataset)
        folds = sorted(r[0] for r in folded.select(fold).distinct().collect())          # one row for each fold
        if len(folds) < 2:
            raise ValueError("out-of-fold scores need two folds with rows at least")
        jobs = [(k, i) for k in folds for i in range(len(self.getOrDefault("bases")))]
        parts = pool.map(lambda j: self._base(j[1]).fit(folded.where(F.col(fold) != j[0])), jobs)
        rest = [pool.submit(self._base(i).fit, folded) for i in range(len(self.getOrDefault("bases")))] if whole else []
        fitted = dict(zip(jobs, parts, strict=True))
        out = None
        for k in folds:
            part = folded.where(F.col(fold) == k)
            for i in range(len(self.getOrDefault("bases"))):
                part = self._add_base(part, fitted[k, i], i)
            out = part if out is None else out.unionByName(part)
        return out, rest

    def _fit(self, dataset: DataFrame) -> StackingModel:
        n = len(self.getOrDefault("bases"))
        if not n:
            raise ValueError("no base estimators")
        # Every base reads the rows once a fold: kept, and recomputed from lineage where lost.
        n_rows = dataset.count()
        folded = even(self._folded(dataset)[0], n_rows).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            with ThreadPoolExecutor(max_workers=max(1, self.getOrDefault("parallelism"))) as pool:
                scored, whole = self._fold_scores(dataset, folded, pool, whole=True)
                scored = self._assembled(scored, n)
                # one part of every fold to a task, as many tasks as the rows have elsewhere
                scored = scored.select(f"{self.uid}_meta", self.getLabelCol()).coalesce(learner_partitions(dataset.sparkSession, n_rows)) \
                    .persist(StorageLevel.MEMORY_AND_DISK)
                try:
                    meta = _with_columns(self.getOrDefault("finalEstimator"), featuresCol=f"{self.uid}_meta", labelCol=self.getLabelCol(),
                                         **{c: self.getOrDefault(c) for c in OUTPUTS}).fit(scored)
                finally:
                    scored.unpersist()
                models = [f.result() for f in whole]
        finally:
            folded.unpersist()
        out = StackingModel(models, meta, self.getOrDefault("baseNames"))
        out._resetUid(self.uid)
        return out._set(featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol(), **{c: self.getOrDefault(c) for c in OUTPUTS})


class StackingModel(Model, _StackColumns, _Saved):
    """Fitted bases and meta model; adds the meta model's columns to the rows."""

    def __init__(self, bases: Sequence[Model] = (), meta: Model | None = None, names: Sequence[str] = ()):
        super().__init__()
        self.bases, self.meta, self.names = list(bases), meta, list(names)

    def _nested(self):
        return {"bases": self.bases, "meta": [self.meta]}

    def _facts(self):
        return {"names": self.names}

    @classmethod
    def _of(cls, nested, facts):
        return cls(nested["bases"], nested["meta"][0], facts["names"])

    def base_scores(self, dataset: DataFrame) -> DataFrame:
        for i, model in enumerate(self.bases):
            dataset = self._add_base(dataset, model, i)
        return dataset

    def _transform(self, dataset: DataFrame) -> DataFrame:
        n = len(self.bases)
        out = self.meta.transform(self._assembled(self.base_scores(dataset), n))
        return out.drop(f"{self.uid}_meta", *[self._meta(i) for i in range(n)])


# ---------------------------------------------------------------- bagging

#: Cumulative Poisson(1) probabilities P(K <= i), until what is left is below the
#: resolution of a double in [0, 1): no draw is cut off.
POISSON1 = list(itertools.accumulate(math.exp(-1.0) / math.factorial(i) for i in range(20)))


def bootstrap_weight(key: str, salt: str):
    """How often a row is drawn: Poisson(1) by the inverse of a hash of its key, so
    sampling with replacement makes no copies."""
    u, w = hash_unit(hash_hex([key], salt)), F.lit(len(POISSON1))
    for i in reversed(range(len(POISSON1))):
        w = F.when(u < F.lit(POISSON1[i]), F.lit(i)).otherwise(w)
    return w.cast("double")


class BaggingClassifier(Estimator, _StackColumns, _Saved):
    """``numModels`` copies of a base (one that takes row weights), each fitted on
    bootstrap weights of the rows; their probabilities are averaged."""

    STAGE_PARAMS = ("estimator",)
    estimator = Param(Params._dummy(), "estimator", "the estimator that is fitted on each draw")
    numModels = Param(Params._dummy(), "numModels", "draws", typeConverter=TypeConverters.toInt)
    idCol = Param(Params._dummy(), "idCol", "key by whose hash rows are drawn", typeConverter=TypeConverters.toString)
    seed = Param(Params._dummy(), "seed", "seed of the draws", typeConverter=TypeConverters.toInt)
    name = Param(Params._dummy(), "name", NAME_DOC, typeConverter=TypeConverters.toString)

    def __init__(self, estimator: Estimator | None = None, numModels: int = 10, idCol: str = "row_id", featuresCol: str = md.FEATURES,
                 labelCol: str = "label", seed: int = 42, name: str = "bagging"):
        super().__init__()
        self._setDefault(predictionCol="prediction_d", probabilityCol=md.PROB_VEC, rawPredictionCol="raw_prediction")
        self._set(estimator=estimator or ConfiguredClassifier("decision_tree"), numModels=numModels, idCol=idCol,
                  featuresCol=featuresCol, labelCol=labelCol, seed=seed, name=name)

    def copy(self, extra=None):
        out = super().copy(extra)
        return out._set(estimator=out.getOrDefault("estimator").copy(extra))

    def _nested(self):
        return {"estimator": [self.getOrDefault("estimator")]}

    @classmethod
    def _of(cls, nested, facts):
        return cls(nested["estimator"][0])

    def _fit(self, dataset: DataFrame) -> BaggingModel:
        weight = f"{self.uid}_weight"
        kept = dataset.select(F.col(f"`{self.getOrDefault('idCol')}`").alias(f"{self.uid}_id"), self.getFeaturesCol(), self.getLabelCol())
        rows, models = even(kept, dataset.count()).persist(StorageLevel.MEMORY_AND_DISK), []
        try:
            for i in range(self.getOrDefault("numModels")):
                drawn = rows.withColumn(weight, bootstrap_weight(f"{self.uid}_id", f"{self.getOrDefault('seed')}|bag{i}"))
                base = _with_columns(self.getOrDefault("estimator"), featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol(),
                                     weightCol=weight, **self._columns(i))
                models.append(base.fit(drawn))
        finally:
            rows.unpersist()
        out = BaggingModel(models)
        out._resetUid(self.uid)
        return out._set(featuresCol=self.getFeaturesCol(), **{c: self.getOrDefault(c) for c in OUTPUTS})


class BaggingModel(Model, _StackColumns, _Saved):
    """Fitted draws; adds the mean probability, and the decision by it."""

    def __init__(self, bases: Sequence[Model] = ()):
        super().__init__()
        self.bases = list(bases)

    def _nested(self):
        return {"bases": self.bases}

    @classmethod
    def _of(cls, nested, facts):
        return cls(nested["bases"])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = dataset
        for i, model in enumerate(self.bases):
            out = self._add_base(out, model, i)
        p = functools.reduce(lambda a, b: a + b, [F.col(self._meta(i)) for i in range(len(self.bases))]) / len(self.bases)
        vector = array_to_vector(F.array(1 - p, p))
        return out.withColumns({self.getRawPredictionCol(): vector, self.getProbabilityCol(): vector,
                                self.getPredictionCol(): (p >= 0.5).cast("double")}).drop(*[self._meta(i) for i in range(len(self.bases))])


# ---------------------------------------------------------------- configuration and nested names

def pipeline_from_config(model: Mapping, features: Sequence[str], n_folds: int = 5, id_col: str = "row_id") -> Pipeline:
    """The pipeline that an experiment's ``model`` section describes: assembler,
    then one classifier, or (``is_stacking``) selector and stack."""
    stages: list = [md.assembler(features)]
    if not model.get("is_stacking"):
        return Pipeline(stages=[*stages, ConfiguredClassifier(model["type"], model.get("params"))])
    column, chosen = md.FEATURES, model.get("feature_selector") or {}
    if chosen.get("enabled"):
        column = "selected"
        stages.append(ImportanceSelector(ConfiguredClassifier(chosen["type"], chosen.get("params")),
                                         chosen.get("threshold", "mean"), outputCol=column))
    bases = [(b["name"], ConfiguredClassifier(b["type"], b.get("params"), b["name"])) for b in model["base_models"]]
    meta = ConfiguredClassifier(model["meta_learner"]["type"], model["meta_learner"].get("params"), "final_estimator")
    stages.append(StackingClassifier(bases, meta, n_folds, id_col, featuresCol=column))
    return Pipeline(stages=stages)


def prepared(model: Estimator, rows: DataFrame, keep: Sequence[str] = ()) -> tuple[list[Transformer], Estimator, DataFrame]:
    """(transformers that a pipeline begins with, the rest of it, the rows as they leave
    the transformers): what no fit changes is worked out once for all fits.  Columns that
    were only put into a vector go, where the stages that follow are known."""
    heads, stages = [], list(model.getStages()) if isinstance(model, Pipeline) else []
    while len(stages) > 1 and isinstance(stages[0], Transformer):
        heads.append(stages.pop(0))
        rows = heads[-1].transform(rows)
    if not heads:
        return [], model, rows
    if all(isinstance(s, (ConfiguredClassifier, ImportanceSelector, StackingClassifier)) for s in stages):
        named = {s.getOrDefault(c) for s in stages for c in ("idCol", "foldCol", "labelCol", "featuresCol", "weightCol")
                 if s.hasParam(c) and s.isDefined(s.getParam(c))}
        packed = {c for h in heads if isinstance(h, VectorAssembler) for c in h.getInputCols()}
        rows = rows.drop(*(packed - named - set(keep)))
    return heads, Pipeline(stages=stages), rows


def fit_kept(model: Estimator, rows: DataFrame, candidate: Mapping | None = None) -> Model:
    """``model`` fitted on rows that are dealt evenly and kept, assembled, for all its stages."""
    heads, rest, ready = prepared(model, even(rows, rows.count()))
    ready = ready.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fitted = rest.fit(ready, route(rest, candidate or {}))
    finally:
        ready.unpersist()
    return PipelineModel(stages=[*heads, *fitted.stages]) if heads else fitted


def nested_space(section: Mapping) -> dict:
    """The candidate lists of a search section by nested name."""
    def lists(prefix):
        return section.get(f"{prefix}_param_grid") or section.get(f"{prefix}_param_distributions") or {}

    if not any(k.startswith(("base_models_", "meta_learner_")) for k in section):
        return dict(section.get("param_grid") or section.get("param_distributions") or {})
    out = {f"feature_selection__estimator__{p}": v for p, v in lists("feature_selector").items()}
    if section.get("feature_selector_threshold") is not None:
        out["feature_selection__threshold"] = section["feature_selector_threshold"]
    out |= {f"stacking__{base}__{p}": v for base, params in lists("base_models").items() for p, v in params.items()}
    return out | {f"stacking__final_estimator__{p}": v for p, v in lists("meta_learner").items()}


def _inner(stage) -> dict[str, Params]:
    """The stages inside a stage by name."""
    if isinstance(stage, Pipeline):
        return {s.getOrDefault("name"): s for s in stage.getStages() if s.hasParam("name")}
    if isinstance(stage, StackingClassifier):
        return {**dict(zip(stage.getOrDefault("baseNames"), stage.getOrDefault("bases"), strict=True)),
                "final_estimator": stage.getOrDefault("finalEstimator")}
    if isinstance(stage, ImportanceSelector):
        return {"estimator": stage.getOrDefault("estimator")}
    return {}


def route(estimator, candidate: Mapping) -> dict[Param, object]:
    """A ParamMap for ``estimator`` from a candidate by nested name.  A name
    without a stage goes to the only configured classifier of a pipeline, and
    parameters of one configured classifier are merged into its own."""
    out: dict[Param, object] = {}
    for key, value in candidate.items():
        *path, leaf = key.split("__")
        stage = estimator
        if not path and isinstance(stage, Pipeline):
            named = list(_inner(stage))
            if len(named) != 1:
                raise ValueError(f"{key}: name one of the stages {named}")
            path = named
        for step in path:
            inner = _inner(stage)
            if step not in inner:
                raise ValueError(f"{key}: no stage {step}; there are {sorted(inner)}")
            stage = inner[step]
        if isinstance(stage, ConfiguredClassifier):
            param = stage.getParam("modelParams")
            out[param] = {**out.get(param, stage.getOrDefault(param)), leaf: value}
        elif stage.hasParam(leaf):
            out[stage.getParam(leaf)] = value
        else:
            raise ValueError(f"{key}: {type(stage).__name__} has no parameter {leaf}")
    return out
