"""Batch scoring: scaler statistics + fitted pipeline + threshold as ONE
Spark ML ``PipelineModel``.

The scaling formulas and the threshold are a ``SQLTransformer`` stage in
front of the fitted stages, so a single standard ``save`` / ``load`` restores
the whole scorer and scoring is one pass: scale, assemble, score, threshold.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.operators.models import PROB_VEC, FittedModel

THRESHOLD_COL = "_threshold"


def _scaling_sql(scaling: Mapping[str, Mapping], threshold: float) -> str:
    exprs = []
    for c, s in scaling.items():
        x = f"CAST(`{c}` AS DOUBLE)"
        if s["method"] == "log_standard":
            x = f"CASE WHEN {x} > -1 THEN log1p({x}) END"
        elif s["method"] == "shift_log_standard":
            x = f"CASE WHEN {x} + 1 > -1 THEN log1p({x} + 1) END"
        if s["shift"] is None:
            exprs.append(f"CAST(NULL AS DOUBLE) AS `{c}`")
        else:
            exprs.append(f"({x} - {float(s['shift'])!r}) / {float(s['scale'])!r} AS `{c}`")
    scaled = ", ".join(exprs)
    cols = f"* EXCEPT ({', '.join(f'`{c}`' for c in scaling)}), {scaled}" if scaling else "*"
    return f"SELECT {cols}, CAST({float(threshold)!r} AS DOUBLE) AS {THRESHOLD_COL} FROM __THIS__"


def as_frame(spark: SparkSession, data) -> DataFrame:
    """Accept a DataFrame, a record (dict) or a list of records."""
    if isinstance(data, DataFrame):
        return data
    if isinstance(data, Mapping):
        data = [data]
    return spark.createDataFrame([dict(r) for r in data])


@dataclass
class BatchScorer:
    model: PipelineModel

    def score(self, df, id_col: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
        """(id, keep..., prediction, probability); prediction = probability >= threshold.

        ``df`` may be a DataFrame, one record (dict) or a list of records.
        """
        df = as_frame(SparkSession.getActiveSession(), df)
        cols = ([id_col] if id_col and id_col in df.columns else []) + [c for c in keep if c != id_col]
        out = self.model.transform(df)
        prob = vector_to_array(F.col(PROB_VEC))[1]
        return out.select(*cols, (prob >= F.col(THRESHOLD_COL)).cast("int").alias("prediction"),
                          prob.alias("probability"))

    def save(self, spark: SparkSession, path: str) -> str:
        self.model.write().overwrite().save(path)
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "BatchScorer":
        return cls(PipelineModel.load(path))


def make_scorer(fm: FittedModel, scaling: Mapping | None = None, threshold: float = 0.5) -> BatchScorer:
    prep = SQLTransformer(statement=_scaling_sql(dict(scaling or {}), threshold))
    return BatchScorer(PipelineModel(stages=[prep, *fm.model.stages]))


def score_batch(spark: SparkSession, scorer_path: str, df: DataFrame, out_path: str | None = None,
                id_col: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    scored = BatchScorer.load(spark, scorer_path).score(df, id_col, keep)
    if out_path:
        scored.write.mode("overwrite").parquet(out_path)
    return scored
