"""Multi-model ensembles: k-way key join, row mode, votes, statistics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VALUE_COLUMNS = ("label", "prediction", "probability")


class DuplicateKeyError(ValueError):
    pass


def check_unique(df: DataFrame, keys: Sequence[str], what: str = "input") -> None:
    """Raise when a key occurs twice (one grouped pass, at most one row back)."""
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"duplicate key {dup[0].asDict()} in {what}")


def suffixed(df: DataFrame, keys: Sequence[str], model: str,
             value_cols: Sequence[str] = VALUE_COLUMNS) -> DataFrame:
    return df.select(*keys, *[F.col(c).alias(f"{c}_{model}") for c in value_cols])


def ensemble_join(frames: dict[str, DataFrame], keys: Sequence[str],
                  value_cols: Sequence[str] = VALUE_COLUMNS, strict: bool = False) -> DataFrame:
    """Inner equi-join of every model's predictions on ``keys``.

    ``strict=False`` keeps the fan-out of duplicated keys (a key present d
    times in each of k inputs yields d**k rows); ``strict=True`` raises on a
    duplicated key instead.  All joins use the same keys, so after the first
    exchange every later join reuses the partitioning.
    """
    parts = []
    for model, df in frames.items():
        if strict:
            check_unique(df, keys, model)
        parts.append(suffixed(df, keys, model, value_cols))
    return reduce(lambda a, b: a.join(b, list(keys), "inner"), parts)


def ensemble_rows(long: DataFrame, keys: Sequence[str], models: Sequence[str],
                  value_cols: Sequence[str] = VALUE_COLUMNS, strict: bool = False) -> DataFrame:
    """What ``ensemble_join`` gives, from one long table (model, keys, values): rows are
    grouped once by key, keys that lack a model go, and the rows of a key are combined
    (d of each of k models: d**k).  ``strict`` raises on a key that a model repeats.
    """
    m, entry = F.col("model"), F.struct(*[F.col(c) for c in value_cols])
    names = [f"_m{i}" for i in range(len(models))]
    out = long.where(m.isin(list(models))).groupBy(*keys).agg(
        *[F.collect_list(F.when(m == name, entry)).alias(n) for name, n in zip(models, names)])
    out = out.where(reduce(lambda a, b: a & b, [F.size(n) > 0 for n in names]))
    for name, n in zip(models, names):
        if strict:
            once = F.when(F.size(n) == 1, F.get(F.col(n), 0)).otherwise(
                F.raise_error(F.concat(F.lit(f"{name} repeats the key "), F.to_json(F.struct(*[F.col(k) for k in keys])))))
            out = out.withColumn(n, once)
        else:
            out = out.withColumn(n, F.explode(n))
    return out.select(*keys, *[F.col(f"{n}.{c}").alias(f"{c}_{name}") for name, n in zip(models, names) for c in value_cols])


def pivot_models(long: DataFrame, keys: Sequence[str], models: Sequence[str],
                 value_cols: Sequence[str] = VALUE_COLUMNS) -> DataFrame:
    """Long (model, keys, values) -> wide ``value_model`` columns in one
    aggregation (one shuffle, map-side combined).

    Keys are expected to be unique per model; rows missing a model get NULLs.
    """
    m = F.col("model")
    return long.groupBy(*keys).agg(*[F.max(F.when(m == name, F.col(c))).alias(f"{c}_{name}")
                                     for name in models for c in value_cols])


def row_mode(cols: Sequence[str]) -> Column:
    """Most frequent non-NULL value across columns; smallest value on ties.

    Closed form for a fixed column list (k^2 comparisons, all inside
    whole-stage codegen): the least ``(-count, value)`` struct wins.
    """
    vals = [F.col(c) for c in cols]
    cands = []
    for v in vals:
        count = reduce(lambda a, b: a + b, [F.coalesce((w == v).cast("int"), F.lit(0)) for w in vals])
        key = F.when(v.isNull(), F.lit(1)).otherwise(-count)     # NULL entries never win
        cands.append(F.struct(key.alias("k"), v.alias("value")))
    best = cands[0] if len(cands) == 1 else F.least(*cands)
    return F.when(best.getField("k") <= 0, best.getField("value"))


def majority_vote(cols: Sequence[str], min_votes: int = 3) -> Column:
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)) for c in cols])
    return (total >= F.lit(min_votes)).cast("int")


def soft_vote(cols: Sequence[str]) -> Column:
    """Mean of the non-NULL probabilities (NULL when all are missing)."""
    s = reduce(lambda a, b: a + b, [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols])
    n = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in cols])
    return F.when(n == 0, F.lit(None).cast("double")).otherwise(s / n)


def vote(joined: DataFrame, keys: Sequence[str], models: Sequence[str],
         min_votes: int = 3) -> DataFrame:
    """Ensemble label (mode), prediction (>= min_votes positives), probability (mean)."""
    return joined.select(
        *keys,
        row_mode([f"label_{m}" for m in models]).cast("int").alias("label"),
        majority_vote([f"prediction_{m}" for m in models], min_votes).alias("prediction"),
        soft_vote([f"probability_{m}" for m in models]).alias("probability"))


def percent(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.format_string("%.2f%%", c * 100)


def prediction_stats(df: DataFrame, group_cols: Sequence[str] = (),
                     prediction: str = "prediction", probability: str = "probability",
                     digits: int | None = 6) -> DataFrame:
    """Counts, positive rate (of all rows, also those without a prediction), mean /
    sample std of probability, confidence bands."""
    p = F.col(probability)
    out = df.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("total_predictions"),
        F.sum(F.col(prediction)).cast("long").alias("positive_count"),
        (F.sum(F.col(prediction)).cast("double") / F.count(F.lit(1))).alias("positive_rate"),
        F.avg(p).alias("average_confidence"),
        F.stddev_samp(p).alias("confidence_std"),
        (F.count_if(p > 0.9) + F.count_if(p < 0.1)).alias("high_confidence_predictions"),
        F.count_if((p >= 0.4) & (p <= 0.6)).alias("low_confidence_predictions"))
    if digits is not None:
        out = out.withColumns({c: F.round(c, digits) for c in
                               ("positive_rate", "average_confidence", "confidence_std")})
    return out


def format_stats(stats: DataFrame) -> DataFrame:
    """Report form: the three rates as ``xx.xx%`` strings."""
    return stats.withColumns({c: percent(c) for c in
                              ("positive_rate", "average_confidence", "confidence_std")})
