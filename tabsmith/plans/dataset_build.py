"""Config-driven dataset build: the whole raw -> model-ready flow as one lazy plan.

scan -> per-(source, chunk) sample and complement -> label -> stratified
split per source -> minority top-up from the complement -> union with
``is_train`` -> rename -> derived features -> indicators (before fills) ->
fills -> clamps -> unusual values -> flag repair -> code maps + one-hot ->
drop -> float cast of features (keys keep their type).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.functions.hashing import hash_hex
from tabsmith.functions.naming import rename_by_map
from tabsmith.operators import features as ft
from tabsmith.operators import sampling as sm
from tabsmith.functions.nulls import nulls_for_nan
from tabsmith.session import materialize


@dataclass
class BuildConfig:
    key: str = "row_id"
    source_col: str = "source"
    n_buckets: int = 1                      # stands for the reader's chunks
    sample_frac: float = 1.0
    random_state: int = 42
    test_size: float = 0.3
    target_column: str = "label"
    label_columns: list = field(default_factory=list)
    rename: dict = field(default_factory=dict)
    new_features: list = field(default_factory=list)
    null_indicators: dict = field(default_factory=dict)
    fill_values: dict = field(default_factory=dict)
    fill_fit_on: str = "all"                # "all" (reference behaviour) or "train"
    clamp_positive: list = field(default_factory=list)
    range_to_zero: dict = field(default_factory=dict)      # col -> (lo, hi)
    whitelist_or_zero: dict = field(default_factory=dict)  # col -> allowed values
    unusual: dict = field(default_factory=dict)
    flag_repair: list = field(default_factory=list)
    mapping_dict: dict = field(default_factory=dict)
    categories_dict: dict = field(default_factory=dict)
    columns_to_drop: list = field(default_factory=list)
    keys: list = field(default_factory=list)
    materialize: bool = True                # write intermediate stages to the checkpoint folder


def sample_and_split(df: DataFrame, cfg: BuildConfig) -> DataFrame:
    """Rows of the training set (with top-up) and test set, tagged ``is_train``."""
    y, src, key = cfg.target_column, cfg.source_col, cfg.key
    # the reader's chunk stands as a hash bucket of the key (md5 based, so the
    # same bucket is computable in any SQL engine)
    x = df.withColumn("_bucket", F.pmod(F.conv(F.substring(hash_hex([key], "bucket"), 1, 8), 16, 10).cast("long"),
                                        F.lit(max(1, cfg.n_buckets))))
    x = x.withColumn(y, ft.any_zero_label(cfg.label_columns))
    flagged = sm.sample_flag(x, [src, "_bucket"], key, cfg.sample_frac, cfg.random_state)
    if cfg.materialize:
        flagged = materialize(flagged, "build-sampled")
    sampled = flagged.filter("sampled").drop("sampled", "_bucket")
    pool = flagged.filter(~F.col("sampled")).drop("sampled", "_bucket")
    split = sm.stratified_split(sampled, [src], y, key, cfg.test_size, cfg.random_state)
    if cfg.materialize:
        split = materialize(split, "build-split")
    bal = sm.class_balance(split, [src], y, F.col("is_train") == 1)
    top = sm.minority_topup(pool, bal, [src], y, key, cfg.random_state).withColumn("is_train", F.lit(1))
    return split.unionByName(top)


def transform(df: DataFrame, cfg: BuildConfig) -> DataFrame:
    if cfg.rename:
        df = rename_by_map(df, cfg.rename)
    df = ft.derive(df, cfg.new_features)
    df = ft.indicators(df, cfg.null_indicators)
    fit = F.col("is_train") == 1 if cfg.fill_fit_on == "train" else None
    df = ft.fill_missing(df, cfg.fill_values, fit_filter=fit)
    new = {}
    for c in cfg.clamp_positive:
        new[c] = ft.clamp_positive_to_one(c)
    for c, (lo, hi) in cfg.range_to_zero.items():
        new[c] = ft.range_to_zero(c, lo, hi)
    for c, allowed in cfg.whitelist_or_zero.items():
        new[c] = ft.whitelist_or_zero(c, allowed)
    if new:
        df = df.withColumns(new)
    df = ft.unusual_values(df, cfg.unusual)
    df = ft.repair_flags(df, cfg.flag_repair)
    df = ft.one_hot(df, cfg.categories_dict, cfg.mapping_dict)
    df = df.drop(*cfg.columns_to_drop)
    keep = set(cfg.keys) | {cfg.key, cfg.source_col}
    return ft.cast_features(df, keys=[c for c in df.columns if c in keep])


def build(df: DataFrame, cfg: BuildConfig) -> DataFrame:
    rows = sample_and_split(nulls_for_nan(df), cfg)
    if cfg.materialize and cfg.fill_values:
        rows = materialize(rows, "build-rows")   # the fill statistics and the output read it once
    return transform(rows, cfg)
