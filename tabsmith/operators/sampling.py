"""Deterministic sampling, stratified splits, class balance and folds.

A row's place in a "shuffled" order is md5(key|salt), so every operator here
is reproducible, independent of partitioning, and checkable in SQL.  Ranks
come from :func:`tabsmith.operators.rank.hash_rank`, which spreads a hot group
over many tasks.  Quotas are computed on small per-class count tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.functions.hashing import hash_hex
from tabsmith.operators.rank import hash_rank
from tabsmith.session import broadcast_small, materialize


def _salt(seed, tag: str | None) -> str:
    return f"{seed}" if tag is None else f"{seed}|{tag}"


def sample_flag(df: DataFrame, group_cols: Sequence[str], key: str, frac: float,
                seed=42, tag: str | None = None, flag: str = "sampled") -> DataFrame:
    """Mark the ``round(frac * n)`` rows with the smallest hash in each group.

    ``round`` is half-to-even like Python's.  The flag column splits the input
    into the sample and its complement in one pass.
    """
    r = hash_rank(df, group_cols, key, _salt(seed, tag), rank_col="_rk", size_col="_n")
    k = F.bround(F.lit(float(frac)) * F.col("_n"), 0).cast("long")
    return r.withColumn(flag, F.col("_rk") <= k).drop("_rk", "_n")


def sample_fraction(df, group_cols, key, frac, seed=42, tag=None) -> DataFrame:
    return sample_flag(df, group_cols, key, frac, seed, tag).filter("sampled").drop("sampled")


def sample_complement(df, group_cols, key, frac, seed=42, tag=None) -> DataFrame:
    return sample_flag(df, group_cols, key, frac, seed, tag).filter(~F.col("sampled")).drop("sampled")


def test_quotas(class_counts: DataFrame, group_cols: Sequence[str], label: str,
                test_size: float, count_col: str = "n_c") -> DataFrame:
    """Per-class test quotas: n_test = ceil(test_size * n) per group, shared by
    largest remainder (integer arithmetic; ties go to the smaller class)."""
    g = list(group_cols)
    wg = Window.partitionBy(*g) if g else Window.partitionBy()
    q = class_counts.withColumn("_n", F.sum(count_col).over(wg))
    q = q.withColumn("_t", F.ceil(F.lit(float(test_size)) * F.col("_n")).cast("long"))
    q = q.withColumn("_base", F.floor(F.col("_t") * F.col(count_col) / F.col("_n")).cast("long")) \
        .withColumn("_rem", F.pmod(F.col("_t") * F.col(count_col), F.col("_n")))
    q = q.withColumn("_left", F.col("_t") - F.sum("_base").over(wg)) \
        .withColumn("_rr", F.row_number().over(wg.orderBy(F.col("_rem").desc(), F.col(label))))
    return q.select(*g, label, (F.col("_base") + (F.col("_rr") <= F.col("_left")).cast("long"))
                    .alias("quota"))


def stratified_split(df: DataFrame, group_cols: Sequence[str], label: str, key: str,
                     test_size: float = 0.3, seed=42, tag: str | None = "split",
                     flag: str = "is_train") -> DataFrame:
    """Stratified train/test split inside each group (``is_train`` 1/0).

    One large shuffle: the rank's per-cell offsets table (one row per group,
    class and cell) already holds each class size, so the quotas are computed
    there and reach the rows with the offsets.  The quota table has one row
    per (group, class); Spark broadcasts it where its measured size allows.
    """
    g = list(group_cols)

    def with_quotas(offsets: DataFrame) -> DataFrame:
        counts = offsets.groupBy(*g, label).agg(F.max("total_one").alias("n_c"))
        quotas = test_quotas(counts, g, label, test_size)
        return offsets.join(quotas, g + [label], "inner")

    r = hash_rank(df, g + [label], key, _salt(seed, tag), rank_col="_rk", size_col="_size",
                  enrich=with_quotas)
    return r.withColumn(flag, F.when(F.col("_rk") <= F.col("quota"), 0).otherwise(1)) \
        .drop("_rk", "quota", "_size")


def class_balance(df: DataFrame, group_cols: Sequence[str], label: str,
                  train_filter: Column | None = None) -> DataFrame:
    """Minority / majority class per group and their count gap (0 on ties or
    with a single class).  Ties pick the smaller class value."""
    src = df if train_filter is None else df.filter(train_filter)
    c = src.groupBy(*group_cols, label).agg(F.count(F.lit(1)).alias("_c"))
    return c.groupBy(*group_cols).agg(
        F.min_by(label, F.struct("_c", label)).alias("minority_class"),
        F.max_by(label, F.struct("_c", -F.col(label))).alias("majority_class"),
        F.min("_c").alias("minority_count"),
        F.max("_c").alias("majority_count"),
    ).withColumn("gap", F.col("majority_count") - F.col("minority_count"))


def minority_topup(pool: DataFrame, balance: DataFrame, group_cols: Sequence[str], label: str,
                   key: str, seed=42, tag: str | None = "topup") -> DataFrame:
    """Rows of the minority class drawn from ``pool``: min(gap, pool size) per group.

    ``balance`` has one row per group; it is broadcast if it is small, so that no
    group is a key of a shuffle.
    """
    g = list(group_cols)
    b = balance.filter(F.col("gap") > 0).select(*g, F.col("minority_class").alias(label), "gap")
    cand = pool.join(broadcast_small(materialize(b, "balance")), g + [label], "inner")
    r = hash_rank(cand, g, key, _salt(seed, tag), rank_col="_rk", size_col=None)
    return r.filter(F.col("_rk") <= F.col("gap")).drop("_rk", "gap")


def kfold(df: DataFrame, key: str, k: int = 5, seed=42, tag: str | None = "fold",
          strata: Sequence[str] = (), fold_col: str = "fold") -> DataFrame:
    """Fold 1..k by hash rank (sizes differ by at most one; within each
    stratum when ``strata`` is given)."""
    r = hash_rank(df, list(strata), key, _salt(seed, tag), rank_col="_rk", size_col=None)
    return r.withColumn(fold_col, (F.pmod(F.col("_rk") - 1, F.lit(k)) + 1).cast("int")).drop("_rk")


def nested_order(df: DataFrame, label: str, key: str, seed=42, tag: str | None = "nested",
                 rank_col: str = "sample_rank") -> DataFrame:
    """A position 1..n for every row such that each prefix holds every class of
    ``label`` by its share, to less than one row: class ranks by hash, interleaved.

    Row r of a class of n rows stands at (2r - 1) / 2n; its position is the number
    of rows of all classes that stand before it, in closed form from the class
    sizes (one row for each class).  Ties go to the smaller class.
    """
    ranked = hash_rank(df, [label], key, _salt(seed, tag), rank_col="_rk", size_col="_n")
    sizes = sorted(((r[0], r[1]) for r in df.groupBy(label).count().collect()), key=lambda c: (c[0] is not None, c[0]))
    position = F.lit(0).cast("long")
    for i, (value, size) in enumerate(sizes):
        # rows r' of this class with (2r' - 1) / 2size below, or up to, (2 _rk - 1) / 2 _n
        upto = F.expr(f"least({size}L, (cast(2 * _rk - 1 as decimal(19, 0)) * cast({size}L as decimal(19, 0)) + _n) div (2 * _n))")
        below = F.expr(f"least({size}L, (cast(2 * _rk - 1 as decimal(19, 0)) * cast({size}L as decimal(19, 0)) + _n - 1) div (2 * _n))")
        before = F.lit(False)
        for other, _ in sizes[:i]:
            before = before | F.col(label).eqNullSafe(F.lit(other))
        own = F.col(label).eqNullSafe(F.lit(value))
        position = position + F.when(own, F.col("_rk")).when(before, below).otherwise(upto)
    return ranked.withColumn(rank_col, position.cast("long")).drop("_rk", "_n")


def background_sample(df: DataFrame, key: str, n: int = 100, seed=42,
                      tag: str | None = "background") -> DataFrame:
    """The ``n`` rows with the smallest hash (a top-n: TakeOrdered, no full sort)."""
    h = hash_hex([key], _salt(seed, tag))
    return df.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")
