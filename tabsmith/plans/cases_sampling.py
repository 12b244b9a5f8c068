"""Registered checks: sampling, splitting, balancing, folds (M1-M9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.operators import sampling as sm
from tabsmith.plans import fixtures as fx
from tabsmith.session import materialize

FRAC = 0.3
TEST_SIZE = 0.3
N_BUCKETS = 8
K = 5
N_BACKGROUND = 100
GROUP = ["source"]


def keyed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as keyed rows: per-file ``source`` (order year), chunk ``bucket``,
    imbalanced label (priority 5-LOW)."""
    o = fx.table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("row_id"),
                    F.year("o_orderdate").alias("source"),
                    F.pmod(F.col("o_orderkey"), F.lit(N_BUCKETS)).alias("bucket"),
                    (F.col("o_orderpriority") == "5-LOW").cast("int").alias("label"),
                    "o_totalprice")


def _flagged(spark, sf_dir):
    return sm.sample_flag(keyed_orders(spark, sf_dir), ["source", "bucket"], "row_id", FRAC, fx.SEED)


def sample_fraction(spark, sf_dir):
    return _flagged(spark, sf_dir).filter("sampled").select("source", "bucket", "row_id", "label")


def sample_complement(spark, sf_dir):
    return _flagged(spark, sf_dir).filter(~F.col("sampled")).select("source", "bucket", "row_id", "label")


def _split(spark, sf_dir):
    s = sample_fraction(spark, sf_dir)
    return sm.stratified_split(s, GROUP, "label", "row_id", TEST_SIZE, fx.SEED)


def stratified_split(spark, sf_dir):
    return _split(spark, sf_dir).select("source", "row_id", "label", "is_train")


def class_balance(spark, sf_dir):
    return sm.class_balance(_split(spark, sf_dir), GROUP, "label", F.col("is_train") == 1)


def _topup(spark, sf_dir):
    bal = class_balance(spark, sf_dir)
    return sm.minority_topup(sample_complement(spark, sf_dir), bal, GROUP, "label", "row_id", fx.SEED)


def minority_topup(spark, sf_dir):
    return _topup(spark, sf_dir).select("source", "row_id", "label")


def train_test_union(spark, sf_dir):
    """The whole chain as the dataset build runs it: the flagged sample and
    the split are written once to the shared checkpoint folder, so the
    balance, the top-up and the union read them instead of recomputing."""
    flagged = materialize(_flagged(spark, sf_dir), "sampling-flagged")
    sampled = flagged.filter("sampled").select("source", "bucket", "row_id", "label")
    pool = flagged.filter(~F.col("sampled")).select("source", "bucket", "row_id", "label")
    split = materialize(sm.stratified_split(sampled, GROUP, "label", "row_id", TEST_SIZE, fx.SEED),
                        "sampling-split")
    bal = sm.class_balance(split, GROUP, "label", F.col("is_train") == 1)
    top = sm.minority_topup(pool, bal, GROUP, "label", "row_id", fx.SEED)
    return split.select("source", "row_id", "label", "is_train").unionByName(
        top.select("source", "row_id", "label").withColumn("is_train", F.lit(1)))


def kfold_assign(spark, sf_dir):
    return sm.kfold(keyed_orders(spark, sf_dir), "row_id", K, fx.SEED).select("row_id", "fold")


def stratified_kfold(spark, sf_dir):
    return sm.kfold(keyed_orders(spark, sf_dir), "row_id", K, fx.SEED, strata=["label"]) \
        .select("row_id", "label", "fold")


def background_sample(spark, sf_dir):
    return sm.background_sample(keyed_orders(spark, sf_dir), "row_id", N_BACKGROUND, fx.SEED) \
        .select("row_id", "o_totalprice")


QUERIES = {
    "sample_fraction": sample_fraction,
    "sample_complement": sample_complement,
    "stratified_split": stratified_split,
    "class_balance": class_balance,
    "minority_topup": minority_topup,
    "train_test_union": train_test_union,
    "kfold_assign": kfold_assign,
    "stratified_kfold": stratified_kfold,
    "background_sample": background_sample,
}

# ---------------------------------------------------------------- SQL twins


def _h(tag=None):
    salt = f"{fx.SEED}" if tag is None else f"{fx.SEED}|{tag}"
    return f"md5(CAST(row_id AS VARCHAR) || '|{salt}')"


KEYED = f"""o AS (SELECT o_orderkey AS row_id, CAST(year(o_orderdate) AS INTEGER) AS source,
      o_orderkey % {N_BUCKETS} AS bucket, CAST(o_orderpriority = '5-LOW' AS INTEGER) AS label, o_totalprice FROM orders),
  r1 AS (SELECT *, row_number() OVER (PARTITION BY source, bucket ORDER BY {_h()}, row_id) AS rk,
      count(*) OVER (PARTITION BY source, bucket) AS n FROM o),
  s AS (SELECT * FROM r1 WHERE rk <= CAST(round_even(CAST({FRAC} AS DOUBLE) * n, 0) AS BIGINT)),
  u AS (SELECT * FROM r1 WHERE rk > CAST(round_even(CAST({FRAC} AS DOUBLE) * n, 0) AS BIGINT))"""

SPLIT = f"""{KEYED},
  cc AS (SELECT source, label, count(*) AS n_c FROM s GROUP BY source, label),
  q1 AS (SELECT *, CAST(ceil(CAST({TEST_SIZE} AS DOUBLE) * sum(n_c) OVER (PARTITION BY source)) AS BIGINT) AS t,
      sum(n_c) OVER (PARTITION BY source) AS n FROM cc),
  q2 AS (SELECT *, (t * n_c) // n AS base, (t * n_c) % n AS rem FROM q1),
  q3 AS (SELECT *, t - sum(base) OVER (PARTITION BY source) AS lft,
      row_number() OVER (PARTITION BY source ORDER BY rem DESC, label) AS rr FROM q2),
  q AS (SELECT source, label, base + CASE WHEN rr <= lft THEN 1 ELSE 0 END AS quota FROM q3),
  r3 AS (SELECT *, row_number() OVER (PARTITION BY source, label ORDER BY {_h('split')}, row_id) AS rk3 FROM s),
  split AS (SELECT r3.source, r3.row_id, r3.label,
      CAST(CASE WHEN rk3 <= q.quota THEN 0 ELSE 1 END AS INTEGER) AS is_train
      FROM r3 JOIN q ON r3.source = q.source AND r3.label = q.label)"""

BAL = f"""{SPLIT},
  tc AS (SELECT source, label, count(*) AS c FROM split WHERE is_train = 1 GROUP BY source, label),
  tr AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY c, label) AS a,
      row_number() OVER (PARTITION BY source ORDER BY c DESC, label) AS b FROM tc),
  bal AS (SELECT source, max(CASE WHEN a = 1 THEN label END) AS minority_class,
      max(CASE WHEN b = 1 THEN label END) AS majority_class, min(c) AS minority_count,
      max(c) AS majority_count, max(c) - min(c) AS gap FROM tr GROUP BY source)"""

TOPUP = f"""{BAL},
  pool AS (SELECT u.*, bal.gap FROM u JOIN bal ON u.source = bal.source AND u.label = bal.minority_class
      WHERE bal.gap > 0),
  rp AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY {_h('topup')}, row_id) AS rk5 FROM pool),
  topup AS (SELECT source, row_id, label FROM rp WHERE rk5 <= gap)"""

SQL = {
    "sample_fraction": f"WITH {KEYED} SELECT source, bucket, row_id, label FROM s",
    "sample_complement": f"WITH {KEYED} SELECT source, bucket, row_id, label FROM u",
    "stratified_split": f"WITH {SPLIT} SELECT * FROM split",
    "class_balance": f"WITH {BAL} SELECT * FROM bal",
    "minority_topup": f"WITH {TOPUP} SELECT * FROM topup",
    "train_test_union": f"""WITH {TOPUP} SELECT * FROM split
        UNION ALL SELECT source, row_id, label, CAST(1 AS INTEGER) AS is_train FROM topup""",
    "kfold_assign": f"""SELECT row_id, CAST((row_number() OVER (ORDER BY {_h('fold')}, row_id) - 1) % {K} + 1 AS INTEGER)
        AS fold FROM (SELECT o_orderkey AS row_id FROM orders)""",
    "stratified_kfold": f"""SELECT row_id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY {_h('fold')}, row_id) - 1)
        % {K} + 1 AS INTEGER) AS fold FROM (SELECT o_orderkey AS row_id,
        CAST(o_orderpriority = '5-LOW' AS INTEGER) AS label FROM orders)""",
    "background_sample": f"""SELECT row_id, o_totalprice FROM (SELECT o_orderkey AS row_id, o_totalprice FROM orders)
        ORDER BY {_h('background')}, row_id LIMIT {N_BACKGROUND}""",
}
