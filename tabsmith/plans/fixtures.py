"""Derived fixtures over the driver tables, each with its SQL twin.

The reference's own data (student rows, model prediction files, trial logs)
is not public; these fixtures derive equivalent shapes from the given tables
so every check reads whole tables and grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.session import prepare

# The six model names in report order, and the integer
# formula parameters (multiplier a, multiplier b, planted signal s) that make
# each model's probability ((o_orderkey*a + o_custkey*b) % 61 + label*s) / 100.
MODELS = [
    ("logistic_regression", 7, 3, 5),
    ("decision_tree", 11, 5, 12),
    ("random_forest", 13, 17, 20),
    ("gbdt", 19, 23, 25),
    ("xgboost", 29, 31, 18),
    ("lightgbm", 37, 41, 22),
]
MODEL_NAMES = [m[0] for m in MODELS]
ENSEMBLE_MODELS = MODEL_NAMES[1:]   # the ensemble skips the first model
POSITIVE_PRIORITIES = ("1-URGENT", "2-HIGH")
PHASE_CUTOFF = "1999-01-01"
SEED = 42


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_labels(spark: SparkSession, sf_dir: str, extra=()) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("row_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("cutoff_ts"),
        F.when(F.col("o_orderpriority").isin(*POSITIVE_PRIORITIES), 1).otherwise(0).alias("label"),
        "o_orderkey", "o_custkey", "o_orderdate", *extra)


def predictions(spark: SparkSession, sf_dir: str, extra_cols=(), base: DataFrame | None = None,
                models=None) -> DataFrame:
    """Long table (model, row_id, user_id, cutoff_ts, label, prediction,
    probability [, extra]) from one scan of ``orders`` (a Generate, no union)."""
    base = base if base is not None else order_labels(spark, sf_dir)
    k, c, y = F.col("o_orderkey"), F.col("o_custkey"), F.col("label")
    structs = [F.struct(F.lit(name).alias("model"),
                        ((F.pmod(k * a + c * b, F.lit(61)) + y * s).cast("double") / 100.0)
                        .alias("probability"))
               for name, a, b, s in MODELS if models is None or name in models]
    keep = ["row_id", "user_id", "cutoff_ts", "label", *extra_cols]
    out = base.select(*keep, F.inline(F.array(*structs)))
    return out.withColumn("prediction", (F.col("probability") >= 0.5).cast("int")) \
        .select("model", *keep, "prediction", "probability")


def predictions_sql(extra_cols=(), pre: str = "", src: str = "base") -> str:
    """CTEs ``base`` [+ ``pre``] and ``pred`` matching :func:`predictions`."""
    pri = ", ".join(f"'{p}'" for p in POSITIVE_PRIORITIES)
    extra = "".join(f", {c}" for c in extra_cols)
    sel = []
    for name, a, b, s in MODELS:
        sel.append(
            f"SELECT '{name}' AS model, row_id, user_id, cutoff_ts, label{extra}, "
            f"CAST(((o_orderkey*{a} + o_custkey*{b}) % 61 + label*{s}) AS DOUBLE) / 100.0 AS probability FROM {src}")
    union = "\n    UNION ALL ".join(sel)
    pre = f",\n  {pre}" if pre else ""
    return f"""base AS (
    SELECT o_orderkey AS row_id, o_custkey AS user_id, o_orderdate AS cutoff_ts,
           CAST(CASE WHEN o_orderpriority IN ({pri}) THEN 1 ELSE 0 END AS INTEGER) AS label,
           o_orderkey, o_custkey, o_orderdate
    FROM orders){pre},
  pred0 AS ({union}),
  pred AS (SELECT *, CAST(CASE WHEN probability >= 0.5 THEN 1 ELSE 0 END AS INTEGER) AS prediction FROM pred0)"""
