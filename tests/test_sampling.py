"""Invariants of sampling, splits, balance and folds."""

from pyspark.sql import functions as F

from tabsmith.operators import sampling as sm
from tests.conftest import SF001


def _orders(spark):
    o = spark.read.parquet(f"{SF001}/orders.parquet")
    return o.select(F.col("o_orderkey").alias("row_id"), F.year("o_orderdate").alias("source"),
                    F.pmod("o_orderkey", F.lit(4)).alias("bucket"),
                    (F.col("o_orderpriority") == "5-LOW").cast("int").alias("label"))


def test_sample_and_complement_partition_input(spark):
    df = _orders(spark)
    f = sm.sample_flag(df, ["source", "bucket"], "row_id", 0.3)
    s = f.filter("sampled").select("row_id")
    c = f.filter("not sampled").select("row_id")
    assert s.count() + c.count() == df.count()
    assert s.intersect(c).count() == 0
    # exact per-group size round-half-even(0.3 n)
    sizes = f.groupBy("source", "bucket").agg(F.count("*").alias("n"), F.sum(F.col("sampled").cast("int")).alias("k"))
    for r in sizes.collect():
        assert r["k"] == round(0.3 * r["n"])


def test_sampling_independent_of_partitioning(spark):
    df = _orders(spark)
    a = sm.sample_fraction(df.repartition(1), ["source"], "row_id", 0.25).select("row_id")
    b = sm.sample_fraction(df.repartition(7), ["source"], "row_id", 0.25).select("row_id")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stratified_split_shares(spark):
    df = _orders(spark)
    out = sm.stratified_split(df, ["source"], "label", "row_id", 0.3)
    for r in out.groupBy("source").agg(F.count("*").alias("n"),
                                       F.sum(1 - F.col("is_train")).alias("t")).collect():
        import math
        assert r["t"] == math.ceil(0.3 * r["n"])
    per = out.groupBy("source", "label").agg(F.count("*").alias("n"), F.sum(1 - F.col("is_train")).alias("t"))
    for r in per.collect():
        assert abs(r["t"] - 0.3 * r["n"]) < 1.0 + 1e-9


def test_class_balance_and_topup(spark):
    df = _orders(spark)
    f = sm.sample_flag(df, ["source"], "row_id", 0.5)
    split = sm.stratified_split(f.filter("sampled"), ["source"], "label", "row_id", 0.3)
    bal = sm.class_balance(split, ["source"], "label", F.col("is_train") == 1)
    pool = f.filter("not sampled")
    top = sm.minority_topup(pool, bal, ["source"], "label", "row_id")
    pool_min = pool.join(bal.select("source", F.col("minority_class").alias("label"), "gap"), ["source", "label"])
    want = pool_min.groupBy("source").agg(F.count("*").alias("p"), F.first("gap").alias("gap"))
    got = {r["source"]: r["n"] for r in top.groupBy("source").agg(F.count("*").alias("n")).collect()}
    for r in want.collect():
        if r["gap"] > 0:
            assert got.get(r["source"], 0) == min(r["gap"], r["p"])


def test_kfold_balanced(spark):
    df = _orders(spark)
    sizes = [r["n"] for r in sm.kfold(df, "row_id", 5).groupBy("fold").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    st = sm.kfold(df, "row_id", 5, strata=["label"])
    for lab in (0, 1):
        s = [r["n"] for r in st.filter(F.col("label") == lab).groupBy("fold").agg(F.count("*").alias("n")).collect()]
        assert max(s) - min(s) <= 1


def test_background_sample_size(spark):
    assert sm.background_sample(_orders(spark), "row_id", 100).count() == 100
