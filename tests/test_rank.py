"""The distributed rank / running sum equals a plain window, for any
partitioning and cell count, including a group holding most rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabsmith.functions.hashing import hash_hex
from tabsmith.operators.rank import hash_rank, running_sums


def _frame(spark, n=3000):
    # group 0 holds two thirds of all rows (a hot key)
    return spark.range(n).select(F.col("id").alias("k"),
                                 F.when(F.col("id") % 3 == 0, F.col("id") % 5 + 1).otherwise(0).alias("g"),
                                 (F.col("id") % 7).alias("v"))


@pytest.mark.parametrize("parts,cells", [(1, 1), (3, 4), (8, 64)])
def test_hash_rank_equals_row_number(spark, parts, cells):
    df = _frame(spark).repartition(parts)
    got = hash_rank(df, ["g"], "k", 42, cells=cells).select("k", "rank", "group_size")
    w = Window.partitionBy("g").orderBy(hash_hex("k", 42), "k")
    want = df.select("k", F.row_number().over(w).alias("rank"),
                     F.count(F.lit(1)).over(Window.partitionBy("g")).alias("group_size"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_running_sums_exclusive_with_null_group(spark):
    df = spark.createDataFrame([(None, 1, 5), (None, 2, 7), ("a", 1, 1), ("a", 3, 2), ("a", 2, 4)],
                               "g string, o int, v int")
    out2 = running_sums(df, ["g"], [F.col("o")], F.floor(F.col("o") / 2), {"v": F.col("v")},
                        inclusive=False, totals=True)
    got2 = {(r["g"], r["o"]): (r["cum_v"], r["total_v"]) for r in out2.collect()}
    assert got2[(None, 1)] == (0, 12) and got2[(None, 2)] == (5, 12)
    assert got2[("a", 1)] == (0, 7) and got2[("a", 2)] == (1, 7) and got2[("a", 3)] == (5, 7)
    assert len(got2) == 5
