"""NULL / NaN / infinity contract, hashing and name mapping."""

import math

import pytest
from pyspark.sql import functions as F

from tabsmith.functions.naming import rename_positional, standardized_names, strip_table_prefix
from tabsmith.functions.nulls import eq_or_false, nan_to_null, safe_divide, zero_filled


def test_safe_divide_signs_and_missing(spark):
    rows = [(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (1.0, -0.0), (None, 1.0), (1.0, None), (6.0, 3.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    got = [r[0] for r in df.select(safe_divide("a", "b")).collect()]
    assert got[0] == math.inf and got[1] == -math.inf
    assert got[2] is None          # 0/0 is missing
    assert got[3] == math.inf      # -0.0 treated as 0
    assert got[4] is None and got[5] is None
    assert got[6] == 2.0


def test_nan_to_null_and_eq_or_false(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (2.0,)], "x double")
    out = df.select(nan_to_null("x").alias("x"), eq_or_false("x", 2.0).alias("e"),
                    zero_filled("x").alias("z")).collect()
    assert out[0]["x"] is None and out[1]["x"] is None and out[2]["x"] == 2.0
    assert [r["e"] for r in out] == [False, False, True]
    assert out[1]["z"] == 0.0


def test_standardized_names_collisions():
    assert standardized_names(["a b", "a_b", "a b", "c"]) == ["a_b", "a_b_1", "a_b_2", "c"]
    assert strip_table_prefix("t.x") == "x" and strip_table_prefix("tx") == "tx"


def test_rename_positional_checks_arity(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rename_positional(df, ["x", "y"]).columns == ["x", "y"]
    with pytest.raises(ValueError):
        rename_positional(df, ["x"])


def test_hash_matches_duckdb(spark, duck):
    from tabsmith.functions.hashing import hash_hex
    df = spark.createDataFrame([(1,), (12345,)], "k long")
    got = [r[0] for r in df.select(hash_hex("k", 42)).collect()]
    want = [r[0] for r in duck.execute("SELECT md5(CAST(k AS VARCHAR) || '|42') FROM (VALUES (1), (12345)) t(k)").fetchall()]
    assert got == want
