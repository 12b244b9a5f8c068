"""Feature derivation and scaling semantics."""

import math

import pytest
from pyspark.sql import functions as F

from tabsmith.operators import features as ft
from tabsmith.operators import scaling as sc


def test_derive_chain_and_unknown(spark):
    df = spark.createDataFrame([(4.0, 2.0, None), (1.0, 0.0, 3.0)], "a double, b double, c double")
    out = ft.derive(df, [{"calculation_type": "division", "cols": ["a", "b"], "new_col": "r"},
                         {"calculation_type": "sum", "cols": ["r", "c"], "new_col": "s"},
                         {"calculation_type": "is_not_null", "cols": ["c"], "new_col": "has_c"}]).collect()
    assert out[0]["r"] == 2.0 and out[0]["s"] == 2.0 and out[0]["has_c"] == 0.0
    assert out[1]["r"] == math.inf
    with pytest.raises(ft.ConfigError):
        ft.derive(df, [{"calculation_type": "nope", "cols": ["a"], "new_col": "x"}])


def test_datetime_coerce(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:01",), ("bad",)], "s string")
    got = [r[0] for r in ft.derive(df, [{"calculation_type": "datetime_to_timestamp", "cols": ["s"],
                                         "new_col": "e"}]).select("e").collect()]
    assert got == [1704067201.0, None]
    got = ft.derive(df, [{"calculation_type": "datetime_to_timestamp", "cols": ["s"], "new_col": "e"}],
                    bad_datetime="sentinel").select("e").collect()[1][0]
    assert got == ft.BAD_DATETIME_EPOCH


def test_indicators_before_fill_and_median(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,), (10.0,)], "x double")
    ind = ft.indicators(df, {"x": "null"})
    filled = ft.fill_missing(ind, {"x": "中位数"})
    rows = filled.collect()
    assert [r["x_null"] for r in rows] == [0, 1, 0, 0]
    assert rows[1]["x"] == 3.0


def test_one_hot_closed_list(spark):
    df = spark.createDataFrame([("A",), ("R",), (None,)], "f string")
    out = ft.one_hot(df, {"f": ["A", "N", "X"]})
    assert out.columns == ["f_A", "f_N", "f_X"]
    assert [tuple(r) for r in out.collect()] == [(1, 0, 0), (0, 0, 0), (0, 0, 0)]


def test_clamps_and_unknown_rule(spark):
    df = spark.createDataFrame([(-5.0, 2.0, None)], "a double, b double, c double")
    r = ft.unusual_values(df, {"a": "less_than_zero", "b": "greater_than_one"}).first()
    assert r["a"] == -1 and r["b"] == 1
    with pytest.raises(ft.ConfigError):
        ft.unusual_values(df, {"a": "weird"})
    r = df.select(ft.whitelist_or_zero("c", [6, 8]).alias("w")).first()
    assert r["w"] == 0
    assert df.select(ft.any_zero_label([]).alias("l")).first()["l"] == 0.0


def test_scalers_match_reference_formulas(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 3.0), (3.0, 3.0), (10.0, 3.0)], "x double, k double")
    out = sc.scale(df, {"x": "标准化", "k": "min-max变换"}).collect()
    xs = [1.0, 2.0, 3.0, 10.0]
    mu = sum(xs) / 4
    sd = math.sqrt(sum((v - mu) ** 2 for v in xs) / 4)
    assert out[0]["x"] == pytest.approx((1 - mu) / sd)
    assert all(r["k"] == 0.0 for r in out)
    rb = sc.scale(df, {"x": "robust"}).collect()
    assert rb[1]["x"] == pytest.approx((2.0 - 2.5) / (4.75 - 1.75))
    with pytest.raises(ValueError):
        sc.scale(df, {"x": "nope"})
