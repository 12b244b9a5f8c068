"""Per-column scaling with the formulas of the common Python scalers.

Spark's ML scalers differ (MinMaxScaler maps a constant column to 0.5,
StandardScaler uses the sample std, RobustScaler approximate quantiles), so
the statistics of every column are fitted in one aggregation and applied as
column expressions.  A near-zero range / std / IQR divides by 1.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.operators.quantiles import exact_quantiles_multi

# Method names as they appear in the reference's configs,
# mapped to short English names that are accepted too.
METHOD_ALIASES = {
    "min-max变换": "minmax",
    "log 变换+标准化": "log_standard",
    "标准化": "standard",
    "robustscaler变换": "robust",
    "数据平移+log 变换+标准化": "shift_log_standard",
}
METHODS = {"minmax", "log_standard", "standard", "robust", "shift_log_standard"}
ZERO_SCALE = 10 * 2.220446049250313e-16


def _method(m: str) -> str:
    m = METHOD_ALIASES.get(m, m)
    if m not in METHODS:
        raise ValueError(f"Unsupported normalization method: {m}")
    return m


def _log1p(c: Column) -> Column:
    # ln(1 + x); NULL where undefined (x <= -1)
    return F.when(c > -1, F.log1p(c))


def _prepared(c: str, method: str) -> Column:
    x = F.col(c).cast("double")
    if method == "log_standard":
        return _log1p(x)
    if method == "shift_log_standard":
        return _log1p(x + 1)
    return x


def fit_scaling(df: DataFrame, spec: Mapping[str, str], approx: bool = False) -> dict:
    """Statistics for every column in one aggregation (one row to the driver)."""
    aggs = []
    for c, m in spec.items():
        m = _method(m)
        x = _prepared(c, m)
        if m == "minmax":
            aggs += [F.min(x).alias(f"{c}__lo"), F.max(x).alias(f"{c}__hi")]
        elif m == "robust":
            if approx:
                aggs.append(F.percentile_approx(x, [0.25, 0.5, 0.75], 10000).alias(f"{c}__q"))
        else:
            aggs += [F.avg(x).alias(f"{c}__mu"), F.stddev_pop(x).alias(f"{c}__sd")]
    row = df.agg(*aggs).first().asDict() if aggs else {}
    robust = [c for c, m in spec.items() if _method(m) == "robust"]
    if robust and not approx:
        # exact quartiles of all robust columns in one distributed flow
        qs = exact_quantiles_multi(df, {c: [0.25, 0.5, 0.75] for c in robust})
        for c in robust:
            row[f"{c}__q"] = None if qs[c][0] is None else qs[c]
    stats = {}
    for c, m in spec.items():
        m = _method(m)
        if m == "minmax":
            lo, hi = row[f"{c}__lo"], row[f"{c}__hi"]
            shift, scale = lo, (None if lo is None else hi - lo)
        elif m == "robust":
            q = row[f"{c}__q"]
            shift, scale = (None, None) if q is None else (q[1], q[2] - q[0])
        else:
            shift, scale = row[f"{c}__mu"], row[f"{c}__sd"]
        if scale is not None and abs(scale) < ZERO_SCALE:
            scale = 1.0
        stats[c] = {"method": m, "shift": shift, "scale": scale}
    return stats


def apply_scaling(df: DataFrame, stats: Mapping[str, Mapping], digits: int | None = None) -> DataFrame:
    new = {}
    for c, s in stats.items():
        x = _prepared(c, s["method"])
        if s["shift"] is None:
            e = F.lit(None).cast("double")
        else:
            e = (x - F.lit(float(s["shift"]))) / F.lit(float(s["scale"]))
        new[c] = F.round(e, digits) if digits is not None else e
    return df.withColumns(new)


def scale(df: DataFrame, spec: Mapping[str, str], digits: int | None = None,
          fit_on: DataFrame | None = None) -> DataFrame:
    """Fit on ``fit_on`` (default: ``df`` itself, as the reference does) and apply."""
    return apply_scaling(df, fit_scaling(fit_on if fit_on is not None else df, spec), digits)


def stats_frame(spark: SparkSession, stats: Mapping[str, Mapping]) -> DataFrame:
    """The fitted statistics as a small table (to persist next to a model)."""
    rows = [(c, s["method"], s["shift"], s["scale"]) for c, s in stats.items()]
    return spark.createDataFrame(rows, "column string, method string, shift double, scale double")
