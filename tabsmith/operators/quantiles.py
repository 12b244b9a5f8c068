"""Exact quantiles without gathering a column into one task.

Spark's exact ``percentile``/``median`` merges a value -> count map of the
whole column in a single task for a global statistic.  Here, for any number
of columns at once:

1. one aggregation: per column the row count and ``cells - 1`` approximate
   quantile bounds (bounded sketches);
2. the columns are stacked to (column, value) and reduced to distinct values
   with counts (map-side combined);
3. running counts in value order per column via ``running_sums`` (cells from
   the bounds, so a column -- or a heavy value range -- is spread over tasks);
4. one aggregation picks the values at the ranks around ``q * (n - 1)``,
   which are interpolated linearly (the rule SQL engines and pandas use).

Only the bounds and one row of picked values reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.operators.rank import default_cells, running_sums


def exact_quantiles_multi(df: DataFrame, probs: Mapping[str, Sequence[float]], cells: int | None = None,
                          accuracy: int = 1000) -> dict[str, list[float | None]]:
    cols = list(probs)
    if not cols:
        return {}
    cells = cells or default_cells(df)
    qs = [i / cells for i in range(1, cells)]
    clean = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in cols}
    stats = df.agg(*[F.count(clean[c]).alias(f"n{i}") for i, c in enumerate(cols)],
                   *[F.percentile_approx(clean[c], qs, accuracy).alias(f"b{i}") for i, c in enumerate(cols)]
                   ).first()
    totals = {c: stats[f"n{i}"] for i, c in enumerate(cols)}
    bounds = {c: sorted(set(stats[f"b{i}"] or [])) for i, c in enumerate(cols)}
    long = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("col"), clean[c].alias("v"))
                                         for i, c in enumerate(cols)])).alias("_s")) \
        .select("_s.col", "_s.v").filter(F.col("v").isNotNull())
    hist = long.groupBy("col", "v").agg(F.count(F.lit(1)).alias("c"))
    cell = F.lit(0)
    for i, c in enumerate(cols):
        if bounds[c]:
            arr = F.array(*[F.lit(float(b)) for b in bounds[c]])
            cell = F.when(F.col("col") == i, F.size(F.filter(arr, lambda b: b < F.col("v")))).otherwise(cell)
    cum = running_sums(hist, ["col"], [F.col("v")], cell, {"c": F.col("c")}, inclusive=True)
    ranks, picks = {}, []
    for i, c in enumerate(cols):
        n = totals[c]
        ranks[c] = []
        for q in probs[c]:
            if not n:
                ranks[c].append(None)
                continue
            p = q * (n - 1)
            lo, hi = int(math.floor(p)), int(math.ceil(p))
            ranks[c].append((lo, hi, p - lo))
            for r in {lo, hi}:
                # a value covers 0-based ranks [cum - c, cum - 1]
                picks.append(F.max(F.when((F.col("col") == i) & (F.col("cum_c") - F.col("c") <= r)
                                          & (F.lit(r) < F.col("cum_c")), F.col("v"))).alias(f"c{i}_r{r}"))
    row = cum.agg(*picks).first() if picks else None
    out = {}
    for i, c in enumerate(cols):
        vals = []
        for rk in ranks[c]:
            if rk is None:
                vals.append(None)
                continue
            lo, hi, frac = rk
            a, b = row[f"c{i}_r{lo}"], row[f"c{i}_r{hi}"]
            # (hi - p) * a + (p - lo) * b: the form SQL engines use
            vals.append((1.0 - frac) * a + frac * b if frac else a)
        out[c] = vals
    return out


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], cells: int | None = None,
                    accuracy: int = 1000) -> list[float | None]:
    return exact_quantiles_multi(df, {col: list(probs)}, cells, accuracy)[col]
