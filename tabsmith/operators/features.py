"""Config-driven feature derivation (narrow column expressions).

Every operator returns a DataFrame built with one ``select``/``withColumns``
per dependency level, so long configs do not create deep plans.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabsmith.functions.nulls import eq_or_false, safe_divide, zero_filled
from tabsmith.operators.quantiles import exact_quantiles_multi

# The fill-value marker meaning "column median" in the
# reference's configs, and the epoch value pandas produces for an
# unparseable datetime (min int64 nanoseconds / 1e9).
MEDIAN_MARKERS = ("中位数", "median")
BAD_DATETIME_EPOCH = -9223372036.854776
NULL_MARKER = "null"


class ConfigError(ValueError):
    pass


def _feature_expr(kind: str, cols: Sequence[str], bad: str = "null") -> Column:
    if kind == "division":
        return safe_divide(cols[0], cols[1])
    if kind == "is_not_null":
        return F.col(cols[0]).isNotNull().cast("float")
    if kind == "sum":
        return reduce(lambda a, b: a + b, [zero_filled(c) for c in cols])
    if kind == "datetime_to_timestamp":
        ts = F.try_to_timestamp(F.col(cols[0]).cast("string"))
        e = F.unix_micros(ts) / F.lit(1e6)
        if bad == "sentinel":
            e = F.coalesce(e, F.lit(BAD_DATETIME_EPOCH))
        return e
    raise ConfigError(f"Unknown calculation type: {kind}")


def derive(df: DataFrame, specs: Sequence[Mapping], bad_datetime: str = "null") -> DataFrame:
    """Apply ``[{calculation_type, cols, new_col}, ...]`` in order.

    A feature may read one made earlier in the list; specs are grouped into
    dependency levels and each level is one ``withColumns``.
    """
    level: dict[str, Column] = {}
    for spec in specs:
        kind, cols, new = spec["calculation_type"], list(spec["cols"]), spec["new_col"]
        expr = _feature_expr(kind, cols, bad_datetime)
        if any(c in level for c in cols) or new in level:
            df = df.withColumns(level)
            level = {}
        level[new] = expr
    return df.withColumns(level) if level else df


def indicators(df: DataFrame, spec: Mapping[str, object]) -> DataFrame:
    """``{col: 'null'}`` -> ``col_null`` = is NULL; ``{col: v}`` -> ``col_v`` = (col == v)."""
    new = {}
    for c, v in spec.items():
        if v == NULL_MARKER:
            new[f"{c}_{v}"] = F.col(c).isNull().cast("int")
        else:
            new[f"{c}_{v}"] = eq_or_false(c, v).cast("int")
    return df.withColumns(new)


def fill_statistics(df: DataFrame, spec: Mapping[str, object], fit_filter: Column | None = None,
                    approx: bool = False) -> dict[str, float]:
    """Median of every column whose fill value is the median marker.

    Exact by default (distributed, see :mod:`tabsmith.operators.quantiles`);
    ``approx`` uses one ``percentile_approx`` aggregation instead.
    """
    med_cols = [c for c, v in spec.items() if v in MEDIAN_MARKERS]
    if not med_cols:
        return {}
    src = df if fit_filter is None else df.filter(fit_filter)
    if approx:
        row = src.agg(*[F.percentile_approx(F.col(c).cast("double"), 0.5, 10000).alias(c)
                        for c in med_cols]).first()
        return {c: row[c] for c in med_cols}
    # exact, without gathering a column into one task; all columns in one flow
    q = exact_quantiles_multi(src, {c: [0.5] for c in med_cols})
    return {c: q[c][0] for c in med_cols}


def fill_missing(df: DataFrame, spec: Mapping[str, object], stats: Mapping[str, float] | None = None,
                 fit_filter: Column | None = None) -> DataFrame:
    """Fill NULLs by a constant or by the column median (``fit_filter`` picks the
    rows the median is taken over; None means all rows, as the reference does)."""
    stats = dict(stats or fill_statistics(df, spec, fit_filter))
    new = {}
    for c, v in spec.items():
        value = stats.get(c) if v in MEDIAN_MARKERS else v
        if isinstance(value, (int, float)) and not isinstance(value, bool):
            new[c] = F.coalesce(F.col(c).cast("double"), F.lit(float(value)))
        elif value is None:
            new[c] = F.col(c)
        else:
            new[c] = F.coalesce(F.col(c), F.lit(value))
    return df.withColumns(new)


def clamp_positive_to_one(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c > 0, F.lit(1)).otherwise(c)


def range_to_zero(c, lo, hi) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when((c > hi) | (c < lo), F.lit(0)).otherwise(c)


def whitelist_or_zero(c, allowed: Sequence) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isin(*allowed), c).otherwise(F.lit(0))


UNUSUAL_RULES = {
    "less_than_zero": lambda c: F.when(c < 0, F.lit(-1)).otherwise(c),
    "greater_than_one": lambda c: F.when(c > 1, F.lit(1)).otherwise(c),
}


def unusual_values(df: DataFrame, spec: Mapping[str, str]) -> DataFrame:
    """``{col: 'less_than_zero' | 'greater_than_one'}``; unknown rules raise."""
    bad = [r for r in spec.values() if r not in UNUSUAL_RULES]
    if bad:
        raise ConfigError(f"unknown condition(s): {bad}")
    return df.withColumns({c: UNUSUAL_RULES[r](F.col(c)) for c, r in spec.items()})


def repair_flags(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Flag columns holding values > 1 are set to 0 there."""
    return df.withColumns({c: F.when(F.col(c) > 1, F.lit(0)).otherwise(F.col(c)) for c in cols})


def map_codes(c, mapping: Mapping) -> Column:
    """Literal code -> string lookup; unmapped codes give NULL."""
    if not mapping:
        return F.lit(None).cast("string")
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    c = F.col(c) if isinstance(c, str) else c
    return F.try_element_at(m, c)


def one_hot(df: DataFrame, spec: Mapping[str, Sequence], mappings: Mapping[str, Mapping] | None = None) -> DataFrame:
    """One-hot over closed category lists.

    ``{col: [cat, ...]}`` -> ``col_cat`` int columns in list order, appended at
    the end; the source column is dropped; unlisted / NULL values give all
    zeros.  ``mappings`` first turns codes into category strings.
    """
    mappings = mappings or {}
    if mappings:
        df = df.withColumns({c: map_codes(c, m) for c, m in mappings.items()})
    new = {}
    for c, cats in spec.items():
        for cat in cats:
            new[f"{c}_{cat}"] = eq_or_false(c, cat).cast("int")
    keep = [x for x in df.columns if x not in spec]
    return df.select(*keep, *[e.alias(n) for n, e in new.items()])


def any_zero_label(cols: Sequence[str]) -> Column:
    """``1 - prod(fillna(cols, 0))``; no label columns -> 0."""
    if not cols:
        return F.lit(0.0)
    prod = reduce(lambda a, b: a * b, [zero_filled(c) for c in cols])
    return F.lit(1.0) - prod


def cast_features(df: DataFrame, keys: Sequence[str] = (), dtype: str = "float") -> DataFrame:
    """Cast all non-key columns (keys keep their exact type)."""
    return df.select(*[F.col(c) if c in keys else F.col(c).cast(dtype).alias(c) for c in df.columns])
