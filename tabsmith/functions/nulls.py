"""One NULL contract for every operator.

pandas has a single missing marker (NaN); Spark has NULL and NaN, and in
Spark ``NaN = NaN`` and ``NaN > 0`` are true.  Inputs are mapped NaN -> NULL
once, then every operator speaks NULL only.  Division follows IEEE signs for
x/0 but gives NULL for 0/0 (pandas' "missing"), and never raises under ANSI.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POS_INF = float("inf")
NEG_INF = float("-inf")


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    c = col_(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c.cast("double"))


def nulls_for_nan(df):
    """The one mapping at ingest: NaN is missing in every float and double column."""
    floats = {c: t for c, t in df.dtypes if t in ("float", "double")}
    if not floats:
        return df
    return df.withColumns({c: F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")) for c in floats})


def safe_divide(a, b) -> Column:
    """a / b with x/0 -> +-inf, 0/0 -> NULL, NULL in -> NULL.

    ``-0.0`` in the divisor is treated as 0 (the sign of zero is ignored).
    """
    a, b = col_(a).cast("double"), col_(b).cast("double")
    return (F.when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
            .when(b == 0, F.when(a > 0, F.lit(POS_INF))
                  .when(a < 0, F.lit(NEG_INF))
                  .otherwise(F.lit(None).cast("double")))
            .otherwise(a / b))


def ratio_or_zero(num, den) -> Column:
    """Metric ratio; 0.0 when the denominator is 0 (the usual metric rule)."""
    num, den = col_(num).cast("double"), col_(den).cast("double")
    return F.when(den == 0, F.lit(0.0)).otherwise(num / den)


def eq_or_false(c, value) -> Column:
    """``c == value`` where a missing c compares false (pandas semantics)."""
    return F.coalesce(col_(c) == F.lit(value), F.lit(False))


def zero_filled(c) -> Column:
    return F.coalesce(col_(c).cast("double"), F.lit(0.0))
