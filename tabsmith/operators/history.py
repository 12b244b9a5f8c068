"""Leakage-safe history features over an event log (strictly earlier rows).

Both operators bound the work per task even when one entity owns a large
share of all events: running rates use cell-split running sums; range
windows use time cells with a halo of the preceding window length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.operators.rank import _plain_keys, running_sums
from tabsmith.session import materialize

DAY_SECONDS = 86400
MICROS = 1_000_000


def epoch_micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def historical_rate(df: DataFrame, entity: Sequence[str], ts: str, tiebreak: str, value: str,
                    cell_seconds: int = 3600, prefix: str = "prior") -> DataFrame:
    """``{prefix}_count`` and ``{prefix}_rate``: count and mean of ``value`` over
    the entity's strictly earlier rows (by ts, then tiebreak)."""
    cell = F.floor(epoch_micros(ts) / F.lit(cell_seconds * MICROS))
    out = running_sums(df, list(entity), [F.col(ts), F.col(tiebreak)], cell,
                       {"n": F.lit(1).cast("long"), "s": F.col(value).cast("double")},
                       inclusive=False)
    return out.withColumn(f"{prefix}_rate", F.when(F.col("cum_n") > 0, F.col("cum_s") / F.col("cum_n"))) \
        .withColumnRenamed("cum_n", f"{prefix}_count").drop("cum_s")


def rolling_stats(df: DataFrame, entity: Sequence[str], ts: str, value: str, window_seconds: int,
                  key: str, cell_seconds: int | None = None, prefix: str = "roll") -> DataFrame:
    """Mean, sample std, max, min and count of ``value`` over the entity's rows
    with ts in [ts - window, ts) (the current instant excluded).  A row without a
    time has no earlier rows and is none: its count is 0.

    Each row is windowed inside its time cell; copies of the rows of the
    preceding cells that can fall inside a window (the halo) are added, so a
    task never holds more than one cell plus one window of one entity.
    """
    entity = list(entity)
    cell_seconds = cell_seconds or window_seconds
    halo = -(-window_seconds // cell_seconds)           # ceil
    us = epoch_micros(ts)
    x = df.where(us.isNotNull()).withColumn("_us", us).withColumn("_home", F.floor(F.col("_us") / F.lit(cell_seconds * MICROS)))
    x = x.withColumn("_cell", F.explode(F.sequence(F.col("_home"), F.col("_home") + F.lit(halo))))
    w = (Window.partitionBy(*entity, "_cell").orderBy("_us")
         .rangeBetween(-window_seconds * MICROS, -1))
    v = F.col(value).cast("double")
    out = x.select(
        *df.columns, "_cell", "_home",
        F.avg(v).over(w).alias(f"{prefix}_mean"),
        F.stddev_samp(v).over(w).alias(f"{prefix}_std"),
        F.max(v).over(w).alias(f"{prefix}_max"),
        F.min(v).over(w).alias(f"{prefix}_min"),
        F.count(v).over(w).alias(f"{prefix}_count"))
    out = out.filter(F.col("_cell") == F.col("_home")).drop("_cell", "_home")
    none = {f"{prefix}_{c}": F.lit(None).cast("double") for c in ("mean", "std", "max", "min")}
    return out.unionByName(df.where(us.isNull()).withColumns({**none, f"{prefix}_count": F.lit(0).cast("long")}))


def calendar_parts(ts: str) -> dict[str, Column]:
    """hour, day, month, day of week (Monday = 0) and weekend flag."""
    t = F.col(ts)
    dow = F.weekday(t)
    return {"hour": F.hour(t), "day": F.dayofmonth(t), "month": F.month(t),
            "day_of_week": dow, "is_weekend": (dow >= 5).cast("int")}


def calendar_flags(df: DataFrame, calendar: DataFrame, ts: str, kinds: Sequence[str]) -> DataFrame:
    """Flags ``is_<kind>`` for rows whose date lies in a [start, end] range of
    that kind.

    The range join becomes an equi-join on the date: the calendar is expanded
    to one row per covered day (its size is bounded by the days it spans, not
    by the data) and broadcast.
    """
    days = calendar.select(F.explode(F.sequence(F.col("start").cast("date"), F.col("end").cast("date")))
                           .alias("_day"), "kind")
    flags = days.groupBy("_day").agg(*[F.max((F.col("kind") == k).cast("int")).alias(f"is_{k}")
                                       for k in kinds])
    out = df.withColumn("_day", F.to_date(F.col(ts))).join(F.broadcast(flags), "_day", "left")
    return out.withColumns({f"is_{k}": F.coalesce(F.col(f"is_{k}"), F.lit(0)) for k in kinds}).drop("_day")


def rolling_stats_cells(df: DataFrame, entity: Sequence[str], ts: str, value: str, window_seconds: int,
                        key: str, cell_seconds: int = 3600, prefix: str = "roll") -> DataFrame:
    """Skew-safe form of :func:`rolling_stats` (same results).

    The window [t - W, t) of a row in cell c (cells of ``cell_seconds``, W a
    multiple of it, K = W / cell) is split into
      A. earlier rows of its own cell            -- window per (entity, cell);
      B. the K - 1 full cells in between         -- per-(entity, cell) sums, a
         range window over the small cell table;
      C. the rows of boundary cell c - K at or after t - W -- suffix sums of
         that cell, found by an as-of lookup windowed per (entity, cell).
    Every window is per (entity, cell), so an entity with a huge share of the
    rows is spread over its cells.  ``key`` is not relied on: nulls and doubles
    in it are fine.  Rows without a time take no part and get a count of 0.
    """
    if window_seconds % cell_seconds:
        raise ValueError("window_seconds must be a multiple of cell_seconds")
    entity = list(entity)
    K = window_seconds // cell_seconds
    W = window_seconds * MICROS
    # Rows get an id of their own, so null or doubled keys lose or multiply none;
    # null entities are a group like any other (plain keys, a null flag each).
    base = materialize(df.withColumn("_rid", F.monotonically_increasing_id()), "rolling-rows")
    key = "_rid"
    x, entity = _plain_keys(base, entity)
    x = x.select(*entity, "_rid", epoch_micros(ts).alias("_us"), F.col(value).cast("double").alias("_v")) \
        .where("_us is not null").withColumn("_c", F.floor(F.col("_us") / F.lit(cell_seconds * MICROS)))
    # Sums of squares are taken around the entity's mean, so large values with a
    # small spread keep their digits.
    means = x.groupBy(*entity).agg(F.avg("_v").alias("_m"))
    x = x.join(means, entity, "left").withColumn("_w", F.col("_v") - F.col("_m"))
    part = [*entity, "_c"]
    # A: own cell, strictly earlier instants
    wa = Window.partitionBy(*part).orderBy("_us").rangeBetween(Window.unboundedPreceding, -1)
    a = x.select(*entity, key, "_c", "_us", "_m",
                 F.count("_v").over(wa).alias("a_n"), F.sum("_w").over(wa).alias("a_s"),
                 F.sum(F.col("_w") * F.col("_w")).over(wa).alias("a_q"),
                 F.max("_v").over(wa).alias("a_mx"), F.min("_v").over(wa).alias("a_mn"))
    # B: full cells c-K+1 .. c-1 from the per-cell table
    cells = x.groupBy(*part).agg(F.count("_v").alias("n"), F.sum("_w").alias("s"),
                                 F.sum(F.col("_w") * F.col("_w")).alias("q"),
                                 F.max("_v").alias("mx"), F.min("_v").alias("mn"))
    wb = Window.partitionBy(*entity).orderBy("_c").rangeBetween(-(K - 1), -1)
    b = cells.select(*part, F.sum("n").over(wb).alias("b_n"), F.sum("s").over(wb).alias("b_s"),
                     F.sum("q").over(wb).alias("b_q"), F.max("mx").over(wb).alias("b_mx"),
                     F.min("mn").over(wb).alias("b_mn"))
    # C: suffix sums inside each cell, looked up at t - W in cell c - K
    ws = Window.partitionBy(*part).orderBy("_us").rangeBetween(0, Window.unboundedFollowing)
    data = x.select(*part, "_us", F.lit(1).alias("_kind"), F.lit(None).cast("long").alias("_qk"),
                    F.struct(F.count("_v").over(ws).alias("n"), F.sum("_w").over(ws).alias("s"),
                             F.sum(F.col("_w") * F.col("_w")).over(ws).alias("q"),
                             F.max("_v").over(ws).alias("mx"), F.min("_v").over(ws).alias("mn")).alias("_suf"))
    queries = x.select(*entity, (F.col("_c") - K).alias("_c"), (F.col("_us") - W).alias("_us"),
                       F.lit(0).alias("_kind"), F.col(key).alias("_qk"),
                       F.lit(None).cast(data.schema["_suf"].dataType).alias("_suf"))
    wq = Window.partitionBy(*part).orderBy("_us", "_kind").rowsBetween(0, Window.unboundedFollowing)
    c = data.unionByName(queries).withColumn("_hit", F.first("_suf", ignorenulls=True).over(wq)) \
        .filter(F.col("_kind") == 0).select(F.col("_qk").alias(key), "_hit")
    out = a.join(b, part, "left").join(c, key, "left")
    z = lambda col: F.coalesce(col, F.lit(0))
    n = z(F.col("a_n")) + z(F.col("b_n")) + z(F.col("_hit.n"))
    s = z(F.col("a_s")) + z(F.col("b_s")) + z(F.col("_hit.s"))
    q = z(F.col("a_q")) + z(F.col("b_q")) + z(F.col("_hit.q"))
    mean = F.col("_m") + s / n
    var = (q - s * s / n) / (n - 1)
    stats = out.select(
        key,
        F.when(n > 0, mean).alias(f"{prefix}_mean"),
        F.when(n > 1, F.sqrt(F.greatest(var, F.lit(0.0)))).alias(f"{prefix}_std"),
        F.greatest("a_mx", "b_mx", "_hit.mx").alias(f"{prefix}_max"),
        F.least("a_mn", "b_mn", "_hit.mn").alias(f"{prefix}_min"),
        n.cast("long").alias(f"{prefix}_count"))
    out = base.join(stats, key, "left").drop("_rid")
    return out.withColumn(f"{prefix}_count", F.coalesce(f"{prefix}_count", F.lit(0)))
