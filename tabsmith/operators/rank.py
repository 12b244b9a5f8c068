"""Distributed ordered ranks and running sums.

A running sum over ``Window.partitionBy(g).orderBy(o)`` runs each group in one
task; a group holding a third of all rows would then be one task.  Here every
row also carries a *cell*: a value that never decreases along ``o`` inside a
group (a hash range, a time bucket, a score bucket).  Rows are windowed only
inside ``(g, cell)``; per-cell totals form a small table whose running sums
give each cell its offset.  A hot group is therefore spread over many cells
and tasks, and the result is exact and deterministic (no partition ids, no
sampling), so a lost executor recomputes the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.functions.hashing import hash_hex, hash_unit


def default_cells(df: DataFrame) -> int:
    """Cells per group: the shuffle parallelism configured for the job."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(2, n)


NULL_CELL = -(1 << 62)
_DEFAULTS = {"string": "", "boolean": False, "date": "1970-01-01", "timestamp": "1970-01-01 00:00:00",
             "timestamp_ntz": "1970-01-01 00:00:00"}


def _plain_keys(df: DataFrame, group_cols: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Replace each group column by (null flag, value with a typed default) so
    the window and the offsets join can use plain equality on the same
    columns: the join then reuses the window's partitioning instead of
    re-shuffling the rows (a null-safe join key would partition differently)."""
    types = dict(df.dtypes)
    keys, new = [], {}
    for i, c in enumerate(group_cols):
        t = types[c]
        default = _DEFAULTS.get(t, 0)
        new[f"_gn{i}"] = F.col(c).isNull()
        new[f"_gk{i}"] = F.coalesce(F.col(c), F.lit(default).cast(t))
        keys += [f"_gk{i}", f"_gn{i}"]
    return df.withColumns(new), keys


def running_sums(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column],
                 cell: Column, sums: dict[str, Column], inclusive: bool = True,
                 totals: bool = False, enrich=None) -> DataFrame:
    """Add ``cum_<name>`` (running sum in order) and optionally ``total_<name>``.

    ``cell`` must be non-decreasing in ``order_cols`` within a group and
    ``order_cols`` must be a total order (end with a unique key) for the result
    to be deterministic.  ``enrich`` may add per-group columns to the small
    offsets table (one row per group and cell) before it is joined to the
    rows, so group-level values (quotas, thresholds) need no extra pass.
    """
    user_groups = list(group_cols)
    x, group_cols = _plain_keys(df, user_groups)
    # a null order value sorts first, so its rows form the first cell
    x = x.withColumn("_cell", F.coalesce(cell.cast("long"), F.lit(NULL_CELL)))
    x = x.withColumns({f"_v_{n}": e for n, e in sums.items()})
    part = group_cols + ["_cell"]
    frame = (Window.partitionBy(*part).orderBy(*order_cols)
             .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1))
    # rows are shuffled once, by (group, cell), for the window; the offsets
    # join below keys on the same plain columns and reuses that partitioning
    local = x.withColumns({f"_l_{n}": F.coalesce(F.sum(f"_v_{n}").over(frame), F.lit(0)) for n in sums})
    # per-cell totals: map-side combined, so only partial sums are shuffled
    cell_tot = x.groupBy(*part).agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums])
    before = (Window.partitionBy(*group_cols) if group_cols else Window.partitionBy()) \
        .orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    grp = Window.partitionBy(*group_cols) if group_cols else Window.partitionBy()
    offs = {f"_o_{n}": F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)) for n in sums}
    if totals:
        offs.update({f"total_{n}": F.sum(f"_t_{n}").over(grp) for n in sums})
    offsets = cell_tot.select(*part, *[e.alias(k) for k, e in offs.items()])
    if enrich is not None:
        # enrich sees the user's group columns (restored from the plain keys)
        restore = {g: F.when(~F.col(f"_gn{i}"), F.col(f"_gk{i}")) for i, g in enumerate(user_groups)}
        offsets = enrich(offsets.withColumns(restore)).drop(*user_groups)
    out = local.join(offsets, part, "inner")
    out = out.withColumns({f"cum_{n}": F.col(f"_l_{n}") + F.col(f"_o_{n}") for n in sums})
    drop = ["_cell", *group_cols] + [f"_{p}_{n}" for n in sums for p in ("v", "l", "o")]
    return out.drop(*drop)


def hash_rank(df: DataFrame, group_cols: Sequence[str], key_cols: Sequence[str] | str,
              salt, rank_col: str = "rank", size_col: str | None = "group_size",
              cells: int | None = None, enrich=None) -> DataFrame:
    """1-based rank of each row by md5(key|salt) within its group.

    Equals ``row_number() OVER (PARTITION BY g ORDER BY md5(key|salt), key)``.
    """
    if isinstance(key_cols, str):
        key_cols = [key_cols]
    cells = cells or default_cells(df)
    h = hash_hex(key_cols, salt)
    x = df.withColumn("_h", h)
    cell = F.floor(hash_unit(F.col("_h")) * F.lit(cells))
    order = [F.col("_h")] + [F.col(k) for k in key_cols]
    out = running_sums(x, group_cols, order, cell, {"one": F.lit(1).cast("long")},
                       inclusive=True, totals=size_col is not None, enrich=enrich)
    out = out.withColumnRenamed("cum_one", rank_col)
    if size_col is not None:
        out = out.withColumnRenamed("total_one", size_col)
    return out.drop("_h")
