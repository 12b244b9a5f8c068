"""A group holding most rows is spread over many window partitions."""

from pyspark.sql import functions as F

from tabsmith.functions.hashing import hash_hex, hash_unit
from tabsmith.operators.rank import hash_rank


def test_hot_group_spreads_over_cells(spark):
    n, cells = 20000, 16
    df = spark.range(n).select(F.col("id").alias("k"),
                               F.when(F.col("id") % 10 < 9, F.lit("hot")).otherwise(F.lit("cold")).alias("g"))
    # the cell a row is windowed in, exactly as hash_rank computes it
    cell = F.floor(hash_unit(hash_hex(["k"], 42)) * F.lit(cells))
    per_cell = df.filter("g = 'hot'").groupBy(cell.alias("c")).count().collect()
    assert len(per_cell) == cells
    biggest = max(r["count"] for r in per_cell)
    assert biggest < 0.1 * n          # no cell holds more than a small share of the hot group
    ranked = hash_rank(df, ["g"], "k", 42, cells=cells)
    hot = ranked.filter("g = 'hot'").agg(F.min("rank"), F.max("rank"), F.countDistinct("rank")).first()
    assert tuple(hot) == (1, 18000, 18000)


def test_rolling_cells_equal_halo(spark):
    from tabsmith.operators import history as hist
    from tests.conftest import SF001
    ev = spark.read.parquet(f"{SF001}/events.parquet").select(
        "event_id", "user_id", "ts", F.round(F.col("value") * 100).cast("long").alias("v"))
    cols = ["event_id"] + [F.round(f"roll_{s}", 6).alias(f"roll_{s}") for s in ("mean", "std", "max", "min")] + \
        ["roll_count"]
    a = hist.rolling_stats(ev, ["user_id"], "ts", "v", 3 * 86400, "event_id").select(*cols)
    b = hist.rolling_stats_cells(ev, ["user_id"], "ts", "v", 3 * 86400, "event_id", cell_seconds=3600).select(*cols)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
