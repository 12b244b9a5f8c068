"""Registered checks: feature derivation (F*), projections (P*), sources and
sinks (S*, K1/K2/K4)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.functions.naming import rename_positional, standardize_columns
from tabsmith.operators import features as ft
from tabsmith.operators.metrics import binary_metrics as _binary_metrics
from tabsmith.plans import fixtures as fx
from tabsmith.session import output_path
from tabsmith.sources import io

LI_KEYS = ["l_orderkey", "l_linenumber"]


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = fx.table(spark, sf_dir, "lineitem")
    return li.select(*LI_KEYS, "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                     "l_returnflag", "l_linestatus",
                     F.nullif(F.col("l_discount"), F.lit(0.0)).alias("d"),
                     F.nullif(F.col("l_tax"), F.lit(0.0)).alias("t"))


def feat_division(spark, sf_dir):
    li = lineitem(spark, sf_dir).withColumn("tax_gap", F.col("l_tax") - F.lit(0.04))
    out = ft.derive(li, [
        {"calculation_type": "division", "cols": ["l_extendedprice", "l_discount"], "new_col": "price_per_discount"},
        {"calculation_type": "division", "cols": ["l_tax", "l_discount"], "new_col": "tax_per_discount"},
        {"calculation_type": "division", "cols": ["tax_gap", "l_discount"], "new_col": "gap_per_discount"},
    ])
    return out.select(*LI_KEYS, "price_per_discount", "tax_per_discount", "gap_per_discount")


def feat_is_not_null(spark, sf_dir):
    out = ft.derive(lineitem(spark, sf_dir),
                    [{"calculation_type": "is_not_null", "cols": ["d"], "new_col": "has_discount"}])
    return out.select(*LI_KEYS, "has_discount")


def feat_row_sum(spark, sf_dir):
    out = ft.derive(lineitem(spark, sf_dir),
                    [{"calculation_type": "sum", "cols": ["d", "t", "l_quantity"], "new_col": "row_sum"}])
    return out.select(*LI_KEYS, "row_sum")


def _event_strings(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events")
    return ev.select("event_id", F.when(F.col("event_id") % 7 == 0, F.lit("bad"))
                     .otherwise(F.col("ts").cast("string")).alias("ts_text"))


def feat_epoch(spark, sf_dir):
    out = ft.derive(_event_strings(spark, sf_dir),
                    [{"calculation_type": "datetime_to_timestamp", "cols": ["ts_text"], "new_col": "epoch"}])
    return out.select("event_id", "epoch")


CHAIN = [
    {"calculation_type": "division", "cols": ["l_extendedprice", "l_quantity"], "new_col": "unit_price"},
    {"calculation_type": "sum", "cols": ["unit_price", "t"], "new_col": "price_tax"},
    {"calculation_type": "is_not_null", "cols": ["t"], "new_col": "has_tax"},
    {"calculation_type": "division", "cols": ["price_tax", "has_tax"], "new_col": "price_per_tax_flag"},
]


def feat_chain(spark, sf_dir):
    out = ft.derive(lineitem(spark, sf_dir), CHAIN)
    return out.select(*LI_KEYS, "unit_price", "price_tax", "has_tax", "price_per_tax_flag")


def null_indicator(spark, sf_dir):
    out = ft.indicators(lineitem(spark, sf_dir), {"d": "null", "t": "null"})
    return out.select(*LI_KEYS, "d_null", "t_null")


def value_indicator(spark, sf_dir):
    out = ft.indicators(lineitem(spark, sf_dir), {"l_linenumber": 1, "l_returnflag": "N"})
    return out.select(*LI_KEYS, "l_linenumber_1", "l_returnflag_N")


def fill_constant(spark, sf_dir):
    out = ft.fill_missing(lineitem(spark, sf_dir), {"d": 0.5, "t": -1})
    return out.select(*LI_KEYS, "d", "t")


def fill_median(spark, sf_dir):
    out = ft.fill_missing(lineitem(spark, sf_dir), {"d": "中位数", "t": "median"})
    return out.select(*LI_KEYS, "d", "t")


def clamp_positive_to_one(spark, sf_dir):
    li = lineitem(spark, sf_dir)
    return li.select(*LI_KEYS, ft.clamp_positive_to_one(F.col("l_linenumber") - 3).alias("refund_count"))


def range_to_zero(spark, sf_dir):
    p = fx.table(spark, sf_dir, "part")
    return p.select("p_partkey", ft.range_to_zero("p_size", 4, 13).alias("age"))


def whitelist_or_zero(spark, sf_dir):
    p = fx.table(spark, sf_dir, "part")
    return p.select("p_partkey", ft.whitelist_or_zero(F.nullif(F.col("p_size"), F.lit(10)), [6, 8])
                    .alias("class_size"))


def clip_below_zero(spark, sf_dir):
    c = fx.table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return ft.unusual_values(c, {"c_acctbal": "less_than_zero"})


def clip_above_one(spark, sf_dir):
    s = fx.table(spark, sf_dir, "supplier").select(
        "s_suppkey", (F.col("s_acctbal") / 1000.0).alias("acct_k"))
    return ft.unusual_values(s, {"acct_k": "greater_than_one"})


def flag_repair(spark, sf_dir):
    li = lineitem(spark, sf_dir).select(
        *LI_KEYS, (F.col("l_linenumber") % 3).alias("f1"),
        (F.col("l_quantity").cast("int") % 4).alias("f2"))
    return ft.repair_flags(li, ["f1", "f2"])


# Fixed values for the code-map and one-hot checks.
LINE_CODES = {1: "first", 2: "second", 3: "third"}
RETURN_FLAG_CATEGORIES = ["A", "N", "X"]


def map_codes(spark, sf_dir):
    li = lineitem(spark, sf_dir)
    return li.select(*LI_KEYS, ft.map_codes("l_linenumber", LINE_CODES).alias("line_code"))


def one_hot_custom(spark, sf_dir):
    li = lineitem(spark, sf_dir).select(*LI_KEYS, "l_returnflag")
    return ft.one_hot(li, {"l_returnflag": RETURN_FLAG_CATEGORIES})


def label_any_zero(spark, sf_dir):
    li = lineitem(spark, sf_dir).select(
        *LI_KEYS, (F.col("l_returnflag") == "N").cast("double").alias("c1"),
        F.when(F.col("l_linestatus") == "O", F.lit(1.0)).alias("c2"), "t")
    return li.select(*LI_KEYS, ft.any_zero_label(["c1", "c2", "t"]).alias("label"))


# ---- projections

ORDER_NAMES = ["order_id", "customer_id", "status", "total_price", "order_ts", "priority"]


def rename_columns(spark, sf_dir):
    return rename_positional(fx.table(spark, sf_dir, "orders"), ORDER_NAMES)


def standardize_names(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order key"), F.col("o_custkey").alias("order_key"),
        F.col("o_totalprice").alias("total price"), F.col("o_totalprice").alias("total_price"),
        F.col("o_orderstatus").alias("status"))
    return standardize_columns(o)


def drop_columns(spark, sf_dir):
    return fx.table(spark, sf_dir, "orders").drop("o_orderstatus", "o_orderpriority")


def cast_features(spark, sf_dir):
    c = fx.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return ft.cast_features(c, keys=["c_custkey"])


def _flagged_orders(spark, sf_dir):
    o = fx.order_labels(spark, sf_dir)
    return o.select("row_id", F.col("o_custkey").alias("customer_id"),
                    (F.year("o_orderdate") < 1999).cast("int").alias("is_train"), "label")


def split_by_flag(spark, sf_dir):
    return _flagged_orders(spark, sf_dir).filter(F.col("is_train") == 1).drop("is_train")


def split_halves(spark, sf_dir):
    """Both halves of P5 with their flag; rows without a flag are in neither."""
    return _flagged_orders(spark, sf_dir).filter(F.col("is_train").isin(0, 1))


def threshold_predict(spark, sf_dir):
    p = fx.predictions(spark, sf_dir)
    return p.select("model", "row_id", (F.col("probability") >= 0.3).cast("int").alias("prediction"))


def epoch_to_ts(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders")
    e = o.select(F.col("o_orderkey").alias("row_id"),
                 F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("start_epoch"))
    return e.withColumn("cutoff_ts", F.timestamp_seconds("start_epoch").cast("timestamp_ntz"))


# ---- sources / sinks

RAW_COLUMNS = ["t.o_orderkey", "t.o_custkey", "t.o_totalprice", "o_orderdate"]


def scan_project(spark, sf_dir):
    return io.scan_project(spark, f"{sf_dir}/orders.parquet", RAW_COLUMNS)


def multi_source_union(spark, sf_dir):
    frames = {
        "customer": fx.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal"),
        "supplier": fx.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal"),
    }
    names = ["party_key", "name", "nation_key", "acct_balance"]
    return io.union_sources(frames, {k: names for k in frames})


def load_xy(spark, sf_dir):
    o = fx.order_labels(spark, sf_dir, ["o_totalprice"])
    return o.select("row_id", "user_id", "o_totalprice",
                    F.month("o_orderdate").alias("order_month"), "label")


def load_eval_users(spark, sf_dir):
    o = fx.order_labels(spark, sf_dir)
    e = o.select("user_id", F.unix_seconds(F.col("cutoff_ts").cast("timestamp")).alias("start_epoch"), "label")
    return e.select("user_id", F.timestamp_seconds("start_epoch").cast("timestamp_ntz").alias("cutoff_ts"), "label")


def _write_split(spark, sf_dir):
    return io.write_split_tables(_flagged_orders(spark, sf_dir), output_path(spark, "split"),
                                 "is_train", "label", ["row_id"])


def write_split(spark, sf_dir):
    """Write the clean table partitioned by is_train and the four split tables;
    read the clean table's train part back (the filter prunes to one partition
    folder).  ``write_split_tables`` reads all five."""
    paths = _write_split(spark, sf_dir)
    return io.read_table(spark, paths["clean"]).filter(F.col("is_train") == 1)


def write_split_tables(spark, sf_dir):
    """The five written tables as one, with their name."""
    parts = [io.read_table(spark, path).withColumn("table_name", F.lit(name))
             for name, path in _write_split(spark, sf_dir).items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _write_predictions(spark, sf_dir):
    p = fx.predictions(spark, sf_dir).select("model", "row_id", "prediction", "probability")
    return io.write_predictions(p, output_path(spark, "predictions"))


def write_predictions(spark, sf_dir):
    """Write every model's rows to a run-stamped folder; read one model's back.
    ``write_all_predictions`` reads them all."""
    back = io.read_table(spark, _write_predictions(spark, sf_dir))
    return back.filter(F.col("model") == "gbdt").select("row_id", "prediction", "probability")


def write_all_predictions(spark, sf_dir):
    return io.read_table(spark, _write_predictions(spark, sf_dir))


def write_metrics(spark, sf_dir):
    path = output_path(spark, "metrics")
    io.write_table(_binary_metrics(fx.predictions(spark, sf_dir), ["model"]), path)
    return io.read_table(spark, path)


QUERIES = {k: v for k, v in globals().items() if k in {
    "feat_division", "feat_is_not_null", "feat_row_sum", "feat_epoch", "feat_chain", "null_indicator",
    "value_indicator", "fill_constant", "fill_median", "clamp_positive_to_one", "range_to_zero",
    "whitelist_or_zero", "clip_below_zero", "clip_above_one", "flag_repair", "map_codes", "one_hot_custom",
    "label_any_zero", "rename_columns", "standardize_names", "drop_columns", "cast_features",
    "split_by_flag", "split_halves", "threshold_predict", "epoch_to_ts", "scan_project", "multi_source_union", "load_xy",
    "load_eval_users", "write_split", "write_split_tables", "write_predictions", "write_all_predictions",
    "write_metrics"}}

# ---------------------------------------------------------------- SQL twins

LI = """li AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
       l_linestatus, nullif(l_discount, 0) AS d, nullif(l_tax, 0) AS t FROM lineitem)"""


def _div(a, b):
    return (f"CASE WHEN ({a}) IS NULL OR ({b}) IS NULL THEN NULL WHEN ({b}) = 0 THEN "
            f"CASE WHEN ({a}) > 0 THEN CAST('inf' AS DOUBLE) WHEN ({a}) < 0 THEN CAST('-inf' AS DOUBLE) ELSE NULL END "
            f"ELSE CAST({a} AS DOUBLE) / ({b}) END")


def _med(c):
    return f"coalesce(CAST({c} AS DOUBLE), (SELECT median(CAST({c} AS DOUBLE)) FROM li))"


_K = "l_orderkey, l_linenumber"
_SUM_CHAIN = "coalesce(CAST(unit_price AS DOUBLE), 0.0) + coalesce(CAST(t AS DOUBLE), 0.0)"

SQL = {
    "feat_division": f"""WITH {LI} SELECT {_K}, {_div('l_extendedprice', 'l_discount')} AS price_per_discount,
        {_div('l_tax', 'l_discount')} AS tax_per_discount, {_div('l_tax - 0.04', 'l_discount')} AS gap_per_discount FROM li""",
    "feat_is_not_null": f"WITH {LI} SELECT {_K}, CAST(d IS NOT NULL AS FLOAT) AS has_discount FROM li",
    "feat_row_sum": f"""WITH {LI} SELECT {_K}, coalesce(CAST(d AS DOUBLE), 0.0) + coalesce(CAST(t AS DOUBLE), 0.0)
        + coalesce(CAST(l_quantity AS DOUBLE), 0.0) AS row_sum FROM li""",
    "feat_epoch": """SELECT event_id, epoch_us(try_cast(ts_text AS TIMESTAMP)) / 1e6 AS epoch FROM (
        SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'bad' ELSE CAST(ts AS VARCHAR) END AS ts_text FROM events)""",
    "feat_chain": f"""WITH {LI}, a AS (SELECT *, {_div('l_extendedprice', 'l_quantity')} AS unit_price FROM li),
        b AS (SELECT *, {_SUM_CHAIN} AS price_tax, CAST(t IS NOT NULL AS FLOAT) AS has_tax FROM a)
        SELECT {_K}, unit_price, price_tax, has_tax, {_div('price_tax', 'has_tax')} AS price_per_tax_flag FROM b""",
    "null_indicator": f"WITH {LI} SELECT {_K}, CAST(d IS NULL AS INTEGER) AS d_null, CAST(t IS NULL AS INTEGER) AS t_null FROM li",
    "value_indicator": f"""WITH {LI} SELECT {_K}, CAST(coalesce(l_linenumber = 1, false) AS INTEGER) AS l_linenumber_1,
        CAST(coalesce(l_returnflag = 'N', false) AS INTEGER) AS l_returnflag_N FROM li""",
    "fill_constant": f"WITH {LI} SELECT {_K}, coalesce(CAST(d AS DOUBLE), 0.5) AS d, coalesce(CAST(t AS DOUBLE), -1.0) AS t FROM li",
    "fill_median": f"WITH {LI} SELECT {_K}, {_med('d')} AS d, {_med('t')} AS t FROM li",
    "clamp_positive_to_one": f"""WITH {LI} SELECT {_K}, CAST(CASE WHEN l_linenumber - 3 > 0 THEN 1
        ELSE l_linenumber - 3 END AS INTEGER) AS refund_count FROM li""",
    "range_to_zero": "SELECT p_partkey, CAST(CASE WHEN p_size > 13 OR p_size < 4 THEN 0 ELSE p_size END AS INTEGER) AS age FROM part",
    "whitelist_or_zero": """SELECT p_partkey, CAST(CASE WHEN nullif(p_size, 10) IN (6, 8) THEN nullif(p_size, 10)
        ELSE 0 END AS INTEGER) AS class_size FROM part""",
    "clip_below_zero": "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN -1.0 ELSE c_acctbal END AS c_acctbal FROM customer",
    "clip_above_one": """SELECT s_suppkey, CASE WHEN s_acctbal / 1000.0 > 1 THEN 1.0 ELSE s_acctbal / 1000.0 END AS acct_k
        FROM supplier""",
    "flag_repair": f"""WITH {LI}, f AS (SELECT {_K}, l_linenumber % 3 AS f1, CAST(l_quantity AS INTEGER) % 4 AS f2 FROM li)
        SELECT {_K}, CAST(CASE WHEN f1 > 1 THEN 0 ELSE f1 END AS INTEGER) AS f1,
               CAST(CASE WHEN f2 > 1 THEN 0 ELSE f2 END AS INTEGER) AS f2 FROM f""",
    "map_codes": f"""WITH {LI} SELECT {_K}, CASE l_linenumber """ + " ".join(
        f"WHEN {k} THEN '{v}'" for k, v in LINE_CODES.items()) + " END AS line_code FROM li",
    "one_hot_custom": f"WITH {LI} SELECT {_K}, " + ", ".join(
        f"CAST(coalesce(l_returnflag = '{c}', false) AS INTEGER) AS l_returnflag_{c}"
        for c in RETURN_FLAG_CATEGORIES) + " FROM li",
    "label_any_zero": f"""WITH {LI}, c AS (SELECT {_K}, CAST(l_returnflag = 'N' AS DOUBLE) AS c1,
        CASE WHEN l_linestatus = 'O' THEN 1.0 END AS c2, t FROM li)
        SELECT {_K}, 1.0 - coalesce(CAST(c1 AS DOUBLE), 0.0) * coalesce(CAST(c2 AS DOUBLE), 0.0)
               * coalesce(CAST(t AS DOUBLE), 0.0) AS label FROM c""",
    "rename_columns": "SELECT " + ", ".join(
        f"{a} AS {b}" for a, b in zip(["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                        "o_orderdate", "o_orderpriority"], ORDER_NAMES)) + " FROM orders",
    "standardize_names": """SELECT o_orderkey AS order_key, o_custkey AS order_key_1, o_totalprice AS total_price,
        o_totalprice AS total_price_1, o_orderstatus AS status FROM orders""",
    "drop_columns": "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders",
    "cast_features": "SELECT c_custkey, CAST(c_nationkey AS FLOAT) AS c_nationkey, CAST(c_acctbal AS FLOAT) AS c_acctbal FROM customer",
    "split_by_flag": f"""WITH {fx.predictions_sql()} SELECT row_id, o_custkey AS customer_id, label FROM base
        WHERE year(o_orderdate) < 1999""",
    "threshold_predict": f"""WITH {fx.predictions_sql()} SELECT model, row_id,
        CAST(CASE WHEN probability >= 0.3 THEN 1 ELSE 0 END AS INTEGER) AS prediction FROM pred""",
    "epoch_to_ts": """SELECT o_orderkey AS row_id, CAST(epoch_us(o_orderdate) // 1000000 AS BIGINT) AS start_epoch,
        make_timestamp(CAST(epoch_us(o_orderdate) // 1000000 AS BIGINT) * 1000000) AS cutoff_ts FROM orders""",
    "scan_project": "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders",
    "multi_source_union": """SELECT c_custkey AS party_key, c_name AS name, c_nationkey AS nation_key,
        c_acctbal AS acct_balance, 'customer' AS source FROM customer
        UNION ALL SELECT s_suppkey, s_name, s_nationkey, s_acctbal, 'supplier' FROM supplier""",
    "load_xy": f"""WITH {fx.predictions_sql()} SELECT b.row_id, b.user_id, o.o_totalprice,
        CAST(month(b.o_orderdate) AS INTEGER) AS order_month, b.label FROM base b JOIN orders o ON o.o_orderkey = b.row_id""",
    "load_eval_users": f"""WITH {fx.predictions_sql()} SELECT user_id,
        make_timestamp(CAST(epoch_us(cutoff_ts) // 1000000 AS BIGINT) * 1000000) AS cutoff_ts, label FROM base""",
}


# ---- the whole dataset build and its streaming form

def dataset_build(spark, sf_dir):
    """orders + customer profile as raw student rows through the full build."""
    from tabsmith.plans.dataset_build import BuildConfig, build
    o = fx.table(spark, sf_dir, "orders")
    c = fx.table(spark, sf_dir, "customer")
    raw = o.join(c, o.o_custkey == c.c_custkey, "left").select(
        F.col("o_orderkey").alias("row_id"), F.year("o_orderdate").alias("source"),
        F.col("o_custkey").alias("user id"), F.col("o_orderdate").cast("string").alias("start_text"),
        F.col("o_totalprice"), F.nullif(F.round(F.col("c_acctbal") / 100), F.lit(0.0)).alias("refund count"),
        (F.pmod(F.col("o_orderkey"), F.lit(15))).cast("double").alias("age"),
        (F.pmod(F.col("o_custkey"), F.lit(10))).cast("double").alias("class_size"),
        (F.col("o_orderstatus") == "F").cast("double").alias("attended_1"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.lit(1.0)).alias("attended_2"),
        F.col("c_mktsegment"), F.pmod(F.col("o_custkey"), F.lit(4)).alias("channel_code"))
    cfg = BuildConfig(
        n_buckets=4, sample_frac=0.8, label_columns=["attended_1", "attended_2"],
        rename={"user id": "user_id", "refund count": "refund_count"},
        new_features=[{"calculation_type": "datetime_to_timestamp", "cols": ["start_text"], "new_col": "start_epoch"},
                      {"calculation_type": "division", "cols": ["o_totalprice", "class_size"], "new_col": "price_per_seat"},
                      {"calculation_type": "is_not_null", "cols": ["refund_count"], "new_col": "has_refund"}],
        null_indicators={"refund_count": "null", "class_size": 6},
        fill_values={"refund_count": "中位数", "price_per_seat": 0.0},
        clamp_positive=["refund_count"], range_to_zero={"age": (4, 13)}, whitelist_or_zero={"class_size": [6, 8]},
        unusual={"price_per_seat": "greater_than_one"},
        mapping_dict={"channel_code": {0: "app", 1: "web", 2: "phone"}},
        categories_dict={"channel_code": ["app", "web", "phone"], "c_mktsegment": ["BUILDING", "MACHINERY"]},
        columns_to_drop=["start_text", "attended_1", "attended_2"], keys=["user_id", "is_train", "label"])
    return build(raw, cfg)


def feature_stream(spark, sf_dir):
    """The stateless feature chain applied to ``lineitem`` read as a stream."""
    from tabsmith.streaming.stateless import run_stream
    schema = spark.read.parquet(f"{sf_dir}/lineitem.parquet").schema

    def tf(df):
        x = df.select(*LI_KEYS, "l_quantity", "l_extendedprice", "l_tax", "l_returnflag",
                      F.nullif(F.col("l_tax"), F.lit(0.0)).alias("t"))
        x = ft.derive(x, CHAIN)
        x = ft.indicators(x, {"t": "null"})
        return ft.one_hot(x, {"l_returnflag": RETURN_FLAG_CATEGORIES})
    return run_stream(spark, sf_dir, schema, tf, glob="lineitem.parquet")


QUERIES["dataset_build"] = dataset_build
QUERIES["feature_stream"] = feature_stream


def _dataset_build_sql() -> str:
    h = lambda tag: f"md5(CAST(row_id AS VARCHAR) || '|{tag}')"
    floats = ["o_totalprice", "refund_count", "age", "class_size", "start_epoch", "price_per_seat", "has_refund",
              "refund_count_null", "class_size_6"]
    return f"""WITH raw AS (
    SELECT o.o_orderkey AS row_id, CAST(year(o.o_orderdate) AS INTEGER) AS source, o.o_custkey AS user_id,
           CAST(o.o_orderdate AS VARCHAR) AS start_text, o.o_totalprice,
           nullif(round(c.c_acctbal / 100), 0.0) AS refund_count, CAST(o.o_orderkey % 15 AS DOUBLE) AS age,
           CAST(o.o_custkey % 10 AS DOUBLE) AS class_size, CAST(o.o_orderstatus = 'F' AS DOUBLE) AS a1,
           CASE WHEN o.o_orderpriority <> '5-LOW' THEN 1.0 END AS a2, c.c_mktsegment, o.o_custkey % 4 AS channel_code
    FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey),
  x AS (SELECT *, ('0x' || substr({h('bucket')}, 1, 8))::BIGINT % 4 AS bucket,
           1.0 - coalesce(CAST(a1 AS DOUBLE), 0.0) * coalesce(CAST(a2 AS DOUBLE), 0.0) AS label FROM raw),
  r1 AS (SELECT *, row_number() OVER (PARTITION BY source, bucket ORDER BY {h(fx.SEED)}, row_id) AS rk,
           count(*) OVER (PARTITION BY source, bucket) AS n FROM x),
  s AS (SELECT * FROM r1 WHERE rk <= CAST(round_even(CAST(0.8 AS DOUBLE) * n, 0) AS BIGINT)),
  u AS (SELECT * FROM r1 WHERE rk > CAST(round_even(CAST(0.8 AS DOUBLE) * n, 0) AS BIGINT)),
  cc AS (SELECT source, label, count(*) AS n_c FROM s GROUP BY source, label),
  q1 AS (SELECT *, CAST(ceil(CAST(0.3 AS DOUBLE) * sum(n_c) OVER (PARTITION BY source)) AS BIGINT) AS t,
           sum(n_c) OVER (PARTITION BY source) AS nn FROM cc),
  q2 AS (SELECT *, (t * n_c) // nn AS base, (t * n_c) % nn AS rem FROM q1),
  q3 AS (SELECT *, t - sum(base) OVER (PARTITION BY source) AS lft,
           row_number() OVER (PARTITION BY source ORDER BY rem DESC, label) AS rr FROM q2),
  q AS (SELECT source, label, base + CASE WHEN rr <= lft THEN 1 ELSE 0 END AS quota FROM q3),
  r3 AS (SELECT *, row_number() OVER (PARTITION BY source, label ORDER BY {h(f"{fx.SEED}|split")}, row_id) AS rk3 FROM s),
  split AS (SELECT r3.*, CAST(CASE WHEN rk3 <= q.quota THEN 0 ELSE 1 END AS INTEGER) AS is_train
           FROM r3 JOIN q ON r3.source = q.source AND r3.label = q.label),
  tc AS (SELECT source, label, count(*) AS c FROM split WHERE is_train = 1 GROUP BY source, label),
  tr AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY c, label) AS a,
           row_number() OVER (PARTITION BY source ORDER BY c DESC, label) AS b FROM tc),
  bal AS (SELECT source, max(CASE WHEN a = 1 THEN label END) AS minority_class, max(c) - min(c) AS gap
           FROM tr GROUP BY source),
  pool AS (SELECT u.*, bal.gap FROM u JOIN bal ON u.source = bal.source AND u.label = bal.minority_class
           WHERE bal.gap > 0),
  rp AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY {h(f"{fx.SEED}|topup")}, row_id) AS rk5 FROM pool),
  rows_ AS (SELECT row_id, source, user_id, start_text, o_totalprice, refund_count, age, class_size, c_mktsegment,
                   channel_code, label, is_train FROM split
           UNION ALL SELECT row_id, source, user_id, start_text, o_totalprice, refund_count, age, class_size,
                   c_mktsegment, channel_code, label, CAST(1 AS INTEGER) FROM rp WHERE rk5 <= gap),
  d AS (SELECT *, epoch_us(try_cast(start_text AS TIMESTAMP)) / 1e6 AS start_epoch,
           {_div('o_totalprice', 'class_size')} AS price_per_seat,
           CAST(refund_count IS NOT NULL AS FLOAT) AS has_refund,
           CAST(refund_count IS NULL AS INTEGER) AS refund_count_null,
           CAST(coalesce(class_size = 6, false) AS INTEGER) AS class_size_6 FROM rows_),
  f AS (SELECT * REPLACE (coalesce(CAST(refund_count AS DOUBLE), (SELECT median(CAST(refund_count AS DOUBLE)) FROM rows_))
           AS refund_count, coalesce(CAST(price_per_seat AS DOUBLE), 0.0) AS price_per_seat) FROM d),
  c AS (SELECT * REPLACE (CASE WHEN refund_count > 0 THEN 1.0 ELSE refund_count END AS refund_count,
           CASE WHEN age > 13 OR age < 4 THEN 0.0 ELSE age END AS age,
           CASE WHEN class_size IN (6, 8) THEN class_size ELSE 0.0 END AS class_size,
           CASE WHEN price_per_seat > 1 THEN 1.0 ELSE price_per_seat END AS price_per_seat) FROM f),
  m AS (SELECT *, CASE channel_code WHEN 0 THEN 'app' WHEN 1 THEN 'web' WHEN 2 THEN 'phone' END AS ch FROM c)
  SELECT row_id, source, user_id, label, is_train, """ + ", ".join(
        [f"CAST({c} AS FLOAT) AS {c}" for c in floats[:9]] +
        [f"CAST(CAST(coalesce(ch = '{v}', false) AS INTEGER) AS FLOAT) AS channel_code_{v}"
         for v in ("app", "web", "phone")] +
        [f"CAST(CAST(coalesce(c_mktsegment = '{v}', false) AS INTEGER) AS FLOAT) AS c_mktsegment_{v}"
         for v in ("BUILDING", "MACHINERY")]) + " FROM m"


SQL["dataset_build"] = _dataset_build_sql()


def _sql_twins_for_sinks():
    from tabsmith.plans.cases_eval import SQL as EVAL_SQL
    pred = fx.predictions_sql()
    chain = f"""WITH {LI}, a AS (SELECT *, {_div('l_extendedprice', 'l_quantity')} AS unit_price FROM li),
        b AS (SELECT *, {_SUM_CHAIN} AS price_tax, CAST(t IS NOT NULL AS FLOAT) AS has_tax FROM a)
        SELECT {_K}, l_quantity, l_extendedprice, l_tax, t, unit_price, price_tax, has_tax,
               {_div('price_tax', 'has_tax')} AS price_per_tax_flag, CAST(t IS NULL AS INTEGER) AS t_null, """ + \
        ", ".join(f"CAST(coalesce(l_returnflag = '{c}', false) AS INTEGER) AS l_returnflag_{c}"
                  for c in RETURN_FLAG_CATEGORIES) + " FROM b"
    return {
        "write_split": f"""WITH {pred} SELECT row_id, o_custkey AS customer_id, label, CAST(1 AS INTEGER) AS is_train
            FROM base WHERE year(o_orderdate) < 1999""",
        "write_predictions": f"WITH {pred} SELECT row_id, prediction, probability FROM pred WHERE model = 'gbdt'",
        "split_halves": f"""WITH {pred} SELECT row_id, o_custkey AS customer_id, label,
            CAST(year(o_orderdate) < 1999 AS INTEGER) AS is_train FROM base WHERE o_orderdate IS NOT NULL""",
        "write_split_tables": f"""WITH {pred}, c AS (SELECT row_id, o_custkey AS customer_id, label,
            CAST(year(o_orderdate) < 1999 AS INTEGER) AS is_train FROM base)
            SELECT 'clean' AS table_name, row_id, customer_id, label, is_train FROM c
            UNION ALL SELECT 'X_train', row_id, customer_id, NULL, is_train FROM c WHERE is_train = 1
            UNION ALL SELECT 'X_test', row_id, customer_id, NULL, is_train FROM c WHERE is_train = 0
            UNION ALL SELECT 'y_train', row_id, NULL, label, NULL FROM c WHERE is_train = 1
            UNION ALL SELECT 'y_test', row_id, NULL, label, NULL FROM c WHERE is_train = 0""",
        "write_all_predictions": f"WITH {pred} SELECT model, row_id, prediction, probability FROM pred",
        "write_metrics": EVAL_SQL["binary_metrics"],
        "feature_stream": chain,
    }


SQL.update(_sql_twins_for_sinks())
