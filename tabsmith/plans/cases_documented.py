"""Registered checks: scaling (Z*) and the documented attendance features (D1-D9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.operators import history as hist
from tabsmith.operators import scaling as sc
from tabsmith.operators.selection import correlations
from tabsmith.plans import fixtures as fx
from tabsmith.plans.cases_features import LI_KEYS

# ------------------------------------------------------------------ scaling


def _li(spark, sf_dir):
    return fx.table(spark, sf_dir, "lineitem").select(
        *LI_KEYS, "l_quantity", "l_extendedprice", "l_discount", "l_tax", F.lit(3.0).alias("const"))


def scale_minmax(spark, sf_dir):
    return sc.scale(_li(spark, sf_dir), {"l_quantity": "min-max变换", "const": "minmax"}, 6) \
        .select(*LI_KEYS, "l_quantity", "const")


def scale_log_standard(spark, sf_dir):
    return sc.scale(_li(spark, sf_dir), {"l_extendedprice": "log 变换+标准化"}, 6) \
        .select(*LI_KEYS, "l_extendedprice")


def scale_standard(spark, sf_dir):
    return sc.scale(_li(spark, sf_dir), {"l_tax": "标准化", "const": "standard"}, 6) \
        .select(*LI_KEYS, "l_tax", "const")


def scale_robust(spark, sf_dir):
    return sc.scale(_li(spark, sf_dir), {"l_discount": "robustscaler变换", "l_quantity": "robust"}, 6) \
        .select(*LI_KEYS, "l_discount", "l_quantity")


def scale_shift_log(spark, sf_dir):
    c = fx.table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return sc.scale(c, {"c_acctbal": "数据平移+log 变换+标准化"}, 6)


# ------------------------------------------------------- attendance features

N_COURSES = 40
WINDOW_DAYS = 30
# A small academic calendar for the date-range flags.
CALENDAR = [
    ("holiday", "2024-01-01", "2024-01-01"),
    ("holiday", "2024-01-15", "2024-01-15"),
    ("semester_start", "2024-01-08", "2024-01-12"),
    ("semester_end", "2024-01-22", "2024-01-26"),
]
CALENDAR_KINDS = ["holiday", "semester_start", "semester_end"]


def attendance(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = fx.table(spark, sf_dir, "events")
    return ev.select("event_id", "user_id", "ts", "value",
                     (F.pmod(F.col("event_id"), F.lit(N_COURSES)) + 1).alias("course_id"),
                     (F.col("event_type") != "error").cast("int").alias("attended"))


def courses(spark, sf_dir):
    p = fx.table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("course_id"),
                    (F.pmod(F.col("p_size"), F.lit(5)) + 1).alias("difficulty"))


def attendance_star_join(spark, sf_dir):
    """attendance -> student profile (customer) -> nation -> region, and -> course.

    nation and region are the fixed-size dimensions (25 and 5 rows) and are
    broadcast; the customer and course joins are left to AQE, which picks
    broadcast only from measured sizes and splits skewed keys otherwise.
    """
    a = attendance(spark, sf_dir)
    cust = fx.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), "c_mktsegment", "c_nationkey")
    nation = fx.table(spark, sf_dir, "nation")
    region = fx.table(spark, sf_dir, "region")
    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey) \
        .select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name")
    out = a.join(cust, "user_id", "left").join(F.broadcast(geo), "c_nationkey", "left") \
        .join(courses(spark, sf_dir), "course_id", "left")
    return out.select("event_id", "user_id", "course_id", "ts", "attended", "c_mktsegment",
                      "n_name", "r_name", "difficulty")


def historical_rate(spark, sf_dir):
    out = hist.historical_rate(attendance(spark, sf_dir), ["user_id"], "ts", "event_id", "attended")
    return out.select("event_id", "user_id", "prior_count", F.round("prior_rate", 6).alias("prior_rate"))


def rolling_30d(spark, sf_dir):
    # value in integer cents: sums are exact in every engine, so the check does
    # not depend on floating-point summation order
    a = attendance(spark, sf_dir).withColumn("value_cents", F.round(F.col("value") * 100).cast("long"))
    out = hist.rolling_stats_cells(a, ["user_id"], "ts", "value_cents",
                             WINDOW_DAYS * hist.DAY_SECONDS, "event_id")
    return out.select("event_id", "user_id", *[F.round(f"roll_{s}", 6).alias(f"roll_{s}")
                                               for s in ("mean", "std", "max", "min")], "roll_count")


def calendar_features(spark, sf_dir):
    a = attendance(spark, sf_dir)
    return a.select("event_id", *[e.alias(n) for n, e in hist.calendar_parts("ts").items()])


def calendar_flags(spark, sf_dir):
    cal = spark.createDataFrame(CALENDAR, "kind string, start string, end string")
    out = hist.calendar_flags(attendance(spark, sf_dir), cal, "ts", CALENDAR_KINDS)
    return out.select("event_id", *[f"is_{k}" for k in CALENDAR_KINDS])


def group_rates(spark, sf_dir):
    """Course and time-slot attendance rates: aggregate (map-side combined),
    then join the rates back on the group key."""
    a = attendance(spark, sf_dir).withColumn("slot", F.hour("ts"))
    course = a.groupBy("course_id").agg(F.avg("attended").alias("course_rate"))
    slot = a.groupBy("slot").agg(F.avg("attended").alias("slot_rate"))
    out = a.join(course, "course_id").join(F.broadcast(slot), "slot")       # 24 slots at most
    return out.select("event_id", F.round("course_rate", 6).alias("course_rate"),
                      F.round("slot_rate", 6).alias("slot_rate"))


def normalized_difficulty(spark, sf_dir):
    c = courses(spark, sf_dir)
    out = sc.scale(c.withColumn("difficulty_norm", F.col("difficulty").cast("double")),
                   {"difficulty_norm": "minmax"}, 6)
    return out.select("course_id", "difficulty", "difficulty_norm")


def interactions(spark, sf_dir):
    a = hist.historical_rate(attendance(spark, sf_dir), ["user_id"], "ts", "event_id", "attended")
    a = a.join(courses(spark, sf_dir), "course_id", "left")
    parts = hist.calendar_parts("ts")
    h, d = parts["hour"], parts["day_of_week"]
    return a.select("event_id",
                    (h * F.col("difficulty")).alias("hour_x_difficulty"),
                    (d * F.col("difficulty")).alias("dow_x_difficulty"),
                    F.round(F.col("prior_rate") * h, 6).alias("rate_x_hour"),
                    F.round(F.col("prior_rate") * d, 6).alias("rate_x_dow"))


CORR_FEATURES = ["value", "hour", "attended", "difficulty"]


def feature_correlation(spark, sf_dir):
    """All pairwise Pearson correlations in one aggregation, then unpivoted."""
    a = attendance(spark, sf_dir).join(courses(spark, sf_dir), "course_id", "left") \
        .withColumn("hour", F.hour("ts"))
    return correlations(a, CORR_FEATURES).withColumn("corr", F.round("corr", 6))


QUERIES = {
    "scale_minmax": scale_minmax,
    "scale_log_standard": scale_log_standard,
    "scale_standard": scale_standard,
    "scale_robust": scale_robust,
    "scale_shift_log": scale_shift_log,
    "attendance_star_join": attendance_star_join,
    "historical_rate": historical_rate,
    "rolling_30d": rolling_30d,
    "calendar_features": calendar_features,
    "calendar_flags": calendar_flags,
    "group_rates": group_rates,
    "normalized_difficulty": normalized_difficulty,
    "interactions": interactions,
    "feature_correlation": feature_correlation,
}

# ---------------------------------------------------------------- SQL twins

LIZ = "li AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, 3.0::DOUBLE AS const FROM lineitem)"
_K = "l_orderkey, l_linenumber"
EPS = sc.ZERO_SCALE


def _minmax(c, src="li"):
    return (f"round((CAST({c} AS DOUBLE) - (SELECT min(CAST({c} AS DOUBLE)) FROM {src})) / "
            f"(SELECT CASE WHEN abs(max(CAST({c} AS DOUBLE)) - min(CAST({c} AS DOUBLE))) < {EPS} THEN 1.0 "
            f"ELSE max(CAST({c} AS DOUBLE)) - min(CAST({c} AS DOUBLE)) END FROM {src}), 6)")


def _std(x, src):
    return (f"round(({x} - (SELECT avg({x}) FROM {src})) / "
            f"(SELECT CASE WHEN abs(stddev_pop({x})) < {EPS} THEN 1.0 ELSE stddev_pop({x}) END FROM {src}), 6)")


def _ln1p(x):
    return f"(CASE WHEN {x} > -1 THEN ln(1 + {x}) END)"


def _robust(c, src="li"):
    x = f"CAST({c} AS DOUBLE)"
    return (f"round(({x} - (SELECT quantile_cont({x}, 0.5) FROM {src})) / "
            f"(SELECT CASE WHEN abs(quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25)) < {EPS} THEN 1.0 "
            f"ELSE quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25) END FROM {src}), 6)")


ATT = f"""a AS (SELECT event_id, user_id, ts, value, event_id % {N_COURSES} + 1 AS course_id,
      CAST(event_type <> 'error' AS INTEGER) AS attended FROM events),
  crs AS (SELECT p_partkey AS course_id, p_size % 5 + 1 AS difficulty FROM part)"""

HIST = f"""{ATT},
  hr AS (SELECT *, count(*) OVER w AS prior_count, avg(CAST(attended AS DOUBLE)) OVER w AS prior_rate FROM a
         WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""

_W30 = WINDOW_DAYS * 86400 * 1_000_000
_CAL_CASES = {k: " OR ".join(f"(CAST(ts AS DATE) BETWEEN DATE '{s}' AND DATE '{e}')" for kk, s, e in CALENDAR if kk == k)
              for k in CALENDAR_KINDS}
_PAIRS = [(x, y) for i, x in enumerate(CORR_FEATURES) for y in CORR_FEATURES[i + 1:]]

SQL = {
    "scale_minmax": f"WITH {LIZ} SELECT {_K}, {_minmax('l_quantity')} AS l_quantity, {_minmax('const')} AS const FROM li",
    "scale_log_standard": f"""WITH {LIZ}, lx AS (SELECT *, {_ln1p('CAST(l_extendedprice AS DOUBLE)')} AS x FROM li)
        SELECT {_K}, {_std('x', 'lx')} AS l_extendedprice FROM lx""",
    "scale_standard": f"""WITH {LIZ} SELECT {_K}, {_std('CAST(l_tax AS DOUBLE)', 'li')} AS l_tax,
        {_std('const', 'li')} AS const FROM li""",
    "scale_robust": f"WITH {LIZ} SELECT {_K}, {_robust('l_discount')} AS l_discount, {_robust('l_quantity')} AS l_quantity FROM li",
    "scale_shift_log": f"""WITH cx AS (SELECT c_custkey, {_ln1p('(CAST(c_acctbal AS DOUBLE) + 1)')} AS x FROM customer)
        SELECT c_custkey, {_std('x', 'cx')} AS c_acctbal FROM cx""",
    "attendance_star_join": f"""WITH {ATT} SELECT a.event_id, a.user_id, a.course_id, a.ts, a.attended, c.c_mktsegment,
        n.n_name, r.r_name, crs.difficulty FROM a
        LEFT JOIN customer c ON c.c_custkey = a.user_id
        LEFT JOIN (nation n JOIN region r ON n.n_regionkey = r.r_regionkey) ON n.n_nationkey = c.c_nationkey
        LEFT JOIN crs ON crs.course_id = a.course_id""",
    "historical_rate": f"WITH {HIST} SELECT event_id, user_id, prior_count, round(prior_rate, 6) AS prior_rate FROM hr",
    "rolling_30d": f"""WITH {ATT}, ac AS (SELECT *, CAST(round(value * 100) AS BIGINT) AS v FROM a),
        r AS (SELECT event_id, user_id, avg(v) OVER w AS m, stddev_samp(v) OVER w AS s,
        CAST(max(v) OVER w AS DOUBLE) AS mx, CAST(min(v) OVER w AS DOUBLE) AS mn, count(v) OVER w AS n FROM ac
        WINDOW w AS (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN {_W30} PRECEDING AND 1 PRECEDING))
        SELECT event_id, user_id, round(m, 6) AS roll_mean, round(s, 6) AS roll_std, round(mx, 6) AS roll_max,
               round(mn, 6) AS roll_min, n AS roll_count FROM r""",
    "calendar_features": f"""WITH {ATT} SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(day(ts) AS INTEGER) AS day,
        CAST(month(ts) AS INTEGER) AS month, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
        CAST(isodow(ts) >= 6 AS INTEGER) AS is_weekend FROM a""",
    "calendar_flags": f"WITH {ATT} SELECT event_id, " + ", ".join(
        f"CAST({_CAL_CASES[k]} AS INTEGER) AS is_{k}" for k in CALENDAR_KINDS) + " FROM a",
    "group_rates": f"""WITH {ATT}, b AS (SELECT *, hour(ts) AS slot FROM a),
        cr AS (SELECT course_id, avg(attended) AS course_rate FROM b GROUP BY course_id),
        sr AS (SELECT slot, avg(attended) AS slot_rate FROM b GROUP BY slot)
        SELECT b.event_id, round(cr.course_rate, 6) AS course_rate, round(sr.slot_rate, 6) AS slot_rate
        FROM b JOIN cr USING (course_id) JOIN sr USING (slot)""",
    "normalized_difficulty": f"""WITH {ATT} SELECT course_id, difficulty, {_minmax('difficulty', 'crs')} AS difficulty_norm FROM crs""",
    "interactions": f"""WITH {HIST} SELECT hr.event_id, hour(ts) * crs.difficulty AS hour_x_difficulty,
        CAST((isodow(ts) - 1) * crs.difficulty AS BIGINT) AS dow_x_difficulty,
        round(prior_rate * hour(ts), 6) AS rate_x_hour, round(prior_rate * (isodow(ts) - 1), 6) AS rate_x_dow
        FROM hr LEFT JOIN crs USING (course_id)""",
    "feature_correlation": f"""WITH {ATT}, b AS (SELECT a.*, crs.difficulty, hour(ts) AS hour FROM a LEFT JOIN crs USING (course_id))
        """ + " UNION ALL ".join(
        f"SELECT '{x}' AS feature_a, '{y}' AS feature_b, round(corr(CAST({x} AS DOUBLE), CAST({y} AS DOUBLE)), 6) AS corr FROM b"
        for x, y in _PAIRS),
}
