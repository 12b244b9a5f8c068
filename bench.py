"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is run once to warm up, then 3 times; the median wall time is
reported.  Every run is forced end to end with the ``noop`` sink (no
collect).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tabsmith.operators import metrics as met  # noqa: E402
from tabsmith.operators import models as md  # noqa: E402
from tabsmith.plans import cases_documented as cd  # noqa: E402
from tabsmith.plans import cases_eval as ce  # noqa: E402
from tabsmith.plans import cases_features as cf  # noqa: E402
from tabsmith.plans import cases_models as cm  # noqa: E402
from tabsmith.plans import cases_sampling as cs  # noqa: E402
from tabsmith.plans import scoring  # noqa: E402
from tabsmith.session import get_spark, output_path  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def _sf(path: str) -> str:
    name = os.path.basename(path)
    return name[2:] if name.startswith("sf") else name


def feature_build(spark, d):
    """Derive chain, indicators, median fill, one-hot over lineitem."""
    from tabsmith.operators import features as ft
    li = cf.lineitem(spark, d)
    x = ft.derive(li, cf.CHAIN)
    x = ft.indicators(x, {"d": "null", "t": "null", "l_returnflag": "N"})
    x = ft.fill_missing(x, {"d": "中位数", "t": 0.0})
    x = ft.unusual_values(x, {"unit_price": "less_than_zero"})
    return ft.one_hot(x, {"l_returnflag": cf.RETURN_FLAG_CATEGORIES})


_PREPARED = {}


def _prepared(spark, d):
    if d not in _PREPARED:
        from tabsmith.session import materialize
        train, test = cm._train_test(spark, d)
        _PREPARED[d] = (materialize(train, "bench-train"), materialize(test, "bench-test"))
    return _PREPARED[d]


def make_batch_score(spark, d, model_type="logistic_reg", scaling=True):
    """Load the saved scorer, score the prepared test rows, evaluate (the
    fit and the test-set preparation happen before timing, as in the
    reference's report: load model + predict + metrics per model)."""
    from tabsmith.operators import scaling as sc
    train, test = _prepared(spark, d)
    stats = sc.fit_scaling(train, cm.SCALING) if scaling else {}
    fm = md.fit_model(sc.apply_scaling(train, stats) if stats else train, cm.FEATURES, model_type,
                      cm.CONFIGS[model_type])
    path = output_path(spark, f"bench-scorer-{model_type}")
    scoring.make_scorer(fm, stats, 0.5).save(spark, path)

    def q(spark, d):
        scored = scoring.BatchScorer.load(spark, path).score(test, id_col="row_id", keep=["label"])
        return met.evaluate(scored, with_stats=True)
    return q


def main():
    spark = get_spark(f"local[{CPUS}]", app="tabsmith-bench",
                      shuffle_partitions=int(CPUS) * 2)
    queries = {
        "report_leaderboard": ce.leaderboard,
        "ensemble_vote_metrics": lambda s, d: met.evaluate(ce._voted(s, d)),
        "binary_metrics": ce.binary_metrics,
        "roc_auc": ce.roc_auc,
        "prediction_stats": ce.prediction_stats,
        "cv_summary": ce.cv_summary,
        "train_test_union": cs.train_test_union,
        "feature_build": feature_build,
        "scale_robust": cd.scale_robust,
        "star_join": cd.attendance_star_join,
        "historical_rate": cd.historical_rate,
        "rolling_30d": cd.rolling_30d,
        "batch_score": make_batch_score(spark, SF_DIR),
        "score_decision_tree": make_batch_score(spark, SF_DIR, "decision_tree", scaling=False),
        "score_random_forest": make_batch_score(spark, SF_DIR, "random_forest", scaling=False),
        "score_gbdt": make_batch_score(spark, SF_DIR, "gbdt", scaling=False),
    }
    times = {}
    for name, fn in queries.items():
        runs = []
        for i in range(RUNS + 1):
            t0 = time.perf_counter()
            fn(spark, SF_DIR).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i:
                runs.append(dt)
        times[name] = round(statistics.median(runs), 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_median_sec", "value": total, "unit": "sec",
                      "queries": times, "sf": _sf(SF_DIR), "cpus": int(CPUS), "runs": RUNS}))
    spark.stop()


if __name__ == "__main__":
    main()
