"""All registered checks: key -> Spark callable, key -> SQL twin."""

from __future__ import annotations

import importlib

_MODULES = [
    "tabsmith.plans.cases_eval",
    "tabsmith.plans.cases_features",
    "tabsmith.plans.cases_sampling",
    "tabsmith.plans.cases_documented",
    "tabsmith.plans.cases_models",
    "tabsmith.plans.cases_tuning",
    "tabsmith.plans.cases_library",
]


def _load():
    queries, sql = {}, {}
    for name in _MODULES:
        mod = importlib.import_module(name)
        for k, fn in mod.QUERIES.items():
            if k in queries:
                raise ValueError(f"duplicate key {k}")
            queries[k] = fn
        sql.update(getattr(mod, "SQL", {}))
    missing = set(sql) - set(queries)
    if missing:
        raise ValueError(f"SQL without query: {sorted(missing)}")
    return queries, sql


def queries():
    return _load()[0]


def oracle_sql():
    return _load()[1]
