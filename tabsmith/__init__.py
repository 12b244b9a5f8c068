"""tabsmith: Spark-native tabular classification data engine.

Feature derivation, deterministic hash sampling, splits, scaling, model
fitting with Spark ML, evaluation, ensembling and tuning, all expressed as
DataFrame operators.
"""

__version__ = "0.1.0"
