"""Deterministic hash keys used for sampling, splitting and folds.

A row's position in a shuffled order is the md5 of its key and a salt.  The
same string function exists in SQL engines, so the order is reproducible
across engines and independent of partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = float(2 ** 32)


def hash_hex(keys: Sequence[str] | str, salt) -> Column:
    """md5 hex of ``key1|key2|...|salt`` (keys rendered as strings)."""
    if isinstance(keys, str):
        keys = [keys]
    parts = [F.col(k).cast("string") for k in keys] + [F.lit(str(salt))]
    return F.md5(F.concat_ws("|", *parts))


def hash_unit(hex_col: Column) -> Column:
    """Map an md5 hex string to [0, 1), monotone in the string order."""
    return F.conv(F.substring(hex_col, 1, 8), 16, 10).cast("double") / F.lit(TWO_32)
