"""Column-name mappings (pure Python over names; applied with one select)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TABLE_PREFIX = "t."


def strip_table_prefix(name: str, prefix: str = TABLE_PREFIX) -> str:
    return name[len(prefix):] if name.startswith(prefix) else name


def standardized_names(names: Sequence[str]) -> list[str]:
    """Spaces become underscores; a name already taken gets ``_1``, ``_2``..."""
    out: list[str] = []
    taken: set[str] = set()
    for name in names:
        new = name.replace(" ", "_")
        if new in taken:
            i = 1
            while f"{new}_{i}" in taken:
                i += 1
            new = f"{new}_{i}"
        taken.add(new)
        out.append(new)
    return out


def rename_by_map(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename by name (never by position); unknown source names are errors."""
    missing = [k for k in mapping if k not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.select(*[F.col(f"`{c}`").alias(mapping.get(c, c)) for c in df.columns])


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Positional rename with an arity check."""
    if len(names) != len(df.columns):
        raise ValueError(f"expected {len(df.columns)} names, got {len(names)}")
    return df.toDF(*names)


def standardize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*standardized_names(df.columns))
