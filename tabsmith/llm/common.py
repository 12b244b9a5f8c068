"""Shared pieces of the training-data operators."""

from __future__ import annotations

import ctypes
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words everywhere in this subpackage: space and U+0009-U+000D.
SPACE_CLASS = r"\x20\x09-\x0D"
WORD_PATTERN = rf"[^{SPACE_CLASS}]+"
WORD_RE = re.compile(WORD_PATTERN)
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: str.translate table that lower-cases A-Z and nothing else.
ASCII_LOWER = {ord(u): w for u, w in zip(UPPER, LOWER)}
#: bytes.translate table that does the same on UTF-8.
ASCII_LOWER_BYTES = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def release() -> None:
    """Hands back to the system what this worker has freed: Python and Arrow keep it
    otherwise, and workers go on to other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def word_count(text: Column) -> Column:
    """Number of words in the whole text; null text counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def safe(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that extra columns can never clash."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def numbered(df: DataFrame, *wanted: str) -> tuple[DataFrame, list[str]]:
    """The table with its columns called ``c0``, ``c1`` and on, so that no name of
    its own can clash with one that an operator adds, and what the wanted columns
    are called there."""
    names = df.columns
    return df.toDF(*[f"c{i}" for i in range(len(names))]), [f"c{names.index(n)}" for n in wanted]


def barrier(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that the optimizer can't copy into later expressions: what
    stands inside a lambda would otherwise be computed for every element."""
    fixed = F.struct(*[c.alias(n) for n, c in columns.items()])
    return (df.select("*", F.explode(F.array(fixed)).alias("__fixed"))
            .select("*", *[F.col(f"__fixed.`{n}`").alias(n) for n in columns]).drop("__fixed"))


def tokenizer_path() -> str:
    """The public tokenizer that the registered queries use."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def model_path() -> str:
    """The public sentence model that the registered queries use."""
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")
