"""The corpus pipeline: quality, near copies, benchmark leaks, mix, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which the runner
writes as Parquet and reads again as the next stage's ``docs``.  All but the last
return the columns of ``documents``; the last one returns what it reads back
from the token files it wrote.

Defined cases: those of the operators; a document that the mix takes in several
passes is a row per pass, and the row at which a source's budget ends holds the
words that it still takes; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tabsmith.llm import (op2_line_crf, op3_decontaminate, op5_token_files, op6_jaccard_join,
                          op7_mix)
from tabsmith.llm.common import read_table, tokenizer_path
from tabsmith.session import discard, output_path, prepare, scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier accepts stay."""
    prepare(spark)
    model = op2_line_crf.fit(docs, read_table(spark, sf_dir, "labels"))
    return op2_line_crf.keep_good(docs, model)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the smallest id."""
    prepare(spark)
    return op6_jaccard_join.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go."""
    prepare(spark)
    return op3_decontaminate.drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by weight: a row for each pass that takes a document."""
    prepare(spark)
    return op7_mix.apply_mix(docs, length_col="n_chars")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in order of id, read back."""
    prepare(spark)
    return op5_token_files.read_token_files(op5_token_files.write_token_files(docs, tokenizer_path()))


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("tokens", tokens),
]

#: Stages 1, 3 and 5 can't be said in SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the whole of ``documents``.  What a
    stage wrote on its way goes when it is over, and its result when the next one
    has been written."""
    prepare(spark)
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = output_path(spark, f"stage-{name}")
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            discard(spark, before)
        docs, before = spark.read.parquet(path), path
    out = STAGES[-1][1](spark, docs, sf_dir)
    discard(spark, before)          # the token files hold all that is left to read
    return out
