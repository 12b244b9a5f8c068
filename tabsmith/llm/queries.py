"""Registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.session import prepare

from . import (op1_license, op2_line_crf, op3_decontaminate, op4_chat, op5_token_files, op6_jaccard_join, op7_mix, op8_url_filter,
               op9_html, op10_neighbours, op11_hard_negatives, op12_alignment, op13_token_counts)
from .common import model_path, read_table, tokenizer_path


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return op1_license.scan_licenses(read_table(spark, sf_dir, "documents"))


def op2_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = read_table(spark, sf_dir, "documents")
    model = op2_line_crf.fit(docs, read_table(spark, sf_dir, "labels"))
    return op2_line_crf.score(docs, model)


def op3_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return op3_decontaminate.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    rows = read_table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    added = spark.createDataFrame([(-1, 0, "user", op4_chat.PLANTED), (-1, 1, "assistant", op4_chat.PLANTED)],
                                  "conv_id long, turn long, role string, text string")
    messages = rows.unionByName(added).withColumn("parts", op4_chat.text_part(F.col("text")))
    return op4_chat.digest(op4_chat.format_conversations(messages))


def op5_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    manifest = op5_token_files.write_token_files(read_table(spark, sf_dir, "documents"), tokenizer_path())
    return op5_token_files.read_token_files(manifest)


def op6_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return op6_jaccard_join.jaccard_join(read_table(spark, sf_dir, "documents"))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return op7_mix.mix(read_table(spark, sf_dir, "documents"))


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    listed = spark.createDataFrame([(h,) for h in op8_url_filter.QUERY_LISTED], "host string")
    return op8_url_filter.filter_urls(read_table(spark, sf_dir, "pages"), op8_url_filter.QUERY_RULES,
                                      listed, keep=["page_id"])


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    pages = read_table(spark, sf_dir, "pages")
    return op9_html.extract_pages(pages, op9_html.fit(pages))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return op10_neighbours.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    moved = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return op11_hard_negatives.mine(read_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, moved)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return op12_alignment.align(read_table(spark, sf_dir, "documents"), tokenizer_path(), model_path())


def op13_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return op13_token_counts.count_tokens(read_table(spark, sf_dir, "documents"), model_path())


QUERIES = (op1_license_scan, op2_line_quality, op3_benchmark_leaks, op4_chat_format, op5_token_frames, op6_jaccard_components, op7_mix_sources, op8_url_rules, op9_main_text,
           op10_nearest, op11_negatives, op12_token_alignment, op13_counts)
SQL = {
    "op1_license_scan": op1_license.ORACLE_SQL,
    "op4_chat_format": op4_chat.ORACLE_SQL,
    "op7_mix_sources": op7_mix.ORACLE_SQL,
    "op8_url_rules": op8_url_filter.ORACLE_SQL,
    "op10_nearest": op10_neighbours.ORACLE_SQL,
    "op11_negatives": op11_hard_negatives.ORACLE_SQL,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
