"""The registered queries of this package, with production parameters, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from mixlens.llm import (conversations, exact_dedup, html_text, language, line_dedup, merkle, mixing, neighbours, ngram_join,
                         packing, quality, substring_dedup, url_filter)
from mixlens.sources.files import read_table


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"), weights=(1, 2, 3), cap=3)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_verdicts(read_table(spark, sf_dir, "pages"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(read_table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read_table(spark, sf_dir, "embeddings"), k=20, every=20)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(read_table(spark, sf_dir, "documents"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with their length and digest."""
    out = html_text.page_texts(read_table(spark, sf_dir, "pages"))
    return out.withColumns({"n_chars": F.length("text").cast("long"), "text_sha256": F.sha2(F.col("text").cast("binary"), 256)})


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(read_table(spark, sf_dir, "documents"), words=4, percent=85)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the passages to remove, and how many words and bytes they hold."""
    out = substring_dedup.repeated_spans(read_table(spark, sf_dir, "documents")).drop("tid")

    def total(name: str):
        return F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x[name])

    return out.withColumns({"removed_spans": F.size("spans"), "removed_words": total("words"), "removed_bytes": total("end") - total("start")})


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(read_table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(read_table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.report(conversations.damaged(read_table(spark, sf_dir, "conversations")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_url_filter": op2_url_filter,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_packing": op4_packing,
    "op5_neighbours": op5_neighbours,
    "op6_language": op6_language,
    "op7_html_text": op7_html_text,
    "op8_ngram_join": op8_ngram_join,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_quality": op10_quality,
    "op11_line_dedup": op11_line_dedup,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_conversation_repair": op13_conversation_repair,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL: dict[str, str] = {
    "op1_mixing": mixing.oracle_sql(),
    "op2_url_filter": url_filter.oracle_sql(),
    "op3_exact_dedup": exact_dedup.ORACLE_SQL,
    "op11_line_dedup": line_dedup.ORACLE_SQL,
    "op12_merkle_manifest": merkle.oracle_sql(),
    "op13_conversation_repair": conversations.ORACLE_SQL,
}
