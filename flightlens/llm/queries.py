"""Driver queries of the training-data operators, one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from flightlens.llm import (
    byte_bpe, embedding_dedup, html_text, importance_resampling, language_id, line_dedup, lm_scoring, packing,
    prefix_forest, quality_rules, simhash, spelling_variants, token_codes)
from flightlens.llm.common import read_table


#: Id that ends every document in the code files.
DOCUMENT_END = 2


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.report(read_table(spark, sf_dir, "documents"))


def op2_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_codes.round_trip(
        read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), DOCUMENT_END)


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read_table(spark, sf_dir, "pages"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"), threshold=0.93)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(read_table(spark, sf_dir, "documents"), shingle=3, radius=3)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(read_table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.report(read_table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1, capacity=4096)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_decode(
        read_table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(read_table(spark, sf_dir, "documents"))


def op12_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_forest.search(read_table(spark, sf_dir, "embeddings"), query_every=50, k=5)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance_resampling.resample(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), percent=5)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_lm_scoring": op1_lm_scoring,
        "op2_token_codes": op2_token_codes,
        "op3_html_text": op3_html_text,
        "op4_embedding_dedup": op4_embedding_dedup,
        "op5_quality_rules": op5_quality_rules,
        "op6_simhash": op6_simhash,
        "op7_line_dedup": op7_line_dedup,
        "op8_language_id": op8_language_id,
        "op9_packing": op9_packing,
        "op10_byte_bpe": op10_byte_bpe,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_prefix_forest": op12_prefix_forest,
        "op13_importance_resampling": op13_importance_resampling,
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_quality_rules": quality_rules.ORACLE_SQL, "op7_line_dedup": line_dedup.ORACLE_SQL}
