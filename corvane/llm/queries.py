"""Queries of the training-data operators over the driver's tables, with their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe_lexicon, html_text, jaccard_join, language_id, packing, radix_dedup, rule_ledger, secret_scan, sstable, token_counts


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, _table(spark, sf_dir, "documents"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(spark, _table(spark, sf_dir, "documents"))


def op3_token_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sstable.token_tables(spark, _table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(spark, _table(spark, sf_dir, "documents"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_components(spark, _table(spark, sf_dir, "documents"))


def op6_bpe_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_lexicon.round_trip(spark, _table(spark, sf_dir, "documents"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(spark, _table(spark, sf_dir, "pages"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return radix_dedup.radix_groups(spark, _table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_ledger.quality(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_packing": op1_packing,
        "op2_secrets": op2_secrets,
        "op3_token_tables": op3_token_tables,
        "op4_language_id": op4_language_id,
        "op5_jaccard_join": op5_jaccard_join,
        "op6_bpe_lexicon": op6_bpe_lexicon,
        "op7_html_text": op7_html_text,
        "op8_exact_dedup": op8_exact_dedup,
        "op9_token_counts": op9_token_counts,
        "op10_quality_rules": op10_quality_rules,
    }


def oracle_sql() -> dict[str, str]:
    return {"op8_exact_dedup": radix_dedup.SQL, "op10_quality_rules": rule_ledger.SQL}
