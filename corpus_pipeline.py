"""The corpus pipeline: stages over documents, each written as Parquet and reread by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corvane.llm import common, jaccard_join, language_id, packing, radix_dedup, secret_scan


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language stay; texts that are null or without a letter and undecided ones go.

    Where no document has a language, nothing can be learned and all go. Equal rows, ties, very long texts, empty tables and
    clashing names: as ``language_id.known_language`` states.
    """
    return language_id.known_language(spark, docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays, the one with the largest id; a null text equals an empty one.

    Equal rows, null ids, very long texts, empty tables and clashing names: as ``radix_dedup.dedup`` states.
    """
    return radix_dedup.dedup(spark, docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones stays; two link that share 0.8 of their 5-word shingles.

    Texts without a word are linked with nothing and stay. Null and repeated ids, ties, very long texts, empty tables
    and clashing names: as ``jaccard_join.first_of_each`` states.
    """
    return jaccard_join.first_of_each(spark, docs, percent=80, width=5)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay, null and empty texts and repeated rows too; secrets in them are replaced.

    Overlapping spans, very long texts, empty tables and clashing names: as ``secret_scan.redact`` states.
    """
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a packed sequence; a null or empty text is its end token alone.

    Null sources and ids, ties, very long texts, empty tables and clashing names: as ``packing.pack`` states.
    """
    return packing.pack(spark, docs)


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", exact_dedup),
    ("jaccard_join", near_dedup),
    ("secret_scan", secrets),
    ("packing", pack),
]

#: Tokens, language models and links have no SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table. A stage's table is deleted when the next one has read it."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs, path = common.stored(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
        if last:
            common.remove(spark, last)
        last = path
    out = STAGES[-1][1](spark, docs, sf_dir)  # it has tokens of its own by now
    common.remove(spark, last)
    return out
