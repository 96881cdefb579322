"""A training corpus from `documents`: refuse, dedupe, redact, mix and pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are written as Parquet and reread as the docs
of the next one. All but the last return the columns of docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketlens.llm import divergence, mixing, packing, pii, simhash
from basketlens.llm.queries import TOKENIZER
from basketlens.session import staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return divergence.drop_low_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pieces_digest(packing.pack(docs, TOKENIZER))


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_dedup),
    ("personal data", redact_pii),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

#: The tokenizer and the fingerprints are not SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the whole `documents` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
