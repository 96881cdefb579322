"""The operators of this package over the supplied tables, and SQL for the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.llm import (
    alignment,
    backoff_lm,
    divergence,
    mixing,
    packing,
    perspectives,
    pii,
    repeats,
    simhash,
    sql,
    url_templates,
    wavelet,
    weighted_sampling,
    whitening,
)
from basketlens.session import scratch_path

#: Vocabulary files, on the driver and on every executor.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pieces_digest(packing.pack(_table(spark, sf_dir, "documents"), TOKENIZER))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(_table(spark, sf_dir, "documents"))


def op3_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = backoff_lm.scores(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", *[F.round(c, 4).alias(c) for c in ("log_score", "mean_log_score")])


def op4_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives.perspectives(_table(spark, sf_dir, "conversations"))


def op5_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "shards")
    wavelet.write_shards(_table(spark, sf_dir, "documents"), folder, TOKENIZER)
    return wavelet.documents_digest(wavelet.read_documents(spark, folder))


def op6_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = _table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels")
    # a page shows the document whose number its path ends with
    shown = F.regexp_extract(url_templates.host_and_path(F.col("url"))[1], r"([0-9]+)([.][A-Za-z]+)?/?$", 1).try_cast("bigint")
    bad = (F.col("toxic") == 1) | (F.col("quality") == 0)
    known = pages.select("page_id", shown.alias("doc_id")).join(labels.select("doc_id", bad.alias("bad")), "doc_id")
    judged = url_templates.judged_urls(pages, known.select("page_id", "bad"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "template")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op8_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.quality(_table(spark, sf_dir, "documents"))


def op9_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_sampling.fingerprints(_table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.spans_digest(pii.spans(_table(spark, sf_dir, "documents").select("doc_id", "text")))


def op11_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(_table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(_table(spark, sf_dir, "documents"), TOKENIZER, PIECES)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.by_component(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_packing,
        op2_mixing,
        op3_backoff_lm,
        op4_perspectives,
        op5_wavelet,
        op6_url_templates,
        op7_simhash,
        op8_divergence,
        op9_weighted_sampling,
        op10_pii,
        op11_repeats,
        op12_alignment,
        op13_whitening,
    )
}
SQL = {
    "op2_mixing": sql.mixing(),
    "op3_backoff_lm": sql.backoff_lm(),
    "op4_perspectives": sql.perspectives(),
    "op6_url_templates": sql.url_templates(),
    "op8_divergence": sql.divergence(),
}
