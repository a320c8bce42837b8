"""Queries of the training-text operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, edit_fingerprint, html_text, packing, quality, quality_rules, secret_scan, simhash, toxicity, url_filter
from ._common import table


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digest(table(spark, sf_dir, "documents"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.bpe_digest(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_digest(table(spark, sf_dir, "documents"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_verdicts(table(spark, sf_dir, "pages"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge_quality(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))


def op9_edit_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_fingerprint.edited_digest(table(spark, sf_dir, "documents"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.page_texts(table(spark, sf_dir, "pages"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_secret_scan, op2_byte_bpe, op3_simhash, op4_url_filter, op5_toxicity,
            op6_quality, op7_quality_rules, op8_packing, op9_edit_fingerprint, op10_html_text,
        )
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_url_filter": url_filter.ORACLE}
