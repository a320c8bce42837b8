"""The corpus pipeline: quality, toxicity, near-duplicates, secrets, packing.

Each stage works on all that its predecessor kept, and is written as Parquet and read again. Columns of
documents pass through unchanged, nulls too, but where a stage says otherwise; an empty table gives an
empty result. Rows of repeated ids are judged each by its own text.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidefold.llm import packing, quality, secret_scan, simhash, toxicity
from tidefold.llm._common import checkpoint_folder, table

#: No SQL expresses the classifiers' stages.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go. Null and empty texts are scored as texts without words."""
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model).where("predicted = 1").select(docs.columns)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier finds toxic go. Null and empty texts are scored as short silent texts."""
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model).where("predicted = 0").select(docs.columns)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that of the smallest id.

    Null and empty texts are one group. Rows without an id stay, and so do all rows of a repeated id that survives.
    """
    return simhash.keep_one_of_each(docs).select(docs.columns)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; the secrets found in them are replaced, and n_chars is that of the new text (null for a null text)."""
    clean = secret_scan.redact_secrets(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 2048 tokens; a null or empty text is its end token alone."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", quality_stage),
    ("toxicity", toxicity_stage),
    ("simhash_near_dedup", simhash_stage),
    ("secret_scans", secrets_stage),
    ("best_fit_packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each result is written to the shared checkpoint folder.

    A stage's folder goes once its successor is written; the last one's stays, for the result reads it.
    """
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            target = spark._jvm.org.apache.hadoop.fs.Path(before)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        before = path
    return docs
