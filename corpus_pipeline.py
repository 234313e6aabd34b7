"""The corpus pipeline: stages from raw documents to a training mix.

An empty table passes through every stage as one; further columns stay.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import common, decontaminate, mixing, quality_cnn, simhash, substrings


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.

    Rows that repeat stay or go together; a null text is scored as an empty one.
    """
    return quality_cnn.keep_good(docs, common.table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays.

    Texts without words, null ones among them, are one group.
    """
    return simhash.near_dedup(docs, shingle_words=3, radius=2)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated sentence spans are cut out; a document of which nothing is left goes.

    Null and empty texts stay, as do rows that repeat id and text (they are one
    document).
    """
    cut = substrings.dedup_spans(docs, counts=True)
    pieces, removed = cut.columns[-2:]
    return cut.where(F.col("text").isNull() | (F.col("text") != "") | (F.col(removed) == 0)).drop(pieces, removed)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go; null and empty texts have none."""
    return decontaminate.decontaminate(docs, common.table(spark, sf_dir, "benchmark"), remove="documents", n=10)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training mix: a row for each reading of a document, in the order of training."""
    return mixing.training_mix(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
]

#: a learned classifier decides the first stage, which SQL can't express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each result is written and read again."""
    docs = common.table(spark, sf_dir, "documents")
    folder = f"{common.shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
