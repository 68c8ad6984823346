"""Corpus pipeline: toxicity, exact dedup, MinHash near-dedup, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept; all but the
last return the columns of ``documents``, whatever others there are and whatever their names. Learning from labels
makes the first stage inexpressible in SQL, so there is no oracle; the tests compare the run with the operators stage by
stage, and each operator's own tests with plain computations.

In every stage null text counts as empty, texts of any length are read whole, each of repeated rows is judged as the others,
and an empty table gives an empty table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from taxaspark.llm import decontaminate, exact_dedup, mixing, near_dedup, toxicity
from taxaspark.llm.common import read, shared_dir


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the class-conditional models reject go. Null and empty texts stay; equal texts go or stay together; without usable labels none goes."""
    return toxicity.drop_toxic(docs, read(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each normalised text stays, the one with the smallest doc_id; null ids come last, and of rows with one id and text one stays. Null, empty and blank texts are one text."""
    return exact_dedup.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays, the one with the smallest doc_id. Rows without an id or without words stay."""
    return near_dedup.drop_near_copies(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go. Null and empty texts hold none; null items and items without a word are skipped."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining document with the words that the mix takes of it. Null and empty texts have size 0 and give none; null sources are a source of their own, the last."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written to the shared folder and reread."""
    docs = read(spark, sf_dir, "documents")
    home = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{home}/{k}-{name}")
            docs = spark.read.parquet(f"{home}/{k}-{name}")
    return docs


#: The first stage learns from labels, which SQL can't express.
ORACLE_SQL = None
