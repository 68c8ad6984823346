"""The operators' queries over the driver's tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from taxaspark.llm import decontaminate, exact_dedup, hard_negatives, html_extract, language_crf, mixing, near_dedup, pii, quality_cnn, source_divergence, toxicity, url_filter, warc_bundles
from taxaspark.llm.common import read


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read(spark, sf_dir, "pages"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read(spark, sf_dir, "pages"), url_filter.fit(url_filter.labelled_urls(spark)))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(read(spark, sf_dir, "documents"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(read(spark, sf_dir, "documents"))


def op6_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_bundles.archive(spark, read(spark, sf_dir, "pages")).drop("html")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace(read(spark, sf_dir, "documents"))


def op9_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return language_crf.identify(docs, language_crf.fit(docs))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(read(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(hard_negatives.quantised(read(spark, sf_dir, "embeddings")))


def op13_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality_cnn.score(docs, quality_cnn.fit(docs, read(spark, sf_dir, "labels")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return {"op4_exact_dedup": exact_dedup.ORACLE_SQL, "op7_mixing": mixing.ORACLE_SQL, "op11_source_divergence": source_divergence.ORACLE_SQL, "op12_hard_negatives": hard_negatives.ORACLE_SQL}
