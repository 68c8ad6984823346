"""Named queries over the driver's tables, each with an equivalent SQL text where SQL has one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaspark.functions import counts as fn
from taxaspark.operators import taxonomy, tree
from taxaspark.plans import bindings, queries as _queries, sequence_queries as _sequence_queries  # noqa: F401


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which taxa survive, per sample: tree, evidence gate, depth-scaled threshold, re-estimation, taxon filter."""
    linked = bindings.linked(spark, sf_dir)
    marked = tree.mark(linked, "S", min_distinct=5, min_reads=2)
    gate = tree.gated(marked, tree.credits(marked))
    floor = tree.total_classified(gate).select("sample", fn.depth_threshold(F.col("classified"), 0.002, 2).alias("threshold"))
    found = taxonomy.reestimate(gate, "S", floor)
    named = found.join(bindings.lineages(spark, sf_dir).withColumn("taxid", F.concat(F.lit("s"), F.col("s_suppkey").cast("string"))), "taxid")
    return taxonomy.keep_discard(named, F.col("lineage"), None, ["k__AFRICA"]).select("sample", "taxid", "lineage", "own", F.round("estimate", 6).alias("estimate"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_queries.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_queries.ORACLES)
