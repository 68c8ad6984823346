"""Text files as numbered lines.

A text scan keeps the order of lines within a block of a file. Lines are numbered within their
block and the blocks' line counts are summed before it, so a file of any size is numbered without
gathering it in one task; a compressed file is one block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def numbered(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, block, line_no (from 0), value of every line."""
    rows = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    rows = rows.withColumn("_k", F.monotonically_increasing_id())  # rises in scan order within a block
    within = Window.partitionBy("file", "block").orderBy("_k")
    return _onward(rows.withColumn("_own", F.row_number().over(within) - 1), F.lit(1), "line_no").drop("_own", "_k")


def _onward(rows: DataFrame, weight: Column, name: str) -> DataFrame:
    """Turn ``_own``, a count within each block, into one within each file."""
    per = rows.groupBy("file", "block").agg(F.sum(weight).alias("_n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = per.select("file", "block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return rows.join(base, ["file", "block"]).withColumn(name, F.col("_base") + F.col("_own")).drop("_base")


def running_count(lines: DataFrame, flag: Column, name: str) -> DataFrame:
    """Number of flagged lines up to and with each line of its file."""
    within = Window.partitionBy("file", "block").orderBy("line_no")
    rows = lines.withColumn("_flag", flag.cast("int")).withColumn("_own", F.sum("_flag").over(within))
    return _onward(rows, F.col("_flag"), name).drop("_own", "_flag")


def sample_of(file: Column, suffixes: str = r"(_report)?\.[A-Za-z0-9.]+$") -> Column:
    """Sample name: the file's base name without its suffix."""
    return F.regexp_replace(F.regexp_extract(file, r"([^/]+)$", 1), suffixes, "")
