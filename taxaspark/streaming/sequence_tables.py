"""The sequence table over samples that arrive one after the other.

A chimera is flagged within its sample, and totals and votes are sums, so a sample is worked on once, when it arrives. Its rows
go to a folder of their micro-batch, which a repeated batch writes anew; the table is made from these folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from taxaspark.operators import reads

SCHEMA = "sample string, seq string, n long"


def start(spark: SparkSession, folder: str, state: str, checkpoint: str, min_fold: float = 4, files: int = 100) -> StreamingQuery:
    """Stream over Parquet files of counts (sample, seq, n) in ``folder``; a sample comes whole in one file. Ends when all files were read."""

    def keep(batch: DataFrame, number: int) -> None:
        counts = batch.groupBy("sample", "seq").agg(F.sum("n").alias("n"))
        short = counts.where(F.length("seq") < 4).withColumn("flag", F.lit(None).cast("int"))
        reads.flagged_in_samples(counts, min_fold).unionByName(short.select("sample", "seq", "n", "flag")).write.mode("overwrite").parquet(f"{state}/batch={number}")

    arriving = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files).parquet(folder)
    return arriving.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def table(spark: SparkSession, state: str, min_fraction: float = 0.9, ignore_negatives: int = 1) -> DataFrame:
    """(asv_no, asv_id, seq, total) of all samples so far, chimeras left out: what the batch run gives, in whatever order samples came."""
    rows = spark.read.schema("sample string, seq string, n long, flag int").parquet(state)
    bad = reads.consensus(rows, min_fraction, ignore_negatives).where("is_bimera").select("seq")
    return reads.sequence_table(rows.join(bad, "seq", "left_anti"))
