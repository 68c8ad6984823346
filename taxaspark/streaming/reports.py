"""Reports that arrive one by one: the evidence gate as a file stream.

The gate looks at one sample at a time, so each micro-batch of whole reports can be gated alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from taxaspark.operators import tree

SCHEMA = "sample string, idx long, depth int, pct string, clade_reads long, direct_reads long, total_minimizers long, distinct_minimizers long, rank string, taxid string, name string"


def gate_stream(spark: SparkSession, landing: str, out: str, checkpoint: str, rank: str = "S", min_distinct: int = 333, min_reads: int = 0, protect: float = 0.01) -> StreamingQuery:
    """Gate every report that lands as Parquet rows; evidence and gated rows go to ``out``, once each.

    A file holds whole samples. Each batch replaces its own folder, so a batch that runs again
    after a failure writes the same rows again and none twice.
    """

    def one(batch: DataFrame, number: int) -> None:
        linked = tree.link(batch)
        evidence = tree.verdicts(batch, rank, min_distinct, min_reads, protect)
        marked = tree.mark(linked, rank, min_distinct, min_reads, protect)
        evidence.write.mode("overwrite").parquet(f"{out}/evidence/batch={number}")
        tree.gated(marked, tree.credits(marked)).write.mode("overwrite").parquet(f"{out}/gated/batch={number}")

    rows = spark.readStream.schema(SCHEMA).parquet(landing)
    return rows.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
