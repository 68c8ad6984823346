"""Tables that are made once, and joins whose side is broadcast only after its bytes were counted."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def settle(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder (``spark.checkpoint.dir``) and read from there; removed with the application.

    Only a local session without that setting takes a temporary folder.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    home = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not home:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        home = tempfile.mkdtemp(prefix="taxaspark-")
        sc.setCheckpointDir(home)
    path = f"{home.rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    hadoop = sc._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return spark.read.schema(df.schema).parquet(path)


def if_small(df: DataFrame, max_bytes: int = 32 << 20) -> DataFrame:
    """``df``, made once, and marked for broadcast if its values have at most ``max_bytes`` as text."""
    table = settle(df)
    size = table.agg(F.sum(F.octet_length(F.to_csv(F.struct(*[F.col(f"`{c}`").cast("string") for c in table.columns]))))).first()[0]
    return F.broadcast(table) if (size or 0) <= max_bytes else table
