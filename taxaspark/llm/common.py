"""Helpers that the training-data operators share.

Every helper keeps work on the executors: small sides are broadcast only after their size was
counted, lineage is cut by tables written to the folder that the cluster names in
``spark.checkpoint.dir``, and joins on a hot key are spread over several partitions.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the contracts, as a regular-expression class.
SPACE = r"\x20\x09-\x0D"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the driver's tables, as Spark reads it."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; a temporary one only in local mode, as in tests."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="taxaspark-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in smaller pieces, so that few texts are Python objects at once.

    A piece has at most ``rows`` rows and about ``max_bytes`` of data, or a single row that is longer.
    """
    for b in batches:
        many = max(1, min(rows, int(b.num_rows * max_bytes / max(1, b.nbytes))))
        for k in range(0, b.num_rows, many):
            part = b.slice(k, many)
            if part.num_rows > 1 and part.nbytes > 2 * max_bytes:
                yield from slices([part], max(1, part.num_rows // 2), max_bytes)
            else:
                yield part


def qualified(spark: SparkSession, path: str) -> str:
    """Full URI of a path, as the cluster's file systems name it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    uri = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(hadoop).toString()
    return "file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into a table in the shared folder and read it from there.

    The table has no lineage but its files, which all executors see; it is removed when the
    application ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return spark.read.schema(df.schema).parquet(path)


def fits(df: DataFrame, max_rows: int) -> bool:
    """True if ``df`` has at most ``max_rows`` rows; counts no further than that."""
    return df.limit(max_rows + 1).count() <= max_rows


def join_checked(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner", max_rows: int = 2_000_000) -> DataFrame:
    """Join that broadcasts ``small`` only if it was counted to be small, and shuffles otherwise."""
    return big.join(F.broadcast(small) if fits(small, max_rows) else small, on, how)


def attach(rows: DataFrame, groups: DataFrame, key: str, salt: Column, size: str, hot: int = 2_000, salts: int = 64, how: str = "inner") -> DataFrame:
    """Give each of ``rows`` the columns of its group, spreading hot groups over many partitions.

    ``groups`` has one row per ``key`` with the group's row count in ``size``. Groups of more than
    ``hot`` rows are repeated once per salt, and the rows are dealt by (key, salt), so a group that
    holds a third of all rows is read by ``salts`` tasks. Each key matches once; ``how="left"``
    keeps rows without a group.
    """
    wide = groups.withColumn("_salt", F.explode(F.when(F.col(size) > hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    wide = wide.withColumn("_hot", F.col(size) > hot)
    dealt = rows.withColumn("_salt", F.pmod(salt, F.lit(salts)).cast("int"))
    hot_keys = groups.where(F.col(size) > hot).select(key, F.lit(True).alias("_hot"))
    # At most rows/hot keys can be hot; the join below falls back to a shuffle if even those are many.
    dealt = join_checked(dealt, hot_keys, [key], "left", 200_000)
    dealt = dealt.withColumn("_salt", F.when(F.col("_hot"), F.col("_salt")).otherwise(0)).drop("_hot")
    return dealt.join(wide.drop("_hot"), [key, "_salt"], how).drop("_salt")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have (in any letter case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_key(text: Column) -> Column:
    """128 bits that stand for a text; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit("second"), text).alias("b"))


def anti_by_key(rows: DataFrame, key: Column, gone: DataFrame, max_rows: int = 2_000_000) -> DataFrame:
    """``rows`` whose ``key`` isn't in the one column of ``gone``; columns and names of ``rows`` stay as they are."""
    k = fresh(rows, "_key")
    gone = gone.toDF(k)
    return rows.withColumn(k, key).join(F.broadcast(gone) if fits(gone, max_rows) else gone, k, "left_anti").select(*[F.col(f"`{c}`") for c in rows.columns])


def salted_join(left: DataFrame, right: DataFrame, on: list[str], salt: Column, hot: int = 2_000, salts: int = 64) -> DataFrame:
    """Inner join by shuffle in which both sides may repeat a key.

    Keys that stand in more than ``hot`` rows of ``left`` are spread over ``salts`` partitions by ``salt``, and
    the rows of ``right`` with such a key are repeated once for each.
    """
    often = cut(left.groupBy(*on).agg(F.count("*").alias("_n")).where(F.col("_n") > hot).select(*on, F.lit(True).alias("_hot")))
    mark = lambda df: df.join(F.broadcast(often) if fits(often, 200_000) else often, on, "left")
    dealt = mark(left).withColumn("_salt", F.when(F.col("_hot"), F.pmod(salt, F.lit(salts)).cast("int")).otherwise(0)).drop("_hot")
    wide = mark(right).withColumn("_salt", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))))).drop("_hot")
    return dealt.join(wide, [*on, "_salt"]).drop("_salt")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def held_out(doc_id: Column) -> Column:
    """True for the rows that no model may learn from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def unit_hash(*cols: Column) -> Column:
    """A number in [0, 1) that depends on the columns alone, for sampling."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 30)) / F.lit(float(1 << 30))
