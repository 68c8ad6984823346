"""Exact dedup by a tree-merge of sorted digest runs.

Every partition of the documents makes one run, where it stands: its digests, sorted, each with the
smallest id and the number of its rows. The runs are merged in rounds: in round k the run numbers
lose their lowest base-``fan_in`` digit, so up to ``fan_in`` runs meet in one exchange, are put in the order
of their digests, and one pass over the sorted stream merges neighbours: of equal digests the
smallest id and the sum of the counts go on. Runs are cut by digest range, and only pieces of the same range meet;
their number follows the number of rows, so no task ever holds a whole run, not even in the last
round. A digest is the SHA-256 of the normalised text; byte length and a second, independent hash
verify each merge.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaspark.llm.common import SPACE, attach, cut, fits, fresh

DIGEST = ["text_sha256", "n_bytes", "second"]
#: Rows that a piece of a run has on average in the last round.
PIECE = 1_000_000


def normalised(text: Column) -> Column:
    """Null as empty, and each run of white space as one space."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), f"[{SPACE}]+", " ")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, part (the partition), text_sha256, n_bytes and second of every row."""
    norm = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(F.col("text")).alias("norm"))
    return norm.select("doc_id", F.spark_partition_id().alias("part"), F.sha2("norm", 256).alias("text_sha256"), F.octet_length("norm").alias("n_bytes"), F.xxhash64("norm").alias("second"))


def merge_sorted(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Merge neighbours with equal ``keys`` in rows sorted by keys and keep_id: first keep_id, sum of group_size.

    One pass over each partition's stream; only the last group of a batch is held back.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            if held is not None:
                b = pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
            n = b.num_rows
            new = np.zeros(n, bool)
            new[0] = True
            for k in keys:
                c = b.column(k)
                new[1:] |= pc.not_equal(c.slice(1), c.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            first = np.flatnonzero(new)
            sums = np.add.reduceat(b.column("group_size").to_numpy(), first)
            b = b.take(pa.array(first))
            b = b.set_column(b.schema.get_field_index("group_size"), b.schema.field("group_size"), pa.array(sums))
            yield b.slice(0, b.num_rows - 1)
            held = b.slice(b.num_rows - 1)
        if held is not None:
            yield held

    return rows.mapInArrow(run, rows.schema)


def sorted_runs(rows: DataFrame) -> DataFrame:
    """The run of each partition of ``rows`` (doc_id, digest), made without an exchange: sorted, one row for each digest."""
    own = rows.select(F.spark_partition_id().alias("run"), *DIGEST, F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    keys = ["run", *DIGEST]
    return merge_sorted(own.sortWithinPartitions(*keys, F.asc_nulls_last("keep_id")), keys)


def merge_runs(runs: DataFrame, last: int, fan_in: int = 8, ranges: int = 1) -> DataFrame:
    """Merge runs (text_sha256, n_bytes, second, run, keep_id, group_size), numbered 0 to ``last``, cut into ``ranges``.

    Every round is one exchange by (digest range, parent run), a sort of what came, and a merge of neighbours.
    """
    n = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    piece = F.floor(F.conv(F.substring("text_sha256", 1, 8), 16, 10).cast("long") * ranges / (1 << 32)).cast("int")
    merged = runs.withColumn("piece", piece)
    keys = ["piece", "run", *DIGEST]
    while True:
        last //= fan_in
        merged = merged.withColumn("run", F.floor(F.col("run") / fan_in).cast("int")).repartition(n, "piece", "run")
        merged = merge_sorted(merged.sortWithinPartitions(*keys, F.asc_nulls_last("keep_id")), keys)
        if last == 0:
            return merged.drop("run", "piece")


def deduplicate(docs: DataFrame, fan_in: int = 8) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row.

    The row with the smallest doc_id of equal texts stays; null texts count as empty; a null id is
    larger than any other. If several rows carry the smallest id, all of them are marked kept, for
    they are the same document; ``drop_copies`` keeps one. An empty table gives an empty result;
    columns other than doc_id and text are ignored.
    """
    rows = cut(digests(docs))
    runs = cut(sorted_runs(rows))
    seen = runs.agg(F.max("run"), F.count("*")).first()
    groups = merge_runs(runs, seen[0] or 0, fan_in, max(64, -(-seen[1] // PIECE)))
    key = F.concat_ws("-", *DIGEST)
    groups = cut(groups.select(key.alias("key"), "keep_id", "group_size"))
    out = attach(rows.withColumn("key", key), groups, "key", F.col("part"), "group_size")
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, fan_in: int = 8) -> DataFrame:
    """``docs`` with one row for each text: the one with the smallest doc_id; all columns are kept, whatever their names.

    Groups of one text are settled by digest; the text itself is read where it stands, and only ids
    of rows that go are joined back. Rows that repeat an id and a text lose all but one.
    """
    marked = deduplicate(docs, fan_in)
    # Ids that go, and of repeated ids with the same text how many copies there are.
    per = marked.groupBy("doc_id", "text_sha256").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    gone = cut(per.where(~F.col("kept") | (F.col("n") > 1)))
    key, stays = fresh(docs, "_text"), fresh(docs, "_stays")
    own = docs.withColumn(key, F.struct(F.col("doc_id").cast("long").alias("id"), F.sha2(normalised(F.col("text")), 256).alias("sha")))
    gone = gone.select(F.struct(F.col("doc_id").alias("id"), F.col("text_sha256").alias("sha")).alias(key), F.col("kept").alias(stays))
    small = fits(gone, 2_000_000)
    joined = own.alias("o").join((F.broadcast(gone) if small else gone).alias("g"), F.col(f"o.{key}").eqNullSafe(F.col(f"g.{key}")), "left")
    columns = [F.col(f"o.`{c}`") for c in docs.columns]
    joined = joined.select(*columns, F.col(f"o.{key}"), F.col(f"g.{stays}"))
    single = joined.where(F.col(stays).isNull())
    # Rows that repeat both id and text: any one of them, as they stand for the same document.
    repeated = joined.where(F.col(stays)).dropDuplicates([key])
    return single.unionByName(repeated).select(*[F.col(f"`{c}`") for c in docs.columns])


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
), g AS (
  SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""
