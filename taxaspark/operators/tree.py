"""Taxonomy trees given as depth-first rows: links, clades, evidence gate and credit.

A tree is rows (sample, idx, depth, ...) in depth-first order. One pass over a sample's rows in order
keeps the open path, at any depth; what it closes knows its ancestors and where its subtree ends. The rest is
windows and joins on these links; no range join is needed.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

LINKS = [StructField("ancestors", ArrayType(LongType())), StructField("end_idx", LongType()), StructField("parent_idx", LongType())]


def link(tree: DataFrame) -> DataFrame:
    """Add ancestors (idx of the rows whose subtree it is in, from the top), parent_idx and end_idx (first row outside).

    The parent is the open row one level up; a row whose depth skips a level has none, but still
    lies in the subtrees of the open rows above it. Rows are dealt by sample, and only the open path is held in memory.
    """
    schema = StructType([*tree.schema.fields, *LINKS])
    rows = tree.repartition("sample").sortWithinPartitions("sample", "idx")
    return rows.mapInArrow(_close_rows, schema)


def _close_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order in which the next row closes them. An open row is (depth, idx, ancestors, where it is)."""
    path: list[tuple] = []
    sample, last = None, -1
    for b in batches:
        taken: list[int] = []  # rows of this batch that are closed
        carried: list[pa.RecordBatch] = []  # closed rows of earlier ones
        links: tuple[list, list] = ([], [])

        def close(end: int, taken: list = taken, carried: list = carried, links: tuple = links) -> None:
            depth, idx, above, row = path.pop()
            parent = above[-1][1] if above and above[-1][0] == depth - 1 else None
            found = ([x for _, x in above], end, parent)
            if isinstance(row, int):
                taken.append(row)
                links[1].append(found)
            else:
                carried.append(row)
                links[0].append(found)

        for k, (s, idx, depth) in enumerate(zip(*(b.column(c).to_pylist() for c in ("sample", "idx", "depth")), strict=True)):
            while path and (s != sample or path[-1][0] >= depth):
                close(idx if s == sample else last + 1)
            path.append((depth, idx, tuple((d, i) for d, i, _, _ in path), k))
            sample, last = s, idx
        path[:] = [(d, i, above, b.slice(row, 1) if isinstance(row, int) else row) for d, i, above, row in path]
        yield from _linked(carried, links[0])
        yield from _linked([b.take(pa.array(taken, pa.int64()))], links[1])
    rest, found = [], []
    for depth, idx, above, row in path:
        rest.append(row)
        found.append(([x for _, x in above], last + 1, above[-1][1] if above and above[-1][0] == depth - 1 else None))
    yield from _linked(rest, found)


def _linked(rows: list[pa.RecordBatch], found: list[tuple]) -> Iterator[pa.RecordBatch]:
    if found:
        table = pa.Table.from_batches(rows).combine_chunks()
        for k, (field, kind) in enumerate(zip(LINKS, (pa.list_(pa.int64()), pa.int64(), pa.int64()), strict=True)):
            table = table.append_column(field.name, pa.array([f[k] for f in found], kind))
        yield from table.to_batches()


def clade_sums(linked: DataFrame, values: dict[str, str]) -> DataFrame:
    """Sum direct values up the tree: (sample, idx, and each output name)."""
    up = linked.select("sample", F.explode(F.concat("ancestors", F.array(F.col("idx").cast("long")))).alias("idx"), *values.values())
    return up.groupBy("sample", "idx").agg(*[F.sum(v).alias(k) for k, v in values.items()])


def total_classified(tree: DataFrame) -> DataFrame:
    """Clade reads of the first row of taxid 1 of each sample; 0 if there is none."""
    return tree.groupBy("sample").agg(F.coalesce(F.min_by(F.when(F.col("taxid") == "1", F.col("clade_reads")), F.when(F.col("taxid") == "1", F.col("idx"))), F.lit(0)).alias("classified"))


def unclassified_and_root(tree: DataFrame) -> DataFrame:
    """Reads of rank U and of the first rank R of each sample; 0 where missing."""
    first = lambda r: F.coalesce(F.min_by(F.when(F.col("rank") == r, F.col("clade_reads")), F.when(F.col("rank") == r, F.col("idx"))), F.lit(0))
    return tree.groupBy("sample").agg(first("U").alias("unclassified"), first("R").alias("classified"))


def verdicts(tree: DataFrame, rank: str = "S", min_distinct: int = 333, min_reads: int = 0, protect: float = 0.01) -> DataFrame:
    """Evidence table of the rows of exactly ``rank``: share, duplicity, decision and reason.

    A taxon stays if it passes both floors, or if its share of the classified reads is above
    ``protect``; the share is 0 if nothing is classified.
    """
    root = F.first(F.when(F.col("taxid") == "1", F.col("clade_reads")), ignorenulls=True).over(Window.partitionBy("sample").orderBy("idx").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rows = tree.withColumn("classified", F.coalesce(root, F.lit(0))).where(F.col("rank") == rank)
    return _judged(rows, min_distinct, min_reads, protect)


def _judged(rows: DataFrame, min_distinct: int, min_reads: int, protect: float) -> DataFrame:
    """Add share, decision and reason to rows that have ``classified``."""
    share = F.when(F.col("classified") > 0, F.col("clade_reads") / F.col("classified")).otherwise(F.lit(0.0))
    both = (F.col("distinct_minimizers") >= min_distinct) & (F.col("clade_reads") >= min_reads)
    rows = rows.withColumn("share", share)
    decision = F.when(both | (F.col("share") > protect), "keep").otherwise("prune")
    reason = (
        F.when(both, "passed both floors")
        .when(F.col("share") > protect, F.format_string("protected: %.2f%% of classified reads", F.col("share") * 100))
        .when(F.col("distinct_minimizers") < min_distinct, F.format_string("distinct minimizers %d < %d", F.col("distinct_minimizers").cast("long"), F.lit(min_distinct)))
        .otherwise(F.format_string("clade reads %d < %d", F.col("clade_reads").cast("long"), F.lit(min_reads)))
    )
    return rows.withColumns({"decision": decision, "reason": reason})


def in_evidence_order(verdicts: DataFrame) -> DataFrame:
    """The evidence table with ``place`` (from 1 per sample): by falling clade reads, equal ones as they stand in the report."""
    order = Window.partitionBy("sample").orderBy(F.desc("clade_reads"), "idx")
    return verdicts.withColumn("place", F.row_number().over(order))


def mark(linked: DataFrame, rank: str = "S", min_distinct: int = 333, min_reads: int = 0, protect: float = 0.01) -> DataFrame:
    """Linked rows with ``in_drop`` (the row or an ancestor is pruned) and ``topmost`` (it is pruned and no ancestor is).

    One pass over each sample: a row lies below a pruned one if the furthest end of the subtrees
    pruned before it lies behind it.
    """
    order = Window.partitionBy("sample").orderBy("idx")
    root = F.first(F.when(F.col("taxid") == "1", F.col("clade_reads")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rows = _judged(linked.withColumn("classified", F.coalesce(root, F.lit(0))), min_distinct, min_reads, protect)
    own = (F.col("rank") == rank) & (F.col("decision") == "prune")
    reach = F.max(F.when(own, F.col("end_idx"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    below = F.coalesce(reach > F.col("idx"), F.lit(False))
    return rows.withColumns({"in_drop": own | below, "topmost": own & ~below}).drop("classified", "share", "decision", "reason")


def credits(marked: DataFrame) -> DataFrame:
    """(sample, parent_idx, credit): clade reads of the topmost pruned rows; a null parent is the orphan total."""
    return marked.where("topmost").groupBy("sample", "parent_idx").agg(F.sum("clade_reads").alias("credit"), F.count("*").alias("n_pruned"))


def dead_credits(marked: DataFrame, credit: DataFrame, rank: str = "S") -> DataFrame:
    """Credited parents without a surviving row of ``rank`` below them, with their own direct reads."""
    live = marked.where((F.col("rank") == rank) & ~F.col("in_drop")).select("sample", F.explode(F.concat("ancestors", F.array(F.col("idx").cast("long")))).alias("parent_idx")).distinct()
    dead = credit.where("parent_idx IS NOT NULL").join(live, ["sample", "parent_idx"], "left_anti")
    own = marked.select("sample", F.col("idx").cast("long").alias("parent_idx"), "direct_reads", "name")
    return dead.join(own, ["sample", "parent_idx"]).select("sample", "parent_idx", "name", "credit", "direct_reads")


def gated(marked: DataFrame, credit: DataFrame) -> DataFrame:
    """Surviving rows; credited parents have the credit added to their direct reads, nothing else changes."""
    add = credit.where("parent_idx IS NOT NULL").select("sample", F.col("parent_idx").alias("idx"), "credit")
    rows = marked.where("NOT in_drop").join(add, ["sample", "idx"], "left")
    return rows.withColumn("direct_reads", F.col("direct_reads") + F.coalesce("credit", F.lit(0))).drop("credit", "in_drop", "topmost")


def gate_summary(marked: DataFrame, verdict: DataFrame) -> DataFrame:
    """One row a sample: rows kept and pruned at the rank, rows dropped, reads under pruned taxa, their share of the rank's and of all reads, and the protected taxa."""
    kept = F.col("decision") == "keep"
    v = verdict.groupBy("sample").agg(
        F.count_if(kept).alias("kept"), F.count_if(~kept).alias("pruned"), F.sum("clade_reads").alias("_rank"), F.max("classified").alias("_all"),
        F.sort_array(F.collect_list(F.when(F.col("reason").startswith("protected"), F.col("name")))).alias("protected"),
    )
    m = marked.groupBy("sample").agg(F.count_if("in_drop").alias("rows_dropped"), F.coalesce(F.sum(F.when(F.col("topmost"), F.col("clade_reads"))), F.lit(0)).alias("reads_pruned"))
    share = lambda of: F.when(F.col(of) > 0, 100.0 * F.col("reads_pruned") / F.col(of)).otherwise(0.0)
    return v.join(m, "sample").withColumns({"pct_of_rank": share("_rank"), "pct_of_all": share("_all")}).drop("_rank", "_all")


def first_named(tree: DataFrame, text: str) -> DataFrame:
    """Taxid of each sample's first row whose name contains the text as it is."""
    return tree.where(F.col("name").contains(text)).groupBy("sample").agg(F.min_by("taxid", "idx").alias("taxid"), F.min("idx").alias("idx"))


def with_descendants(linked: DataFrame, start: DataFrame) -> DataFrame:
    """(sample, taxid) of the start rows and everything below them."""
    roots = start.select("sample", F.col("idx").cast("long").alias("_root"))
    own = linked.select("sample", "taxid", F.explode(F.concat("ancestors", F.array(F.col("idx").cast("long")))).alias("_root"))
    return own.join(roots, ["sample", "_root"], "left_semi").select("sample", "taxid").distinct()
