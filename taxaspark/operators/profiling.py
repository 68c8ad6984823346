"""From classified reads to tree reports, and from references to the k-mer distribution that re-estimation uses."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxaspark.functions import kmers
from taxaspark.operators.joins import if_small, settle

#: Rank codes by depth below the root, which is R.
RANKS = ("D", "P", "C", "O", "F", "G", "S")

#: Rows of hits that a task takes when distinct values are counted.
PART = 1 << 18

#: Paths (about) up to which they go through a shuffle as numbers; their table is broadcast.
PATHS = 1 << 17


def minimizer_hits(reads: DataFrame, database: DataFrame, k: int, l: int) -> DataFrame:
    """(sample, path, minimizer): a row for every run of k-mers with one minimizer of the database, in ``reads`` (sample, read_id, seq)."""
    database = if_small(database)
    each = kmers.minimizer_rows(reads, ["sample", "read_id"], k, l, among=kmers.code_filter(database, "minimizer")).where("first = 1")
    return each.join(database, "minimizer").select("sample", "path", "minimizer")


def report(calls: DataFrame, hits: DataFrame, names: DataFrame | None = None, ranks: tuple[str, ...] = RANKS, exact: bool = False, bits: int = 14) -> DataFrame:
    """Tree rows of every sample in depth-first order, as ``tree_report`` reads them from files: eight columns, idx and depth.

    ``calls`` has sample, read_id and path (taxa from below the root, empty or null if unclassified); ``hits`` sample,
    path and minimizer; ``names`` (taxid, name) names taxa, which otherwise are their own names. A taxon has a row if a
    read was called in its clade. Children follow their parent by falling clade reads, then by taxid; the unclassified come
    first, if there are any. Distinct minimizers are estimated by sketches of 2**``bits`` counters that are made per taxon and merged up the tree, or
    counted (``exact``).

    Reads and hits are summed per taxon first, so what goes up the tree are taxa, not reads.
    """
    of = F.coalesce(F.col("path"), F.array().cast("array<string>"))
    own = settle(calls.groupBy("sample", of.alias("path")).agg(F.count("*").alias("n")))  # read by five branches, so made once
    empty = F.size("path") == 0
    level = F.posexplode(_nodes("path")).alias("at", "node")
    here = F.when(F.col("at") == F.size("path"), F.col("n"))
    clades = own.where(~empty).select("sample", "path", "n", level).groupBy("sample", "node").agg(F.sum("n").alias("clade_reads"), F.coalesce(F.sum(here), F.lit(0)).alias("direct_reads"))
    if exact:
        seen = counted_below(hits, ["sample"], "path", "minimizer").withColumnsRenamed({"total": "total_minimizers", "distinct": "distinct_minimizers"})
    else:
        sums = hits.groupBy("sample", "path").agg(F.count("*").alias("m"), F.hll_sketch_agg("minimizer", bits).alias("h"))
        seen = sums.select("sample", F.explode(_nodes("path")).alias("node"), "m", "h").groupBy("sample", "node").agg(F.sum("m").alias("total_minimizers"), F.hll_sketch_estimate(F.hll_union_agg("h")).alias("distinct_minimizers"))
    numbers = ["clade_reads", "direct_reads", "total_minimizers", "distinct_minimizers"]
    nodes = settle(clades.join(seen, ["sample", "node"], "left").na.fill(0, numbers[2:]))
    # The order is that of the clade reads and taxa on the way down.
    way = nodes.select("sample", "node", *numbers, F.posexplode(_nodes("node")).alias("at", "above"))
    way = way.join(nodes.select("sample", F.col("node").alias("above"), F.col("clade_reads").alias("reads")), ["sample", "above"])
    step = F.struct("at", (-F.col("reads")).alias("less"), F.coalesce(F.try_element_at("above", F.lit(-1)), F.lit("")).alias("taxon"))
    rows = way.groupBy("sample", "node", *numbers).agg(F.sort_array(F.collect_list(step)).alias("order"))
    depth = F.size("node")
    lowest = F.lit(len(ranks))
    rank = F.when(depth == 0, "R").when(depth <= lowest, F.try_element_at(F.array(*[F.lit(r) for r in ranks]), F.greatest(depth, F.lit(1)))).otherwise(F.concat(F.lit(ranks[-1]), (depth - lowest).cast("string")))
    taxid = F.when(depth == 0, F.lit("1")).otherwise(F.try_element_at("node", F.lit(-1)))
    rows = rows.select("sample", depth.alias("depth"), rank.alias("rank"), taxid.alias("taxid"), *numbers, "order")
    if names is not None:
        rows = rows.join(if_small(names.select("taxid", "name")), "taxid", "left")
    name = F.coalesce("name", F.when(F.col("depth") == 0, "root"), "taxid") if names is not None else F.when(F.col("depth") == 0, "root").otherwise(F.col("taxid"))
    none = own.where(empty).select("sample", F.lit(0).alias("depth"), F.lit("U").alias("rank"), F.lit("0").alias("taxid"), F.col("n").alias("clade_reads"), F.col("n").alias("direct_reads"), F.lit(0).cast("long").alias("total_minimizers"), F.lit(0).cast("long").alias("distinct_minimizers"), F.array().cast(rows.schema["order"].dataType).alias("order"), F.lit("unclassified").alias("name"))
    every = rows.withColumn("name", name).unionByName(none)
    all_reads = own.groupBy("sample").agg(F.sum("n").alias("_all"))
    every = every.join(if_small(all_reads), "sample")
    idx = F.row_number().over(Window.partitionBy("sample").orderBy("order")) - 1
    return every.select("sample", idx.cast("long").alias("idx"), "depth", F.format_string("%6.2f", 100.0 * F.col("clade_reads") / F.col("_all")).alias("pct"), "clade_reads", "direct_reads", "total_minimizers", "distinct_minimizers", "rank", "taxid", "name")


def _nodes(path: str) -> Column:
    """All nodes on the way to a path, the root (empty) first."""
    return F.transform(F.sequence(F.lit(0), F.size(path)), lambda i: F.slice(path, F.lit(1), i))


def _first_new(path: str, before: str) -> Column:
    """Depth of the first node of ``path`` that isn't on the way to ``before``; 0 if that is null."""
    differ = F.array_position(F.zip_with(path, before, lambda a, b: a.eqNullSafe(b)), False)
    shared = F.when(differ > 0, differ - 1).otherwise(F.least(F.size(path), F.size(before)))
    return F.when(F.col(before).isNull(), 0).otherwise(shared + 1).cast("int")


def _numbered(rows: DataFrame, several: int) -> tuple[DataFrame, DataFrame | None]:
    """``rows`` with the number of their ``_path`` as ``_code``, and the table (_code, _path) of the paths; rows with a null path go.

    Numbers rise in the order of the paths and are narrower than these in a shuffle and a sort. With more than ``PATHS`` paths (``several`` tells about how
    many) the paths are their own codes, and there is no table.
    """
    if several > PATHS:
        return rows.where(F.col("_path").isNotNull()).withColumnRenamed("_path", "_code"), None
    paths = settle(rows.select("_path").where(F.col("_path").isNotNull()).distinct().orderBy("_path").select(F.monotonically_increasing_id().alias("_code"), "_path"))
    return rows.join(F.broadcast(paths), "_path").drop("_path"), paths


def _brought(rows: DataFrame, keys: list[str], paths: DataFrame | None) -> DataFrame:
    """``rows`` (keys, _value, _code) with ``_first``, the depth of the first node that isn't on the way to the path before theirs among those of the value."""
    rows = rows.withColumn("_before", F.lag("_code").over(Window.partitionBy(*keys, "_value").orderBy("_code")))
    if paths is None:
        return rows.withColumn("_first", _first_new("_code", "_before"))
    before = paths.select(F.col("_code").alias("_before"), F.col("_path").alias("_last"))
    return rows.join(F.broadcast(paths), "_code").join(F.broadcast(before), "_before", "left").withColumn("_first", _first_new("_path", "_last")).drop("_path", "_last")


def _up(sums: DataFrame, paths: DataFrame | None) -> DataFrame:
    """``sums`` of every ``_code`` for all nodes on its way, as ``_at`` (depth) and ``node``."""
    named = sums.withColumnRenamed("_code", "_path") if paths is None else sums.join(F.broadcast(paths), "_code")
    return named.select(*[c for c in sums.columns if c != "_code"], F.posexplode(_nodes("_path")).alias("_at", "node"))


def counted_below(rows: DataFrame, keys: list[str], path: str, value: str) -> DataFrame:
    """(keys, node, total, distinct): rows, and distinct non-null values, below every node of the tree, the root (an empty path) included.

    Rows are dealt by value to as many tasks as their number asks for (``PART`` rows each), where those of one value and path become one. Sorted by path, each
    of these brings in the nodes that it doesn't share with the one before. What goes up the tree are the sums of a path, not rows.
    """
    own = settle(rows.select(*keys, F.col(path).alias("_path"), F.col(value).alias("_value")))
    count, several = own.agg(F.count("*"), F.approx_count_distinct("_path")).first()
    coded, paths = _numbered(own, several)
    dealt = coded.repartition(max(1, -(-count // PART)), *keys, "_value").groupBy(*keys, "_value", "_code").agg(F.count("*").alias("_m"))
    first = F.when(F.col("_value").isNotNull(), F.col("_first"))
    sums = _brought(dealt, keys, paths).groupBy(*keys, "_code", first.alias("_first")).agg(F.sum("_m").alias("_m"), F.count("*").alias("_d"))
    new = F.when(F.col("_at") >= F.col("_first"), F.col("_d")).otherwise(0)
    return _up(sums, paths).groupBy(*keys, "node").agg(F.sum("_m").alias("total"), F.sum(new).alias("distinct"))


def distinct_below(rows: DataFrame, keys: list[str], path: str, value: str) -> DataFrame:
    """(keys, node, n): distinct non-null values of the rows below every node of the tree, the root (an empty path) included.

    The rows of a value are sorted by path, so each brings in the nodes that its path doesn't share with the one before. What a task holds are
    rows that are sorted, which spill; what goes up the tree are the sums of a path, not rows.
    """
    own = settle(rows.where(F.col(value).isNotNull()).select(*keys, F.col(path).alias("_path"), F.col(value).alias("_value")))
    coded, paths = _numbered(own, own.agg(F.approx_count_distinct("_path")).first()[0])
    met = _brought(coded, keys, paths).where("_before IS NULL OR _before <> _code")
    sums = met.groupBy(*keys, "_code", "_first").agg(F.count("*").alias("_d"))
    return _up(sums, paths).where("_at >= _first").groupBy(*keys, "node").agg(F.sum("_d").alias("n"))


def _called(counts: Counter) -> tuple[str, ...]:
    """The path with most k-mers on it; of equal ones the common part."""
    score = {p: sum(n for q, n in counts.items() if p[: len(q)] == q) for p in counts}
    best = [p for p in score if score[p] == max(score.values())]
    common = best[0]
    for p in best[1:]:
        common = common[: next((i for i, (a, b) in enumerate(zip(common, p, strict=False)) if a != b), min(len(common), len(p)))]
    return common


def kmer_distribution(refs: DataFrame, database: DataFrame, read_length: int, k: int, l: int, rank_depth: int, tile: int = 20_000) -> DataFrame:
    """(taxid, called, n): how many reads of ``read_length`` from the references of each taxon are called what.

    All windows of every reference (seq, path) are called, by the path with most of their k-mers; windows without a known
    k-mer aren't counted. ``taxid`` is the reference's taxon at ``rank_depth`` (1 is the first below the root), references that don't
    reach it are left out. References are cut into tiles, each with the bases its last windows need, so the size of a
    reference doesn't matter; within a tile windows with the same k-mers by taxon are called once.
    """
    wide = read_length - k + 1
    starts = F.sequence(F.lit(0), F.greatest(F.length("seq") - read_length, F.lit(0)), F.lit(tile))
    cut = refs.where((F.length("seq") >= read_length) & (F.size("path") >= rank_depth)).select(F.element_at("path", rank_depth).alias("taxid"), "seq", F.explode(starts).alias("_from"))
    tiles = cut.select(F.monotonically_increasing_id().alias("tile"), "taxid", F.substr("seq", F.col("_from") + 1, F.lit(tile + read_length - 1)).alias("seq"))
    tiles = tiles.withColumn("windows", (F.length("seq") - (read_length - 1)).cast("long"))
    placed = _placed_minimizers(tiles, k, l).join(if_small(database), "minimizer")
    lists = placed.groupBy("tile", "taxid").agg(F.max("windows").alias("windows"), F.sort_array(F.collect_list(F.struct("pos", "path"))).alias("found"))

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total: Counter = Counter()
            for taxid, windows, found in zip(*(b.column(c).to_pylist() for c in ("taxid", "windows", "found")), strict=True):
                paths = sorted({tuple(f["path"]) for f in found})
                code = {p: i for i, p in enumerate(paths)}
                there = np.zeros((len(paths), windows + wide), np.int32)
                there[[code[tuple(f["path"])] for f in found], [f["pos"] + 1 for f in found]] = 1
                sums = there.cumsum(1)
                counts, times = np.unique(sums[:, wide : wide + windows] - sums[:, :windows], axis=1, return_counts=True)
                for column, n in zip(counts.T, times, strict=True):
                    if column.any():
                        path = _called(Counter({paths[i]: int(column[i]) for i in np.flatnonzero(column)}))
                        total[taxid, path[-1] if path else "1"] += int(n)
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in total], pa.string()), pa.array([y for _, y in total], pa.string()), pa.array(list(total.values()), pa.int64())], ["taxid", "called", "n"])

    return lists.mapInArrow(call, "taxid string, called string, n long").groupBy("taxid", "called").agg(F.sum("n").alias("n"))


def _placed_minimizers(tiles: DataFrame, k: int, l: int) -> DataFrame:
    """(tile, taxid, windows, pos, minimizer): the minimizer of every k-mer by its place; ``windows`` goes along."""
    schema = "tile long, taxid string, windows long, pos long, minimizer long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for r in range(whole.num_rows):
                b = whole.slice(r, 1)
                text = b.column("seq")[0].as_py()
                # Letters other than bases part the sequence; places go on across them.
                pieces, at = [], 0
                for piece in "".join(c if c in "ACGTacgt" else " " for c in text).split(" "):
                    if len(piece) >= k:
                        pieces.append((at, piece))
                    at += len(piece) + 1
                if not pieces:
                    continue
                owner, codes = kmers.minimizers(pa.array([p for _, p in pieces], pa.string()), k, l)
                within = np.arange(len(owner)) - np.searchsorted(owner, owner)
                pos = np.array([a for a, _ in pieces], np.int64)[owner] + within
                n = len(pos)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, b.column("tile")[0].as_py())), pa.array([b.column("taxid")[0].as_py()] * n, pa.string()), pa.array(np.full(n, b.column("windows")[0].as_py())), pa.array(pos), pa.array(codes)], ["tile", "taxid", "windows", "pos", "minimizer"])

    return tiles.mapInArrow(run, schema)


def kmer_share(distribution: DataFrame) -> DataFrame:
    """(anc_taxid, taxid, share): the share of a taxon's reads that is called each ancestor, as ``reestimate`` weighs by."""
    total = distribution.groupBy("taxid").agg(F.sum("n").alias("_t"))
    return distribution.join(total, "taxid").select(F.col("called").alias("anc_taxid"), "taxid", (F.col("n") / F.col("_t")).alias("share"))
