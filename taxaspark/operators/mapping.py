"""Mapping of reads to references: sampled seeds, chains of seeds on near diagonals, banded alignment.

Seeds are exact k-mers, of which a hash keeps a share, alike on both sides. Reads that surely have no seed of the references are
left out by one look at their k-mers; the seeds of the others meet the references' in a join; a
chain is the seeds of a read, strand and reference whose diagonals lie within one band. The chains with the most
seeds of a read are aligned with the reference around their diagonal, all bases of the read and free ends of the reference, and the one
with the fewest edits counts. References are cut into overlapping tiles, so that an alignment needs one tile and no task a
whole chromosome.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from taxaspark.functions import dna, kmers
from taxaspark.operators.joins import if_small, settle

TILE = 4096


def seeds(rows: DataFrame, keep: list[str], k: int, share: int) -> DataFrame:
    """(keep, seed, pos): the sampled k-mers of column seq with their places, one in about ``share``."""

    def made(seqs: pa.Array) -> tuple[np.ndarray, list[pa.Array]]:
        clean = pc.replace_substring_regex(pc.fill_null(seqs.cast(pa.string()), ""), "[^ACGTacgt]", "A")  # so that places go on across them
        owner, codes = kmers.windows(clean, k)
        pos = np.arange(len(owner)) - np.searchsorted(owner, owner)
        bases, offsets = kmers._bases(seqs)
        bad = np.concatenate([[0], np.cumsum(bases > 3)])
        at = offsets[owner] + pos
        good = bad[at + k] == bad[at]
        mixed = (codes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
        good &= mixed % np.uint64(share) == 0
        return owner[good], [pa.array(codes[good], pa.int64()), pa.array(pos[good], pa.int64())]

    return kmers._rows(rows, keep, "seed long, pos long", made)


def _both_ways(index: DataFrame, k: int) -> DataFrame:
    """(seed): the seeds of ``index`` and their reverse complements."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = b.column("seed").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([codes, kmers.turned_codes(codes, k)]))], ["seed"])

    return index.select("seed").mapInArrow(run, "seed long")


def edits(reads: list[str], parts: list[str], band: int) -> np.ndarray:
    """Fewest edits of each read against its part of a reference, whose ends are free; the part starts ``band`` bases before the diagonal.

    A path may leave the diagonal by up to ``band`` places.
    """
    n, wide = len(reads), 2 * band + 1
    longest = max(map(len, reads), default=0)
    a = np.zeros((n, longest), np.uint8)
    b = np.zeros((n, longest + wide), np.uint8)
    for i, (r, p) in enumerate(zip(reads, parts, strict=True)):
        a[i, : len(r)] = np.frombuffer(r.encode(), np.uint8)
        cut = np.frombuffer(p.encode(), np.uint8)[: longest + wide]
        b[i, : len(cut)] = cut
    length = np.array([len(r) for r in reads])
    steps = np.arange(wide)
    row = np.zeros((n, wide), np.int32)
    out = np.where(length == 0, 0, -1)
    for i in range(longest):
        # Cell d stands for reference place i + d: diagonal, read base without one of the reference, and the other way round.
        now = row + (a[:, i : i + 1] != b[:, i : i + wide])
        now[:, :-1] = np.minimum(now[:, :-1], row[:, 1:] + 1)
        now = np.minimum.accumulate(now - steps, 1) + steps
        row = now
        ends = length == i + 1
        out[ends] = row[ends].min(1)
    return out


def map_reads(reads: DataFrame, refs: DataFrame, k: int = 21, share: int = 3, min_identity: float = 0.95, band: int = 16, max_read: int = 1000) -> DataFrame:
    """(read_id, ref_id, strand, start, edits, identity): the best place of each of ``reads`` (read_id, seq) in ``refs`` (ref_id, seq), if it is that alike.

    Identity is 1 - edits / bases of the read. ``start`` is about where the read starts in the reference. Of chains with as many seeds all are aligned;
    of equal edits the first reference, strand and place counts. Reads without a seed in common with a reference,
    or longer than ``max_read``, have none.
    """
    tiles = refs.select("ref_id", "seq", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.length("seq") - 1, F.lit(0)).cast("long"), F.lit(TILE).cast("long"))).alias("from"))
    tiles = settle(tiles.select("ref_id", "from", F.substr("seq", F.greatest(F.col("from") - 2 * band, F.lit(0)).cast("int") + 1, F.lit(TILE + max_read + 5 * band)).alias("seq")))
    lead = F.least(F.col("from"), F.lit(2 * band).cast("long"))
    index = seeds(tiles, ["ref_id", "from"], k, share).withColumn("at", F.col("pos") + F.col("from") - lead).where((F.col("at") >= F.col("from")) & (F.col("at") < F.col("from") + TILE)).select("seed", "ref_id", "at")
    index = if_small(index)
    own = kmers.rows_with(reads.select("read_id", "seq").where((F.length("seq") >= k) & (F.length("seq") <= max_read)), k, kmers.code_filter(_both_ways(index, k), "seed"))
    strands = F.array(F.struct(F.lit("+").alias("strand"), "seq"), F.struct(F.lit("-").alias("strand"), dna.reverse_complement(F.col("seq")).alias("seq")))
    both = settle(own.select("read_id", F.explode(strands).alias("s")).select("read_id", "s.strand", "s.seq"))
    met = seeds(both, ["read_id", "strand"], k, share).join(index, "seed").select("read_id", "strand", "ref_id", "pos", (F.col("at") - F.col("pos")).alias("diagonal"))
    # Diagonals within a band share one of two buckets.
    half = F.array(F.floor(F.col("diagonal") / band), F.floor(F.col("diagonal") / band) - 1)
    chains = met.select("read_id", "strand", "ref_id", "pos", "diagonal", F.explode(half).alias("bucket")).groupBy("read_id", "strand", "ref_id", "bucket")
    chains = chains.agg(F.count_distinct("pos").alias("n"), F.min("diagonal").alias("diagonal"))
    chains = chains.withColumn("best", F.max("n").over(Window.partitionBy("read_id")))
    top = chains.where("n = best").select("read_id", "strand", "ref_id", "diagonal").distinct()
    start = F.greatest(F.col("diagonal"), F.lit(0))
    placed = top.withColumn("from", F.floor(start / TILE) * TILE).join(both, ["read_id", "strand"]).join(tiles.withColumnRenamed("seq", "tile"), ["ref_id", "from"])

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for x in range(0, whole.num_rows, 512):
                b = whole.slice(x, 512)
                diagonal, first = b.column("diagonal").to_numpy(), b.column("from").to_numpy()
                texts = b.column("seq").to_pylist()
                # Places of the tile's text before the diagonal's band, filled up where the reference hasn't begun.
                begin = diagonal - band - np.maximum(first - 2 * band, 0)
                parts = ["." * int(max(0, -s)) + t[max(0, int(s)) : int(max(0, s)) + len(r) + 2 * band + 1] for s, t, r in zip(begin, b.column("tile").to_pylist(), texts, strict=True)]
                found = edits(texts, parts, band)
                size = np.array([len(r) for r in texts])
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("read_id", "ref_id", "strand")), pa.array(np.maximum(diagonal, 0)), pa.array(found.astype(np.int32)), pa.array(1 - found / size)], ["read_id", "ref_id", "strand", "start", "edits", "identity"])

    kinds = {f.name: f.dataType.simpleString() for f in both.schema.fields + tiles.schema.fields}
    rows = placed.select("read_id", "ref_id", "strand", "diagonal", "from", "seq", "tile").mapInArrow(align, f"read_id {kinds['read_id']}, ref_id {kinds['ref_id']}, strand string, start long, edits int, identity double")
    good = rows.where(F.col("identity") >= min_identity)
    return good.groupBy("read_id").agg(F.min(F.struct("edits", "ref_id", "strand", "start", "identity")).alias("b")).select("read_id", "b.ref_id", "b.strand", "b.start", "b.edits", "b.identity")


def screen_pairs(pairs: DataFrame, refs: DataFrame, need: str = "concordant", max_insert: int = 1000, **options) -> DataFrame:
    """``pairs`` (pair_id, r1, r2) without those that map to the references.

    ``need`` tells when a pair goes: ``either`` mate maps, ``both`` do, or both do in one reference on opposite strands within
    ``max_insert`` bases (``concordant``). Options are those of ``map_reads``.
    """
    mates = pairs.select(F.explode(F.array(*[F.struct(F.struct("pair_id", F.lit(i).alias("mate")).alias("read_id"), F.col(f"r{i}.seq").alias("seq")) for i in (1, 2)])).alias("m")).select("m.*")
    hits = settle(map_reads(mates, refs, **options).select("read_id.pair_id", "read_id.mate", "ref_id", "strand", "start"))
    if need == "either":
        bad = hits.select("pair_id").distinct()
    elif need == "both":
        bad = hits.groupBy("pair_id").agg(F.count("*").alias("n")).where("n = 2")
    elif need == "concordant":
        a, b = (hits.where(F.col("mate") == i).select("pair_id", "ref_id", F.col("strand").alias(f"s{i}"), F.col("start").alias(f"p{i}")) for i in (1, 2))
        bad = a.join(b, ["pair_id", "ref_id"]).where((F.col("s1") != F.col("s2")) & (F.abs(F.col("p1") - F.col("p2")) <= max_insert))
    else:
        raise ValueError("need is either, both or concordant")
    return pairs.join(bad.select("pair_id"), "pair_id", "left_anti")
