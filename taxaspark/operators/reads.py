"""Read pairs: filtering, trimming, in-silico PCR, merging, dereplication, chimeras, contaminants."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaspark.functions import dna, kmers
from taxaspark.functions.expr import let
from taxaspark.operators.joins import if_small, settle
from taxaspark.operators.tables import numbered_in_order


def pair_mates(first: DataFrame, second: DataFrame) -> DataFrame:
    """(sample, ordinal, read_id, r1, r2) from two tables (sample, ordinal, read_id, seq, qual).

    A position with one mate only is an error, not a silent shift of all that follow.
    """
    a = first.select("sample", "ordinal", "read_id", F.struct("seq", "qual").alias("r1"))
    b = second.select("sample", "ordinal", F.struct("seq", "qual").alias("r2"))
    both = a.join(b, ["sample", "ordinal"], "full")
    checked = F.when(F.col("r1").isNull() | F.col("r2").isNull(), F.raise_error(F.concat(F.lit("unpaired read in "), F.col("sample")))).otherwise(F.col("r1"))
    return both.withColumn("r1", checked)


def trim_read(read: Column, trunc_q: int, trunc_len: int) -> Column:
    """Cut a read (seq, qual) at its first base of quality ``trunc_q`` or less, then at ``trunc_len``; a shorter read is null."""
    return let(read, lambda r: _trimmed(r, trunc_q, trunc_len))


def _trimmed(read: Column, trunc_q: int, trunc_len: int) -> Column:
    bad = dna.first_bad_base(read["qual"], trunc_q)
    keep = F.coalesce(bad - 1, F.length(read["seq"]))
    keep = keep if trunc_len <= 0 else F.when(keep >= trunc_len, F.lit(trunc_len))
    return F.when(keep.isNotNull(), F.struct(F.substr(read["seq"], F.lit(1), keep).alias("seq"), F.substr(read["qual"], F.lit(1), keep).alias("qual")))


def filter_pairs(pairs: DataFrame, trunc_len: tuple[int, int] = (0, 0), max_ee: tuple[float, float] = (2, 5), trunc_q: int = 2, min_len: int = 20, max_len: int | None = None, errors: bool = False) -> DataFrame:
    """Trim both mates and keep pairs whose mates both pass: length, no N, expected errors, which ``errors`` adds as ee1 and ee2.

    The same rules as ``trim_read`` and ``dna.expected_errors``, for whole batches.
    """

    def mate(read: pa.StructArray, i: int) -> tuple[np.ndarray, pa.StructArray, np.ndarray]:
        seq, qual = (read.field(f) for f in (names[i].index("seq"), names[i].index("qual")))
        (raw, at), (marks, begin) = dna.flat(seq), dna.flat(qual)
        length, held = np.diff(at), np.diff(begin)
        bad = np.append(np.flatnonzero((marks >= 33) & (marks <= 33 + trunc_q)), len(marks))
        first = bad[np.searchsorted(bad, begin[:-1])] - begin[:-1]
        keep = np.where(first < held, first, length)
        good = ~np.asarray(pc.is_null(read)) & ~np.asarray(pc.is_null(seq))
        if trunc_len[i] > 0:
            good &= keep >= trunc_len[i]
            keep = np.minimum(keep, trunc_len[i])
        size, cut = np.minimum(keep, length), np.minimum(keep, held)
        unknown = np.concatenate([[0], np.cumsum(raw == ord("N"))])
        good &= (size >= min_len) & (unknown[at[:-1] + size] == unknown[at[:-1]])
        good &= size <= (max_len if max_len is not None else size)
        own = np.flatnonzero(good)
        ee = np.zeros(len(size))
        ee[own] = dna.summed_errors(marks, begin[own], cut[own])
        good &= ee <= max_ee[i]
        return good, lambda rows: pa.StructArray.from_arrays([_heads(raw, at, size, rows), pc.if_else(pc.is_null(qual.take(pa.array(rows))), None, _heads(marks, begin, cut, rows))], ["seq", "qual"]), ee

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in dna.slices(batches):
            made = [mate(b.column(f"r{i + 1}"), i) for i in (0, 1)]
            rows = np.flatnonzero(made[0][0] & made[1][0])
            columns = {c: b.column(c).take(pa.array(rows)) for c in others} | {f"r{i + 1}": made[i][1](rows) for i in (0, 1)}
            extra = [pa.array(made[i][2][rows]) for i in (0, 1)] if errors else []
            yield pa.RecordBatch.from_arrays([*(columns[c] for c in every), *extra], [*every, *(["ee1", "ee2"] if errors else [])])

    names = [pairs.schema[f"r{i}"].dataType.names for i in (1, 2)]
    every = pairs.columns
    others = [c for c in every if c not in ("r1", "r2")]
    kinds = [f"`{f.name}` {'struct<seq: string, qual: string>' if f.name in ('r1', 'r2') else f.dataType.simpleString()}" for f in pairs.schema.fields]
    return pairs.mapInArrow(run, ", ".join([*kinds, *(["ee1 double", "ee2 double"] if errors else [])]))


def _heads(raw: np.ndarray, at: np.ndarray, size: np.ndarray, rows: np.ndarray) -> pa.Array:
    """The first ``size`` letters of the strings ``rows``."""
    ends = np.concatenate([[0], np.cumsum(size[rows])])
    return dna.fixed(raw[np.arange(ends[-1]) + np.repeat(at[rows] - ends[:-1], size[rows])], ends)


def quality_trim(read: Column, window: int = 4, mean: int = 20) -> Column:
    """Cut leading bases while their window's mean is low, then from the first low window on."""
    return let(read, lambda r: let(_window_means(r, window), lambda means: _between_low(r, means, mean)))


def _window_means(read: Column, window: int) -> Column:
    q = dna.phred(read["qual"])
    n = F.length(read["seq"])
    return let(q, lambda q: _means(q, n, window))


def _means(q: Column, n: Column, window: int) -> Column:
    means = F.transform(F.sequence(F.lit(1), F.greatest(n - window + 1, F.lit(1))), lambda i: F.aggregate(F.slice(q, i, window), F.lit(0), lambda a, x: a + x) / F.size(F.slice(q, i, window)))
    return means


def _between_low(read: Column, means: Column, mean: int) -> Column:
    n = F.length(read["seq"])
    start = F.array_position(F.transform(means, lambda m: m >= mean), True)
    tail = F.slice(means, F.greatest(start, F.lit(1)).cast("int"), F.size(means))
    stop = F.array_position(F.transform(tail, lambda m: m < mean), True)
    length = F.when(start == 0, 0).when(stop > 0, stop - 1).otherwise(n - start + 1)
    return F.struct(*[F.substr(read[f], F.greatest(start, F.lit(1)).cast("int"), length.cast("int")).alias(f) for f in ("seq", "qual")])


def trim_readthrough(pairs: DataFrame, min_overlap: int = 30) -> DataFrame:
    """Cut adapters off pairs whose fragment is shorter than the reads.

    Such mates are reverse complements of each other up to the fragment's end; the longest such
    length short of the reads is the fragment, and what follows in either mate is adapter.
    """
    length = let(F.struct(F.col("r1.seq").alias("a"), F.col("r2.seq").alias("b")), lambda p: _fragment(p["a"], p["b"], min_overlap))
    rows = pairs.withColumn("_n", length)
    cut = lambda r: F.when(F.col("_n").isNull(), F.col(r)).otherwise(F.struct(*[F.substr(F.col(f"{r}.{f}"), F.lit(1), F.col("_n")).alias(f) for f in ("seq", "qual")]))
    return rows.withColumns({"r1": cut("r1"), "r2": cut("r2")}).drop("_n")


def _fragment(a: Column, b: Column, least: int) -> Column:
    top = F.least(F.length(a), F.length(b)) - 1
    sizes = F.when(top >= least, F.sequence(top, F.lit(least), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    return F.get(F.filter(sizes, lambda n: F.substr(a, F.lit(1), n) == dna.reverse_complement(F.substr(b, F.lit(1), n))), F.lit(0))


def mismatches(seq: Column, at: Column, primer: str) -> Column:
    """Number of positions of ``seq`` from ``at`` that the IUPAC primer doesn't stand for."""
    each = [F.when(F.lit(dna.MEANING[c]).contains(F.substr(seq, at + i, F.lit(1))) & (F.substr(seq, at + i, F.lit(1)) != ""), 0).otherwise(1) for i, c in enumerate(primer)]
    return sum(each[1:], each[0])


def find_primer(seq: Column, primer: str, error_rate: float) -> Column:
    """1-based first place with at most ``error_rate`` mismatches (no gaps); null if there is none."""
    if error_rate == 0:
        return F.nullif(F.regexp_instr(seq, F.lit(dna.iupac_regex(primer))), F.lit(0))
    allowed = int(error_rate * len(primer))
    places = lambda s: F.transform(F.sequence(F.lit(1), F.length(s) - len(primer) + 1), lambda i: F.when(mismatches(s, i, primer) <= allowed, i))
    return let(seq, lambda s: F.when(F.length(s) >= len(primer), F.array_min(F.filter(places(s), lambda i: i.isNotNull()))))


def cut_before(read: Column, place: Column, length: int) -> Column:
    """The read after a primer at ``place``."""
    return F.struct(*[F.substr(read[f], (place + length).cast("int")).alias(f) for f in ("seq", "qual")])


def cut_after(read: Column, place: Column) -> Column:
    """The read before ``place``, or all of it."""
    return F.struct(*[F.when(place.isNull(), read[f]).otherwise(F.substr(read[f], F.lit(1), (place - 1).cast("int"))).alias(f) for f in ("seq", "qual")])


def trim_primers(pairs: DataFrame, forward: str, reverse: str, error_rate: float = 0.2, min_len: int = 50, orientation: str = "fixed") -> DataFrame:
    """Cut the 5' primers (pairs without both go) and read-through at the 3' ends.

    With ``orientation='mixed'`` the pairs are also tried the other way round and appended, so a pair
    that fits both ways comes twice, as with two passes.
    """

    def one(rows: DataFrame, p1: str, p2: str) -> DataFrame:
        for name, primer in (("r1", p1), ("r2", p2)):
            place = find_primer(F.col(f"{name}.seq"), primer, error_rate)
            rows = rows.withColumn("_at", place).where("_at IS NOT NULL").withColumn(name, cut_before(F.col(name), F.col("_at"), len(primer)))
        for name, primer in (("r1", p2), ("r2", p1)):
            rows = rows.withColumn(name, cut_after(F.col(name), find_primer(F.col(f"{name}.seq"), dna.reverse_complement_text(primer), error_rate)))
        return rows.where((F.length("r1.seq") >= min_len) & (F.length("r2.seq") >= min_len)).drop("_at")

    out = one(pairs, forward, reverse)
    if orientation == "mixed":
        turned = one(pairs, reverse, forward)
        out = out.unionByName(turned.withColumns({"r1": F.col("r2"), "r2": F.col("r1")}))
    return out


def in_silico_pcr(refs: DataFrame, forward: str, reverse: str, error_rate: float = 0.2, min_len: int = 30) -> DataFrame:
    """Reference sequences between the two primers; those without either go."""
    back = dna.reverse_complement_text(reverse)
    rows = refs.withColumn("_f", find_primer(F.col("seq"), forward, error_rate)).where("_f IS NOT NULL")
    rows = rows.withColumn("seq", F.substr("seq", (F.col("_f") + len(forward)).cast("int")))
    rows = rows.withColumn("_r", find_primer(F.col("seq"), back, error_rate)).where("_r IS NOT NULL")
    rows = rows.withColumn("seq", F.substr("seq", F.lit(1), (F.col("_r") - 1).cast("int")))
    return rows.where(F.length("seq") >= min_len).drop("_f", "_r")


def merge_pairs(pairs: DataFrame, min_overlap: int = 12, max_mismatch: int = 0, concatenate: bool = False, spacer: str = "NNNNNNNNNN") -> DataFrame:
    """Add ``merged``: mate 1 and the reverse complement of mate 2 joined at their longest overlap.

    Unmerged pairs go. ``concatenate`` joins all of them with a spacer instead.
    """
    a, b = F.col("r1.seq"), dna.reverse_complement(F.col("r2.seq"))
    if concatenate:
        return pairs.withColumn("merged", F.concat(a, F.lit(spacer), b))
    size = let(F.struct(a.alias("a"), b.alias("b")), lambda p: _overlap(p["a"], p["b"], min_overlap, max_mismatch))
    return pairs.withColumn("overlap", size).where("overlap IS NOT NULL").withColumn("merged", F.concat(a, F.substr(b, F.col("overlap") + 1)))


def _overlap(a: Column, b: Column, min_overlap: int, max_mismatch: int) -> Column:
    """Longest overlap of the end of ``a`` and the start of ``b``; null if there is none."""
    most = F.least(F.length(a), F.length(b))
    sizes = F.when(most >= min_overlap, F.sequence(most, F.lit(min_overlap), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    tail = lambda n: F.substr(a, F.length(a) - n + 1, n)
    if max_mismatch == 0:
        # The first place where b's beginning stands in a has the longest overlap, if a goes on as b does.
        start = F.instr(a, F.substr(b, F.lit(1), F.lit(min_overlap)))
        others = F.get(F.filter(sizes, lambda n: F.startswith(b, tail(n))), F.lit(0))
        return F.when((start == 0) | (most < min_overlap), F.lit(None)).when(F.startswith(b, F.substr(a, start)), F.length(a) - start + 1).otherwise(others)
    head = lambda n: F.substr(b, F.lit(1), n)
    differ = lambda n: F.size(F.filter(F.sequence(F.lit(1), n), lambda i: F.substr(tail(n), i, F.lit(1)) != F.substr(head(n), i, F.lit(1))))
    return F.get(F.filter(sizes, lambda n: differ(n) <= max_mismatch), F.lit(0))


def dereplicate(reads: DataFrame, keys: list[str], seq: str) -> DataFrame:
    return reads.groupBy(*keys, seq).agg(F.count("*").alias("n"))


def sequence_table(counts: DataFrame) -> DataFrame:
    """(asv_no, asv_id, seq, total): sequences numbered by falling total, then by sequence.

    Sequences are dealt by ranges of that order and numbered range by range, so no task holds all of them, also where
    nearly all have the same total.
    """
    totals = counts.groupBy("seq").agg(F.sum("n").alias("total")).withColumn("_less", -F.col("total"))
    rows = numbered_in_order(totals, ["_less", "seq"], "asv_no")
    return rows.select("asv_no", F.concat(F.lit("ASV_"), F.col("asv_no").cast("string")).alias("asv_id"), "seq", "total")


def flagged_in_samples(counts: DataFrame, min_fold: float = 4) -> DataFrame:
    """(sample, seq, n, flag): two-parent chimeras of each sample; ``flag`` is 1 or null.

    In a sample a sequence is flagged if a prefix of one and a suffix of another sequence, both at
    least ``min_fold`` times as abundant, together cover it. Sequences meet on hashes of their ends (96 bits and the place) at every cut,
    and of those with one end the most abundant decides, so no pairs are made and no ends written out. Sequences of less than four bases are left out.
    """
    if min_fold <= 1:
        raise ValueError("a parent must be more abundant than its child")
    # Read by both ends and the result, so made once.
    rows = settle(counts.select("sample", "seq", "n")).select("sample", "seq", "n", F.length("seq").alias("len"), F.xxhash64("seq").alias("_id")).where("len >= 4")
    cuts = rows.withColumn("_cut", F.explode(F.sequence(F.lit(1), F.col("len") - 1)))
    key = lambda end: F.struct(F.xxhash64(end).alias("a"), F.crc32(end.cast("binary")).alias("b"), F.length(end).alias("n"))
    ends = cuts.select("sample", "_id", "n", "_cut", key(F.substr("seq", F.lit(1), F.col("_cut"))).alias("_left"), key(F.substr("seq", F.col("_cut") + 1)).alias("_right"))
    # Most abundant sequence with each end; with a fold above 1 it can't be the child itself if it is abundant enough.
    top = lambda k: ends.groupBy("sample", k).agg(F.max("n").alias(f"{k}_n"))
    met = ends.join(top("_left"), ["sample", "_left"]).where(F.col("_left_n") >= min_fold * F.col("n"))
    met = met.join(top("_right"), ["sample", "_right"]).where(F.col("_right_n") >= min_fold * F.col("n"))
    flagged = met.select("sample", "_id").distinct().withColumn("flag", F.lit(1))
    return rows.select("sample", "seq", "n", "_id").join(flagged, ["sample", "_id"], "left").drop("_id")


def consensus(flagged: DataFrame, min_fraction: float = 0.9, ignore_negatives: int = 1) -> DataFrame:
    """(seq, n_samples, n_flagged, is_bimera) from the samples' flags (sample, seq, flag)."""
    votes = flagged.groupBy("seq").agg(F.count("*").alias("n_samples"), F.coalesce(F.sum("flag"), F.lit(0)).alias("n_flagged"))
    vote = (F.col("n_flagged") == F.col("n_samples")) | ((F.col("n_flagged") > 0) & (F.col("n_flagged") >= (F.col("n_samples") - ignore_negatives) * min_fraction))
    return votes.withColumn("is_bimera", vote)


def bimeras(counts: DataFrame, min_fold: float = 4, min_fraction: float = 0.9, ignore_negatives: int = 1) -> DataFrame:
    """(seq, n_samples, n_flagged, is_bimera): two-parent chimeras by consensus over the samples."""
    return consensus(flagged_in_samples(counts, min_fold), min_fraction, ignore_negatives)


def contaminant_hits(reads: DataFrame, refs: DataFrame, k: int = 31, distance: int = 0) -> DataFrame:
    """read_id and number of its distinct k-mers that a reference has, on either strand.

    With ``distance`` 1 the reference side, small by nature, also gets all one-base neighbours.
    """
    known = kmers.kmer_rows(refs, [], k, distinct=True, both_strands=True).distinct()
    if distance == 1:
        near = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(2 * k - 2), F.lit(2)), lambda i: F.transform(F.array(*[F.lit(c) for c in range(4)]), lambda c: F.col("kmer").bitwiseXOR(F.call_function("shiftleft", c.cast("long"), i)))))
        known = known.select(F.explode(near).alias("kmer")).distinct()
    elif distance:
        raise ValueError("distance is 0 or 1")
    known = if_small(known)
    own = kmers.kmer_rows(reads, ["read_id"], k, distinct=True, among=kmers.code_filter(known, "kmer"))
    return own.join(known, "kmer", "left_semi").groupBy("read_id").agg(F.count("*").alias("hits"))


def remove_contaminants(reads: DataFrame, refs: DataFrame, k: int = 31, min_share: float | None = None, distance: int = 0) -> DataFrame:
    """Reads without a k-mer of the references, or with less than ``min_share`` of their k-mers in them."""
    hits = contaminant_hits(reads, refs, k, distance)
    if min_share is not None:
        sizes = kmers.distinct_numbers(reads, ["read_id"], k).withColumnRenamed("n", "all")
        hits = hits.join(sizes, "read_id").where(F.col("hits") >= F.col("all") * min_share)
    return reads.join(hits.select("read_id"), "read_id", "left_anti")


def remove_contaminant_pairs(pairs: DataFrame, refs: DataFrame, k: int = 31, need: str = "either", distance: int = 0, min_share: float | None = None) -> DataFrame:
    """Pairs (pair_id, r1, r2) of which ``either`` or only if ``both`` mates hit a reference go.

    A mate hits by one k-mer, or with ``min_share`` by that share of its k-mers.
    """
    mates = pairs.select(F.explode(F.array(*[F.struct(F.col("pair_id"), F.lit(i).alias("mate"), F.col(f"r{i}.seq").alias("seq")) for i in (1, 2)])).alias("m")).select("m.*")
    mates = mates.withColumn("read_id", F.struct("pair_id", "mate"))
    hits = contaminant_hits(mates, refs, k, distance)
    if min_share is not None:
        sizes = kmers.distinct_numbers(mates, ["read_id"], k).withColumnRenamed("n", "all")
        hits = hits.join(sizes, "read_id").where(F.col("hits") >= F.col("all") * min_share)
    bad = hits.groupBy("read_id.pair_id").agg(F.count("*").alias("mates")).where(F.col("mates") >= (1 if need == "either" else 2))
    return pairs.join(bad, "pair_id", "left_anti")


def base_profile(reads: DataFrame, keys: list[str], qual: str) -> DataFrame:
    """(keys, pos, q1, median, n): lower quartile and median of the quality at every position.

    Batches count their qualities by key and position, so what is shuffled are counts, not bases.
    """
    own = reads.select(*keys, F.col(qual).alias("_qual"))
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[:-1]]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in dna.slices(batches):
            group = np.zeros(b.num_rows, np.int64)
            for c in keys:
                code = b.column(c).dictionary_encode(null_encoding="encode")
                group = np.unique(group * len(code.dictionary) + code.indices.to_numpy(zero_copy_only=False), return_inverse=True)[1]
            first = np.unique(group, return_index=True)[1]
            raw, offsets = dna.flat(b.column("_qual"))
            size = np.diff(offsets)
            owner = np.repeat(np.arange(len(size)), size)
            pos = np.arange(len(raw)) - offsets[owner]
            wide = int(size.max(initial=0))
            cell = (group[owner] * wide + pos) * 256 + raw
            if len(first) * wide * 256 <= 4 * len(raw) + (1 << 20):
                n = np.bincount(cell)
                cell = np.flatnonzero(n)
                n = n[cell]
            else:
                cell, n = np.unique(cell, return_counts=True)
            columns = [b.column(c).take(pa.array(first[cell // 256 // max(1, wide)])) for c in keys]
            yield pa.RecordBatch.from_arrays([*columns, pa.array((cell // 256 % max(1, wide) + 1).astype(np.int32)), pa.array((cell % 256).astype(np.int32) - 33), pa.array(n.astype(np.int64))], [*keys, "pos", "q", "n"])

    sums = own.mapInArrow(count, ", ".join([*kept, "pos int, q int, n long"])).groupBy(*keys, "pos", "q").agg(F.sum("n").alias("n"))
    return sums.groupBy(*keys, "pos").agg(F.percentile("q", F.lit(0.25), F.col("n")).alias("q1"), F.percentile("q", F.lit(0.5), F.col("n")).alias("median"), F.sum("n").alias("n"))


def denoise(counts: DataFrame, min_fold: float = 8.0, max_distance: int = 1) -> DataFrame:
    """(sample, seq, centre, n): each sequence joined to the sequence that explains it.

    A sequence goes to its most abundant neighbour, and with it to that one's centre: abundances rise by ``min_fold`` at
    each step, so chains are short, and following them by doubling ends after a number of joins that the fold gives.

    A neighbour has the same length, differs at ``max_distance`` = 1 place and is at least
    ``min_fold`` times as abundant; neighbours meet on the sequence with one place masked, so no
    pairs of all sequences are made. This is an abundance-ratio rule, not the divisive partition of
    an error model.
    """
    if max_distance != 1 or min_fold <= 1:
        raise ValueError("one difference and a fold above 1 are supported")
    rows = settle(counts.select("sample", "seq", "n"))  # read by four branches, so made once
    masked = rows.withColumn("_i", F.explode(F.sequence(F.lit(1), F.length("seq")))).select("sample", "seq", "n", F.concat(F.substr("seq", F.lit(1), F.col("_i") - 1), F.lit("*"), F.substr("seq", F.col("_i") + 1)).alias("_mask"))
    best = masked.groupBy("sample", "_mask").agg(F.max(F.struct("n", "seq")).alias("b"))
    near = masked.join(best, ["sample", "_mask"]).where((F.col("b.n") >= F.col("n") * min_fold) & (F.col("b.seq") != F.col("seq")))
    centre = near.groupBy("sample", "seq").agg(F.max(F.struct("b.n", "b.seq"))["seq"].alias("centre"))
    to = settle(rows.join(centre, ["sample", "seq"], "left").select("sample", "seq", "n", F.coalesce("centre", "seq").alias("centre")))
    longest = 63 / math.log2(min_fold)  # counts are below 2**63
    for _ in range(max(1, math.ceil(math.log2(longest)))):
        moved = to.where("centre <> seq")
        further = moved.select("sample", F.col("seq").alias("centre"), F.col("centre").alias("_next"))
        if not moved.join(further, ["sample", "centre"], "left_semi").limit(1).count():
            break
        to = settle(to.join(further, ["sample", "centre"], "left").select("sample", "seq", "n", F.coalesce("_next", "centre").alias("centre")))
    return to
