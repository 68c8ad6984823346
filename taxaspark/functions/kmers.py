"""K-mers of whole batches of sequences as numbers: two bits a base, in the order of the letters.

A k-mer of up to 31 bases is a long, so joins and groups move eight bytes for it, and codes order as
their texts do. K-mers with a letter other than A, C, G, T have no code and are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaspark.functions.dna import fixed

LARGEST = 31
_CODE = np.full(256, 4, np.uint8)
_CODE[[ord(c) for c in "ACGTacgt"]] = [0, 1, 2, 3] * 2


def text(code: Column, k: int) -> Column:
    """The bases of a code."""
    return F.translate(F.lpad(F.conv(code.cast("string"), 10, 4), k, "0"), "0123", "ACGT")


def _bases(seqs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all bases of the sequences one after the other, and the offsets of the sequences."""
    seqs = seqs.cast(pa.large_string()).fill_null("")
    _, ends, data = seqs.buffers()
    offsets = np.frombuffer(ends, np.int64)[seqs.offset : seqs.offset + len(seqs) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return _CODE[raw], offsets - offsets[0]


def _codes(bases: np.ndarray, k: int) -> np.ndarray:
    """Code of the k bases from each place on, as if all were one sequence of bases."""
    codes, width = bases.astype(np.int64) & 3, 1
    while width < k:
        step = min(width, k - width)
        codes = codes[: len(codes) - step] << 2 * step | codes[step:] & ((1 << 2 * step) - 1)
        width += step
    return codes


def windows(seqs: pa.Array, k: int, canonical: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, code) of every k-mer, in order; ``canonical`` takes the smaller of it and its reverse complement."""
    bases, offsets = _bases(seqs)
    n = len(bases) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes, back, width = bases.astype(np.int64) & 3, 3 - (bases.astype(np.int64) & 3), 1
    while width < k:  # by doubling
        step = min(width, k - width)
        left, right = codes[: len(codes) - step], codes[step:]
        if canonical:
            back = back[: len(back) - step] & ((1 << 2 * step) - 1) | back[step:] << 2 * step
        codes = left << 2 * step | right & ((1 << 2 * step) - 1)
        width += step
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    good = owner[:n] == owner[k - 1 :]
    if (bases > 3).any():
        bad = np.concatenate([[0], np.cumsum(bases > 3)])
        good &= bad[k:] == bad[:-k]
    codes = np.minimum(codes, back) if canonical else codes
    return owner[:n][good], codes[good]


def minimizers(seqs: pa.Array, k: int, l: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, canonical code) of the smallest l-mer of every k-mer; it is the smallest as it stands, then made canonical."""
    owner, codes = windows(seqs, l)
    wide, have = k - l + 1, 1
    n = len(codes) - wide + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    least = codes
    while have < wide:
        step = min(have, wide - have)
        least = np.minimum(least[: len(least) - step], least[step:])
        have += step
    whole, _ = windows(seqs, k)
    good = owner[:n] == owner[wide - 1 :]
    if len(whole) != int(good.sum()):  # letters without a code part the windows
        return _parted_minimizers(seqs, k, l)
    return owner[:n][good], canonical_codes(least[good], l)


def _parted_minimizers(seqs: pa.Array, k: int, l: int) -> tuple[np.ndarray, np.ndarray]:
    """The same where sequences hold other letters: each stretch of bases is a sequence of its own."""
    pieces, owners = [], []
    for i, s in enumerate(seqs.to_pylist()):
        for part in "".join(c if c in "ACGTacgt" else " " for c in s or "").split():
            pieces.append(part)
            owners.append(i)
    owner, codes = minimizers(pa.array(pieces, pa.string()), k, l)
    return np.array(owners, np.int64)[owner], codes


def turned_codes(codes: np.ndarray, k: int) -> np.ndarray:
    """Codes of the reverse complements."""
    back, rest = np.zeros_like(codes), codes.copy()
    for _ in range(k):
        back = back << 2 | 3 - (rest & 3)
        rest >>= 2
    return back


def canonical_codes(codes: np.ndarray, k: int) -> np.ndarray:
    """The smaller of each code and that of its reverse complement."""
    return np.minimum(codes, turned_codes(codes, k))


def _rows(rows: DataFrame, keep: list[str], schema: str, made: Callable[[pa.Array], tuple[np.ndarray, list[pa.Array]]], max_bytes: int = 1 << 20) -> DataFrame:
    """For every sequence (column seq) the rows that ``made`` gives, with the ``keep`` columns."""
    own = rows.select(*keep, F.col("seq").cast("string").alias("seq"))
    names = [c.split(" ")[0] for c in schema.split(", ")]
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            step = max(1, int(b.num_rows * max_bytes / max(1, b.nbytes)))
            for at in range(0, b.num_rows, step):
                part = b.slice(at, step)
                owner, columns = made(part.column("seq"))
                yield pa.RecordBatch.from_arrays([*(part.column(c).take(pa.array(owner)) for c in keep), *columns], [*keep, *names])

    return own.mapInArrow(run, ", ".join(x for x in (kept, schema) if x))


def _distinct(owner: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((codes, owner))
    owner, codes = owner[order], codes[order]
    new = np.ones(len(codes), bool)
    new[1:] = (codes[1:] != codes[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], codes[new]


def kmer_rows(rows: DataFrame, keep: list[str], k: int, distinct: bool = False, canonical: bool = False, both_strands: bool = False, among: np.ndarray | None = None) -> DataFrame:
    """(keep, kmer) for every k-mer of column seq; ``both_strands`` gives those of the reverse complement too.

    ``among``, a ``code_filter``, leaves out k-mers that surely aren't known, before anything is sorted or handed on.
    """
    if k > LARGEST:
        raise ValueError(f"k is at most {LARGEST}")

    def made(seqs: pa.Array) -> tuple[np.ndarray, list[pa.Array]]:
        owner, codes = windows(seqs, k, canonical)
        if both_strands:
            owner, codes = np.concatenate([owner, owner]), np.concatenate([codes, turned_codes(codes, k)])
        if among is not None:
            good = flagged(among, codes)
            owner, codes = owner[good], codes[good]
        owner, codes = _distinct(owner, codes) if distinct else (owner, codes)
        return owner, [pa.array(codes, pa.int64())]

    return _rows(rows, keep, "kmer long", made)


def distinct_numbers(rows: DataFrame, keep: list[str], k: int, canonical: bool = False) -> DataFrame:
    """(keep, n) with the number of distinct k-mers of every sequence."""

    def made(seqs: pa.Array) -> tuple[np.ndarray, list[pa.Array]]:
        owner, _ = _distinct(*windows(seqs, k, canonical))
        return np.arange(len(seqs)), [pa.array(np.bincount(owner, minlength=len(seqs)).astype(np.int64))]

    return _rows(rows, keep, "n long", made)


def minimizer_rows(rows: DataFrame, keep: list[str], k: int, l: int, distinct: bool = False, among: np.ndarray | None = None) -> DataFrame:
    """(keep, minimizer, first) for every k-mer: ``first`` is 1 where its minimizer isn't that of the k-mer before; ``among`` as in ``kmer_rows``."""

    def made(seqs: pa.Array) -> tuple[np.ndarray, list[pa.Array]]:
        owner, codes = minimizers(seqs, k, l)
        owner, codes = _distinct(owner, codes) if distinct else (owner, codes)
        first = np.ones(len(codes), np.int32)
        first[1:] = (codes[1:] != codes[:-1]) | (owner[1:] != owner[:-1])
        if among is not None:
            good = flagged(among, codes)
            owner, codes, first = owner[good], codes[good], first[good]
        return owner, [pa.array(codes, pa.int64()), pa.array(first)]

    return _rows(rows, keep, "minimizer long, first int", made)


def least_rows(rows: DataFrame, keep: list[str], k: int, l: int) -> DataFrame:
    """(keep, pos, minimizer) for every k-mer of bases only: its place from 1 and the smallest l-mer in it, as it stands, as text."""

    def made(seqs: pa.Array) -> tuple[np.ndarray, list[pa.Array]]:
        bases, offsets = _bases(seqs)
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        n, wide = len(bases) - k + 1, k - l + 1
        if n <= 0:
            return np.zeros(0, np.int64), [pa.array([], pa.int32()), pa.array([], pa.string())]
        least, have = _codes(bases, l), 1
        while have < wide:
            step = min(have, wide - have)
            least = np.minimum(least[: len(least) - step], least[step:])
            have += step
        good = owner[:n] == owner[k - 1 :]
        if (bases > 3).any():
            bad = np.concatenate([[0], np.cumsum(bases > 3)])
            good &= bad[k:] == bad[:-k]
        at = np.flatnonzero(good)
        letters = np.frombuffer(b"ACGT", np.uint8)[(least[at][:, None] >> np.arange(2 * l - 2, -1, -2)) & 3]
        return owner[at], [pa.array((at - offsets[owner[at]] + 1).astype(np.int32)), fixed(letters)]

    return _rows(rows, keep, "pos int, minimizer string", made)


#: Bits of a filter of known codes, in buckets as Spark's bitmaps have them (2 MB, whatever the number of codes).
FILTER = 1 << 24


def _places(codes: np.ndarray) -> np.ndarray:
    return ((codes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64)


def code_filter(known: DataFrame, column: str) -> np.ndarray:
    """Flags of the places (hashes of 24 bits) of the codes in ``column``: what isn't flagged is surely not among them.

    Spark makes the bits; what comes to the driver has at most ``FILTER`` bits. Many codes flag all places, and then nothing is left out.
    """

    @F.pandas_udf("long")
    def place(codes: pd.Series) -> pd.Series:
        return pd.Series(_places(codes.to_numpy(np.int64)))

    rows = known.where(F.col(column).isNotNull()).select(place(F.col(column)).alias("p"))
    bits = rows.groupBy(F.bitmap_bucket_number("p").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("m")).toPandas()
    out = np.zeros(FILTER + (1 << 15), np.uint8)
    for b, m in zip(bits["b"].tolist(), bits["m"].tolist(), strict=True):
        # Bucket 1 begins at 1, bucket 0 holds 0 alone.
        part = np.unpackbits(np.frombuffer(bytes(m), np.uint8), bitorder="little")
        at = (b - 1) * len(part) + 1 if b else 0
        out[at : at + len(part)] |= part if b else part * (np.arange(len(part)) == 0).astype(np.uint8)
    return np.packbits(out)


def flagged(found: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Whether the places of codes are flagged."""
    at = _places(codes)
    return (found[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0


def rows_with(rows: DataFrame, k: int, among: np.ndarray, max_bytes: int = 1 << 17) -> DataFrame:
    """``rows`` without those whose column seq surely has no known k-mer. ``among`` is a ``code_filter`` of known k-mers and their reverse complements.

    Both of a k-mer and its reverse complement have to be flagged; parts of a batch are so small that their codes stay in the cache.
    """
    if k > LARGEST:
        raise ValueError(f"k is at most {LARGEST}")

    def known(seqs: pa.Array) -> np.ndarray:
        out = np.zeros(len(seqs), bool)
        bases, offsets = _bases(seqs)
        if len(bases) < k:
            return out
        codes = _codes(bases, k)
        at = np.flatnonzero(flagged(among, codes))
        at = at[flagged(among, turned_codes(codes[at], k))]
        owner = np.searchsorted(offsets, at, "right") - 1
        bad = np.concatenate([[0], np.cumsum(bases > 3)])
        out[owner[(at + k <= offsets[owner + 1]) & (bad[at + k] == bad[at])]] = True
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            step = max(1, int(b.num_rows * max_bytes / max(1, b.nbytes)))
            parts = [known(b.column("seq").slice(at, step)) for at in range(0, b.num_rows, step)]
            if any(p.any() for p in parts):
                yield b.filter(pa.array(np.concatenate(parts)))

    return rows.mapInArrow(run, rows.schema)
