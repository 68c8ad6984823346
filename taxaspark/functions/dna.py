"""Column functions on nucleotide strings and Phred qualities, all built-in expressions, and what is done for whole Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaspark.functions.expr import let

# The IUPAC codes, their complements and what each stands for.
IUPAC = "ACGTRYKMBDHVNSW"
COMPLEMENT = "TGCAYRMKVHDBNSW"
MEANING = {"A": "A", "C": "C", "G": "G", "T": "T", "R": "AG", "Y": "CT", "S": "CG", "W": "AT", "K": "GT", "M": "AC", "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT"}


def reverse_complement(seq: Column) -> Column:
    """Complement of the reversed sequence, IUPAC codes included."""
    return F.translate(F.reverse(seq), IUPAC, COMPLEMENT)


def reverse_complement_text(seq: str) -> str:
    """The same for a literal, such as a primer."""
    return seq[::-1].translate(str.maketrans(IUPAC, COMPLEMENT))


def iupac_regex(primer: str) -> str:
    """Regular expression of the sequences that a primer stands for."""
    return "".join(m if len(m := MEANING[c]) == 1 else f"[{m}]" for c in primer.upper())


def pseudo_dna(text: Column) -> Column:
    """Deterministic nucleotides from prose: letters a-z dealt to A, C, G, T in turn; others go."""
    letters = F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), "[^A-Za-z]", ""))
    return F.upper(F.translate(letters, "abcdefghijklmnopqrstuvwxyz", ("acgt" * 7)[:26]))


_LETTERS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_DEALT = bytes.maketrans(_LETTERS, 2 * (b"ACGT" * 7)[:26])
_OTHERS = bytes(set(range(256)) - set(_LETTERS))
#: Bytes of sequences that are worked on at once.
BATCH = 4 << 20


def letters(texts: pa.Array) -> pa.Array:
    """``pseudo_dna`` of a batch."""
    return pa.array([b"" if t is None else t.translate(_DEALT, _OTHERS) for t in texts.cast(pa.binary()).to_pylist()], pa.binary()).cast(pa.string())


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of batches that have about ``BATCH`` bytes each, one row at least."""
    for b in batches:
        step = max(1, int(b.num_rows * BATCH / max(1, b.nbytes)))
        for at in range(0, b.num_rows, step):
            yield b.slice(at, step)


def from_prose(rows: DataFrame) -> DataFrame:
    """``rows`` with the nucleotides that ``pseudo_dna`` makes of column seq, in the last place."""
    own = rows.select(*[c for c in rows.columns if c != "seq"], F.col("seq").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], letters(b.column("seq"))], names=b.schema.names)

    return own.mapInArrow(run, own.schema)


def fixed(data: np.ndarray, offsets: np.ndarray | None = None) -> pa.Array:
    """Strings of a matrix's rows (bytes), or of flat bytes between ``offsets``."""
    if offsets is None:
        offsets = np.arange(len(data) + 1, dtype=np.int64) * (data.shape[1] if data.ndim == 2 else 0)
    flat = np.ascontiguousarray(data).reshape(-1)
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(flat)).cast(pa.string())


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all strings one after the other, null ones as empty, and their offsets."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, ends, data = texts.buffers()
    offsets = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def tiles(rows: DataFrame, length: int, whole: bool = False, prose: bool = False, quality: tuple[str, str] | None = None) -> DataFrame:
    """``rows`` with tile (from 0) and seq: sequences of one-byte letters as consecutive pieces, cut in one pass; none for an empty one.

    The last piece may be shorter; with ``whole`` it then goes. With ``prose`` seq is text, whose nucleotides are cut. ``quality``
    adds qual, in which the first letters stand as the second.
    """
    table = None if quality is None else np.frombuffer(bytes.maketrans(*(x.encode() for x in quality)), np.uint8)
    keep = [c for c in rows.columns if c != "seq"]
    own = rows.select(*keep, F.col("seq").cast("string"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            raw, offsets = flat(letters(b.column("seq")) if prose else b.column("seq"))
            size = np.diff(offsets)
            n = size // length if whole else -(-size // length)
            owner = np.repeat(np.arange(len(n)), n)
            tile = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
            start = offsets[owner] + tile * length
            cut = raw[start[:, None] + np.arange(length)] if whole else raw
            ends = None if whole else np.append(start, offsets[-1])
            made = [fixed(cut, ends), *([fixed(table[cut], ends)] if quality else [])]
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(pa.array(owner)) for c in keep), pa.array(tile.astype(np.int32)), *made], [*keep, "tile", "seq", *(["qual"] if quality else [])])

    return own.mapInArrow(run, ", ".join([*([kept] if keep else []), "tile int, seq string", *(["qual string"] if quality else [])]))


#: Error probability of a quality letter (offset 33).
ERRORS = np.array([10.0 ** (-(c - 33) / 10.0) for c in range(256)])


def summed_errors(raw: np.ndarray, offsets: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sum of the error probabilities of the first ``size`` letters of each quality string, added from left to right."""
    out, order = np.zeros(len(size)), np.argsort(size, kind="stable")
    at = 0
    while at < len(order):
        # Strings of about one length are added place by place; a part has few places that only some of them have.
        stop = at + max(1, int(np.searchsorted(size[order[at:]], max(64, 2 * size[order[at]]), "right")))
        own = order[at:stop]
        total = np.zeros(len(own))
        for j in range(int(size[own[-1]])):
            live = int(np.searchsorted(size[own], j, "right"))
            total[live:] += ERRORS[raw[offsets[own[live:]] + j]]
        out[own] = total
        at = stop
    return out


def kmers(seq: Column, k: int) -> Column:
    """All k-mers in order of position (overlapping), by a look-ahead match."""
    return F.regexp_extract_all(seq, F.lit(f"(?s)(?=(.{{{k}}}))"), 1)


def canonical(kmer: Column) -> Column:
    """The smaller of a k-mer and its reverse complement."""
    return F.least(kmer, reverse_complement(kmer))


def minimizers(seq: Column, k: int, l: int) -> Column:
    """Smallest l-mer of each window of k bases, one for each k-mer."""
    return sliding_min(kmers(seq, l), k - l + 1)


def sliding_min(values: Column, width: int) -> Column:
    """Smallest of every ``width`` neighbours of an array, by doubling; none for shorter arrays."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values = let(values, _least_of_two(step))
        have += step
    return values


def _least_of_two(step: int):
    """Each value or the one ``step`` places on, whichever is smaller, as far as both exist."""

    def join(a: Column) -> Column:
        n = F.greatest(F.size(a) - step, F.lit(0))
        return F.slice(F.zip_with(a, F.slice(a, F.lit(step + 1), n), lambda x, y: F.least(x, y)), F.lit(1), n)

    return join


def phred(qual: Column) -> Column:
    """Qualities of the positions (offset 33)."""
    return let(qual, lambda q: F.transform(F.sequence(F.lit(1), F.length(q)), lambda i: F.ascii(F.substr(q, i, F.lit(1))) - 33))


def expected_errors(qual: Column) -> Column:
    """Sum of the error probabilities of all positions; 0 for an empty string."""
    each = F.when(F.length(qual) > 0, F.transform(phred(qual), lambda q: F.pow(F.lit(10.0), -q / 10.0))).otherwise(F.array().cast("array<double>"))
    return F.aggregate(each, F.lit(0.0), lambda a, x: a + x)


def first_bad_base(qual: Column, trunc_q: int) -> Column:
    """1-based position of the first quality at or below ``trunc_q``; null if there is none."""
    return F.nullif(F.regexp_instr(qual, F.lit(f"[\\x21-\\x{33 + trunc_q:02x}]")), F.lit(0))
