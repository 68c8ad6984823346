"""Alignments of reads with primers and of mates with each other, for whole Arrow batches at once.

Both are dynamic programmes whose cells are arrays over the reads of a batch, so a batch costs as many array
operations as one pair has rows or diagonals. Spark deals the reads; nothing here sees more than a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaspark.functions import dna

_MASK = np.zeros(256, np.uint8)
for _k, _c in enumerate("ACGT"):
    _MASK[ord(_c)] = 1 << _k
SPAN = "start int, stop int, errors int"


def _padded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters (rows, longest) and lengths."""
    length = np.fromiter(map(len, texts), np.int64, len(texts))
    out = np.zeros((len(texts), int(length.max(initial=0))), np.uint8)
    out[np.arange(out.shape[1]) < length[:, None]] = np.frombuffer("".join(texts).encode("ascii", "replace"), np.uint8)
    return out, length


def spans(texts: list[str], primer: str, error_rate: float, partial: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """0-based start, stop and errors of a primer in each text; start is -1 where it isn't found.

    Errors are mismatches, insertions and deletions; a match has at most floor(error_rate * length) of them. Of the matches
    the one with the fewest errors counts, of these the one that ends first, and of these the shortest. Without any, and
    with ``partial`` > 0, the longest beginning of the primer, of at least ``partial`` bases, that the text ends with.
    IUPAC codes stand in the primer only.
    """
    letters, length = _padded(texts)
    wide = 1 << 20
    n, m = len(texts), len(primer)
    allowed = int(error_rate * m + 1e-9)
    codes = np.array([sum(1 << "ACGT".index(x) for x in dna.MEANING[c]) for c in primer.upper()], np.uint8)
    masks = _MASK[letters]
    # A cell is errors * wide + (bases from the start on): the fewest errors, then the shortest match.
    column = [np.full(n, i * wide, np.int64) for i in range(m + 1)]
    best, end = np.full(n, (allowed + 1) * wide, np.int64), np.full(n, -1)
    last = [c.copy() for c in column]
    good = lambda j: np.maximum(length >= j, 0).astype(bool)
    for j in range(1, letters.shape[1] + 1):
        now = [np.zeros(n, np.int64)]
        for i in range(1, m + 1):
            miss = ((masks[:, j - 1] & codes[i - 1]) == 0) * wide
            now.append(np.minimum(np.minimum(column[i - 1] + miss + 1, column[i] + wide + 1), now[i - 1] + wide))
        column = now
        here = good(j)
        better = here & (column[m] // wide < best // wide)
        best, end = np.where(better, column[m], best), np.where(better, j, end)
        for i in range(m + 1):
            last[i] = np.where(here, column[i], last[i])
    found = end >= 0
    start, stop, errors = np.where(found, end - best % wide, -1), end, np.where(found, best // wide, 0)
    if partial > 0:
        for i in range(m - 1, partial - 1, -1):
            fits = ~found & (last[i] // wide <= int(error_rate * i + 1e-9)) & (last[i] % wide > 0)
            start, stop, errors = np.where(fits, length - last[i] % wide, start), np.where(fits, length, stop), np.where(fits, last[i] // wide, errors)
            found |= fits
    return start, stop, errors


def primer_span(seq: Column, primer: str, error_rate: float, partial: int = 0) -> Column:
    """The same as a column (start, stop, errors), 1-based start and last base of the match; null if there is none or no sequence."""

    @F.pandas_udf(SPAN)
    def find(s: pd.Series) -> pd.DataFrame:
        start, stop, errors = spans(s.fillna("").tolist(), primer, error_rate, partial)
        out = pd.DataFrame({"start": start + 1, "stop": stop, "errors": errors}).astype("Int32")
        out[start < 0] = pd.NA
        return out

    got = find(seq)
    return F.when(got["start"].isNotNull(), got)


def trim_primers_gapped(pairs: DataFrame, forward: str, reverse: str, error_rate: float = 0.2, min_len: int = 50, partial: int = 3) -> DataFrame:
    """Pairs after their 5' primers, which both must have, and before the other's primer at the 3' ends, which may be cut off by the read's end."""

    def cut(read: str, start: Column, length: Column | None) -> Column:
        return F.struct(*[(F.substr(F.col(f"{read}.{f}"), start) if length is None else F.substr(F.col(f"{read}.{f}"), start, length)).alias(f) for f in ("seq", "qual")])

    rows = pairs
    for name, primer in (("r1", forward), ("r2", reverse)):
        rows = rows.withColumn("_at", primer_span(F.col(f"{name}.seq"), primer, error_rate)).where("_at IS NOT NULL").withColumn(name, cut(name, F.col("_at.stop") + 1, None))
    for name, primer in (("r1", reverse), ("r2", forward)):
        rows = rows.withColumn("_at", primer_span(F.col(f"{name}.seq"), dna.reverse_complement_text(primer), error_rate, partial))
        rows = rows.withColumn(name, F.when(F.col("_at").isNull(), F.col(name)).otherwise(cut(name, F.lit(1), F.col("_at.start") - 1)))
    return rows.drop("_at").where((F.length("r1.seq") >= min_len) & (F.length("r2.seq") >= min_len))


#: Scores of a merge: as a mismatch or gap costs eight matches, only close overlaps win.
MATCH, MISS = 1, -8
DIAGONAL, UP, LEFT = 1, 2, 3


def aligned(first: list[str], second: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best alignment of each two texts with free ends: where it ends in both, and the steps (rows, positions of first + 1, of second + 1).

    Of equal scores a diagonal step goes before one along the first text, this before one along the second; of equal
    ends the longest first text counts, then the longest second.
    """
    a, la = _padded(first)
    b, lb = _padded(second)
    n, wa, wb = len(first), a.shape[1], b.shape[1]
    low = -(1 << 30)
    steps = np.zeros((n, wa + 1, wb + 1), np.uint8)
    before, last = np.zeros((n, wa + 1), np.int32), np.zeros((n, wa + 1), np.int32)  # diagonals i + j = d - 2 and d - 1, by i
    best, bi, bj = np.full(n, low), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for d in range(1, wa + wb + 1):
        now = np.zeros((n, wa + 1), np.int32)  # free ends: 0 along both borders
        i = np.arange(max(1, d - wb), min(wa, d - 1) + 1)
        if len(i):
            j = d - i
            same = a[:, i - 1] == b[:, j - 1]
            straight = before[:, i - 1] + np.where(same, MATCH, MISS).astype(np.int32)
            up, left = last[:, i - 1] + MISS, last[:, i] + MISS
            top = np.maximum(np.maximum(straight, up), left)
            now[:, i] = top
            steps[:, i, j] = np.where(straight == top, DIAGONAL, np.where(up == top, UP, LEFT))
        i = np.arange(max(0, d - wb), min(wa, d) + 1)
        j = d - i
        ends = ((i == la[:, None]) & (j <= lb[:, None])) | ((j == lb[:, None]) & (i <= la[:, None]))
        score = np.where(ends, now[:, i], low)
        top = len(i) - 1 - score[:, ::-1].argmax(1)
        value = score[np.arange(n), top]
        better = (value > best) | ((value == best) & (value > low) & ((i[top] > bi) | ((i[top] == bi) & (j[top] > bj))))
        best, bi, bj = np.where(better, value, best), np.where(better, i[top], bi), np.where(better, j[top], bj)
        before, last = last, now
    return np.stack([bi, bj], 1), best, steps


def merged_mate(a: str, qa: str, b: str, qb: str, end: np.ndarray, steps: np.ndarray, trim_overhang: bool) -> tuple[str, int, int, bool]:
    """Consensus of two aligned texts, matches, errors, and whether either runs past the other's beginning.

    Where they differ the base of higher quality counts, ties by the first; a gap counts as quality 0.
    """
    i, j = int(end[0]), int(end[1])
    tail = a[i:] + b[j:]
    middle, match, errors = [], 0, 0
    over = len(a) > i  # the first runs past the end of the second
    while i and j:
        step = steps[i, j]
        if step == DIAGONAL:
            i, j = i - 1, j - 1
            match, errors = match + (a[i] == b[j]), errors + (a[i] != b[j])
            middle.append(a[i] if a[i] == b[j] or qa[i] >= qb[j] else b[j])
        elif step == UP:
            i, errors = i - 1, errors + 1
            middle.append(a[i])
        else:
            j, errors = j - 1, errors + 1
            middle.append(b[j])
    head = a[:i] + b[:j]
    body = "".join(reversed(middle))
    over_start = j > 0
    if trim_overhang:
        return ("" if over_start else head) + body + ("" if over else tail), match, errors, over or over_start
    return head + body + tail, match, errors, over or over_start


_TURNED = str.maketrans(dna.IUPAC, dna.COMPLEMENT)


def _planes(texts: list[str], words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two bit planes (plane, word, row) of the bases, lengths, and rows that hold nothing but A, C, G, T."""
    letters, length = _padded(texts)
    wide = np.zeros((len(texts), words * 64), np.uint8)
    wide[:, : letters.shape[1]] = letters
    bits = lambda x: np.packbits(x, axis=1, bitorder="little").view(np.uint64).T.copy()
    pure = (_MASK[letters] > 0).sum(1) == length
    return np.stack([bits((wide == ord("C")) | (wide == ord("T"))), bits((wide == ord("G")) | (wide == ord("T")))]), length, pure


def _down(x: np.ndarray, by: int) -> np.ndarray:
    """Words (first axis but one) moved down by so many bits."""
    whole, rest = divmod(by, 64)
    out = np.zeros_like(x)
    n = x.shape[-2] - whole
    if n > 0:
        out[..., :n, :] = x[..., whole:, :] >> np.uint64(rest)
        if rest:
            out[..., : n - 1, :] |= x[..., whole + 1 :, :] << np.uint64(64 - rest)
    return out


def clear_overlaps(first: list[str], second: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs whose best alignment, as ``aligned`` finds it, surely is an overlap without error: whether, places of the first before the second, bases.

    Let one diagonal have all its T bases equal, and every other whole diagonal a lower score. A better or equal alignment with a gap has
    e errors, T + 8e equal bases in at most e + 1 runs, and e <= (m - T) / 8, where m is the shorter length. Its longest run has
    (T + 8e) / (e + 1) bases; if no other diagonal has such a run, it lies on the clear one, which has T. The other 8e lie in at
    most e runs on diagonals at most e away, so one of these has a run of 8. Where neither is found, no such alignment exists.
    All pairs of a batch are compared at once, 64 bases in a word.
    """
    words = max(1, -(-max(map(len, [*first, *second]), default=1) // 64))
    (a, la, pure), (b, lb, also) = _planes(first, words), _planes(second, words)
    least, n = np.minimum(la, lb), len(first)
    offsets = np.arange(-int(lb.max(initial=0)) + 1, int(la.max(initial=0)))
    filled = np.packbits(np.arange(words * 64) < np.arange(words * 64 + 1)[:, None], axis=1, bitorder="little").view(np.uint64).T
    run8, run16 = np.zeros((2, len(offsets), n), bool)
    best, at, perfect = np.zeros(n, np.int64), np.full(n, -1), np.zeros(n, bool)
    twice = np.zeros(n, bool)
    for k, d in enumerate(offsets.tolist()):
        size = np.maximum(np.minimum(la - max(d, 0), lb - max(-d, 0)), 0)
        x, y = (_down(a, d), b) if d >= 0 else (a, _down(b, -d))
        same = ~((x[0] ^ y[0]) | (x[1] ^ y[1])) & filled[:, size]
        hits = np.bitwise_count(same).sum(0, dtype=np.int64)
        value = hits * MATCH + (size - hits) * MISS
        twice = np.where(value > best, False, twice | ((value == best) & (value > 0)))
        better = value > best
        best, at, perfect = np.where(better, value, best), np.where(better, k, at), np.where(better, hits == size, perfect)
        for step in (1, 2, 4):
            same = same & _down(same, step)
        run8[k] = same.any(0)
        run16[k] = (same & _down(same, 8)).any(0)
    sure = pure & also & perfect & ~twice & (at >= 0)
    most = np.maximum(least - best, 0) // -MISS  # errors that a gapped alignment may have
    run = 8 + np.minimum((best - 8) / (most + 1), (best - 8) / 2)  # least (T + 8e) / (e + 1)
    long16, long8 = run > 15, run > 7
    there = np.arange(len(offsets))[:, None] == at
    other16, other8 = (run16 & ~there).any(0), (run8 & ~there).any(0)
    near = ((run8 & ~there) & (np.abs(np.arange(len(offsets))[:, None] - at) <= most)).any(0)
    sure &= (most == 0) | (~near & ((long16 & ~other16) | (long8 & ~other8)))
    return sure, np.where(sure, offsets[np.maximum(at, 0)] if len(offsets) else 0, 0), np.where(sure, best, 0)


def _joined(a: str, b: str, d: int, trim_overhang: bool) -> str:
    """Two texts of which ``b`` starts ``d`` places after the start of ``a`` and that are equal where both stand."""
    if d >= 0:
        whole = a + b[len(a) - d :]
        return whole[: d + len(b)] if trim_overhang and d + len(b) < len(a) else whole
    size = min(len(a), len(b) + d)
    head = "" if trim_overhang else b[:-d]
    if size == len(a):
        return head + a + b[len(a) - d :]
    return head + (a[:size] if trim_overhang else a)


def merge_pairs_aligned(pairs: DataFrame, min_overlap: int = 12, max_mismatch: int = 0, trim_overhang: bool = False) -> DataFrame:
    """``pairs`` with ``merged``, ``overlap`` and ``errors``: mate 1 aligned with the reverse complement of mate 2, gaps included.

    Pairs with fewer than ``min_overlap`` matching bases or more than ``max_mismatch`` mismatches and gaps go. Where the mates run
    past each other's beginnings, ``trim_overhang`` cuts what exceeds. The mates' bases of higher quality make the consensus.
    """

    @F.pandas_udf("merged string, overlap int, errors int")
    def merge(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            every = [x.fillna("").tolist() for x in batch]
            every[2] = [x[::-1].translate(_TURNED) for x in every[2]]
            out: list = [None] * len(every[0])
            for k in range(0, len(out), 4096):
                one, two = every[0][k : k + 4096], every[2][k : k + 4096]
                sure, offset, same = clear_overlaps(one, two)
                for x in np.flatnonzero(sure).tolist():
                    text, match = _joined(one[x], two[x], int(offset[x]), trim_overhang), int(same[x])
                    out[k + x] = (text if match >= min_overlap and max_mismatch >= 0 else None, match, 0)
            alike: dict[tuple, int] = {}  # copies are aligned once
            copies = {x: alike.setdefault(tuple(y[x] for y in every), x) for x, row in enumerate(out) if row is None}
            rest = list(alike.values())
            for k in range(0, len(rest), 64):
                own = rest[k : k + 64]
                part = [[x[i] for i in own] for x in every]
                ends, _, steps = aligned(part[0], part[2])
                for x, (a, qa, b, qb) in enumerate(zip(*part, strict=True)):
                    text, match, errors, _ = merged_mate(a, qa, b, qb, ends[x], steps[x], trim_overhang)
                    out[own[x]] = (text if match >= min_overlap and errors <= max_mismatch else None, match, errors)
            for x, y in copies.items():
                out[x] = out[y]
            yield pd.DataFrame(out, columns=["merged", "overlap", "errors"])

    got = merge(F.col("r1.seq"), F.col("r1.qual"), F.col("r2.seq"), F.reverse("r2.qual"))
    return pairs.withColumn("_m", got).where("_m.merged IS NOT NULL").select(*[F.col(f"`{c}`") for c in pairs.columns], "_m.merged", "_m.overlap", "_m.errors")
