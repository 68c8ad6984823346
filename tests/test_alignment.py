"""Gapped primer matches and merges against plain dynamic programmes."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from taxaspark.functions import dna
from taxaspark.operators import alignment as A


def plain_span(text, primer, rate, partial=0):
    """Errors and shortest length of every prefix of the primer ending at every place."""
    m, n = len(primer), len(text)
    cell = {(i, 0): (i, 0) for i in range(m + 1)} | {(0, j): (0, 0) for j in range(n + 1)}
    for j in range(1, n + 1):
        for i in range(1, m + 1):
            miss = int(text[j - 1] not in dna.MEANING[primer[i - 1]])
            ways = [(cell[i - 1, j - 1][0] + miss, cell[i - 1, j - 1][1] + 1), (cell[i, j - 1][0] + 1, cell[i, j - 1][1] + 1), (cell[i - 1, j][0] + 1, cell[i - 1, j][1])]
            cell[i, j] = min(ways)
    whole = [(cell[m, j][0], j, cell[m, j][1]) for j in range(1, n + 1) if cell[m, j][0] <= int(rate * m + 1e-9)]
    if whole:
        errors, stop, size = min(whole)
        return (stop - size, stop, errors)
    for i in range(m - 1, partial - 1, -1):
        if partial and cell[i, n][0] <= int(rate * i + 1e-9) and cell[i, n][1]:
            return (n - cell[i, n][1], n, cell[i, n][0])
    return None


@pytest.mark.parametrize("rate,partial", [(0.0, 0), (0.2, 0), (0.2, 3), (0.34, 2)])
def test_spans_equal_plain(rate, partial):
    rng = random.Random(int(rate * 100) + partial)
    primer = "GTGYCAGCMG"
    texts = ["", "G", primer.replace("Y", "C").replace("M", "A"), "N" * 20]
    for _ in range(300):
        body = list("".join(rng.choice("ACGT") for _ in range(rng.randint(0, 30))))
        own = [rng.choice(dna.MEANING[c]) for c in primer]
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(own))
            rng.choice([lambda k=k: own.pop(k), lambda k=k: own.insert(k, rng.choice("ACGT")), lambda k=k: own.__setitem__(k, rng.choice("ACGTN"))])()
        at = rng.randint(0, len(body))
        text = "".join(body[:at] + own + body[at:])
        texts += [text, text[: at + rng.randint(0, len(own))]]
    start, stop, errors = A.spans(texts, primer, rate, partial)
    got = [None if s < 0 else (s, e, x) for s, e, x in zip(start.tolist(), stop.tolist(), errors.tolist(), strict=True)]
    assert got == [plain_span(t, primer, rate, partial) for t in texts]


def plain_score(a, b):
    """Best score of an alignment with free ends."""
    row = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            row[i][j] = max(row[i - 1][j - 1] + (A.MATCH if a[i - 1] == b[j - 1] else A.MISS), row[i - 1][j] + A.MISS, row[i][j - 1] + A.MISS)
    return max([row[len(a)][j] for j in range(len(b) + 1)] + [row[i][len(b)] for i in range(len(a) + 1)])


def test_alignments_have_the_best_score():
    rng = random.Random(3)
    pairs = [("", "ACG"), ("ACG", ""), ("ACGT", "ACGT")]
    for _ in range(60):
        s = "".join(rng.choice("ACGT") for _ in range(40))
        a, b = s[: rng.randint(20, 40)], s[rng.randint(0, 20) :]
        pairs.append((a, b[:10] + rng.choice(["", "A"]) + b[11:]))
    _, best, _ = A.aligned(*map(list, zip(*pairs, strict=True)))
    assert best.tolist() == [plain_score(a, b) for a, b in pairs]


def merged(spark, a, b, qa=None, qb=None, **options):
    rc = dna.reverse_complement_text(b)
    row = [(1, (a, qa or "I" * len(a)), (rc, (qb or "I" * len(b))[::-1]))]
    df = spark.createDataFrame(row, "id int, r1 struct<seq: string, qual: string>, r2 struct<seq: string, qual: string>")
    got = A.merge_pairs_aligned(df, **options).first()
    return got and (got["merged"], got["overlap"], got["errors"])


def test_merges(spark):
    s = "ACGTTGCAAGCTTACGGATCCATTGACCAGTCA"
    assert merged(spark, s[:25], s[8:]) == (s, 17, 0)
    wrong = s[:20] + "T" + s[21:25]
    assert merged(spark, wrong, s[8:]) is None
    assert merged(spark, wrong, s[8:], max_mismatch=1) == (s[:20] + "T" + s[21:], 16, 1)
    assert merged(spark, wrong, s[8:], qa="#" * 25, max_mismatch=1) == (s, 16, 1)
    gap = s[:20] + s[21:28]
    assert merged(spark, gap, s[6:], max_mismatch=1)[1:] == (21, 1)
    # fragments shorter than the reads: mates run past each other's beginnings
    long1, long2 = s + "GGGGG", "TTTTT" + s
    assert merged(spark, long1, long2, trim_overhang=True) == (s, len(s), 0)
    assert merged(spark, long1, long2)[0] == "TTTTT" + s + "GGGGG"
    assert merged(spark, s[:15], s[10:], min_overlap=12) is None and merged(spark, s[:15], s[10:], min_overlap=5) == (s, 5, 0)


def test_trimming_with_gaps_and_cut_off_primers(spark):
    f, r = "GTGYCAGCMGCCGCGG", "GGACTACNVGGGTWTC"
    rng = random.Random(5)
    body = "".join(rng.choice("ACGT") for _ in range(60))
    fwd, rev = "GTGCCAGCAGCCGCGG", "GGACTACAAGGGTATC"
    frag = fwd + body + dna.reverse_complement_text(rev)
    back = dna.reverse_complement_text(frag)
    reads = [
        (1, frag, back),  # read through
        (2, frag[: len(fwd) + 60 + 5], back[:70]),  # five bases of the other primer
        (3, fwd[:6] + fwd[7:] + body, rev[:8] + "A" + rev[8:] + dna.reverse_complement_text(body)),  # a deletion, an insertion
        (4, body, back),  # no forward primer
    ]
    df = spark.createDataFrame(reads, "id int, a string, b string").select("id", *[F.struct(F.col(c).alias("seq"), F.col(c).alias("qual")).alias(n) for c, n in (("a", "r1"), ("b", "r2"))])
    got = {x["id"]: x for x in A.trim_primers_gapped(df, f, r).collect()}
    assert set(got) == {1, 2, 3}
    assert got[1]["r1"]["seq"] == got[2]["r1"]["seq"] == got[3]["r1"]["seq"] == body
    assert got[1]["r2"]["seq"] == got[3]["r2"]["seq"] == dna.reverse_complement_text(body)
    assert all(x["r1"]["seq"] == x["r1"]["qual"] for x in got.values())


def test_clear_overlaps_are_those_of_the_programme():
    rng = np.random.default_rng(1)
    draw = lambda n, p=None: "".join(rng.choice(list("ACGT"), n, p=p))
    first, second = [], []
    for t in range(600):
        s, n = draw(100, [0.5, 0.3, 0.1, 0.1] if t % 3 == 0 else None), int(rng.integers(10, 100))
        if t % 5 == 0:
            s = draw(int(rng.integers(1, 12))) * 100
        if t % 2:
            first, second = [*first, s[:80]], [*second, s[20:100]]
        else:
            first, second = [*first, s[: int(rng.integers(1, n + 1))]], [*second, s[int(rng.integers(0, n)) : n]]
    sure, offset, same = A.clear_overlaps(first, second)
    assert sure[1::2].mean() > 0.6
    ends, _, steps = A.aligned(first, second)
    for x in np.flatnonzero(sure):
        for trim in (True, False):
            want = A.merged_mate(first[x], "I" * len(first[x]), second[x], "I" * len(second[x]), ends[x], steps[x], trim)
            assert (A._joined(first[x], second[x], int(offset[x]), trim), same[x], 0) == want[:3]
    many = [draw(100) for _ in range(4096)]
    assert A.clear_overlaps([s[:80] for s in many], [s[20:] for s in many])[0].mean() > 0.99
