"""The bounded search against a count of all pairs."""

import random

import pytest

from taxaspark.functions import dna
from taxaspark.operators import search

K = 6
REFS, QUERIES = "ref_id long, seq string", "query_id long, seq string"


def words(s):
    return {s[i : i + K] for i in range(len(s) - K + 1) if set(s[i : i + K]) <= set("ACGT")} if s else set()


def plain(queries, refs, both):
    """query -> (strand, ref, shared) by counting every pair."""
    own = [(r, words(s)) for r, s in refs]
    out = {}
    for q, s in queries:
        sets = [words(s)] + ([words(dna.reverse_complement_text(s))] if both and s else [])
        scored = [(-len(w & ks), strand, r) for strand, w in enumerate(sets) for r, ks in own if w & ks]
        if scored:
            less, strand, r = min(scored)
            out[q] = (strand, r, -less)
    return out


def mutated(rng, s, rate):
    return "".join(rng.choice("ACGT") if rng.random() < rate else c for c in s)


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(4)
    letters = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    common = letters(80)  # a stretch that nearly all references have
    roots = [letters(200) for _ in range(6)]
    refs = [(i, mutated(rng, roots[i % 6], 0.03) + ("" if i % 11 == 0 else common)) for i in range(60)]
    refs += [(60, refs[7][1]), (61, refs[7][1]), (62, ""), (63, None), (64, "ACG"), (65, "N" * 40)]
    queries = [(i, mutated(rng, refs[i][1], rate)) for i, rate in enumerate([0, 0.01, 0.05, 0.1, 0.3, 0.6, 0])]
    queries += [(20 + i, dna.reverse_complement_text(s)) for i, s in queries]
    queries += [(40, refs[7][1]), (41, common), (42, letters(150)), (43, ""), (44, None), (45, "ACGTA"), (46, refs[3][1][:50] + "NN" + refs[3][1][60:]), (47, "A" * 300)]
    return queries, refs


@pytest.mark.parametrize("both", [False, True])
@pytest.mark.parametrize("block, few", [(3, 0), (4096, 0), (3, 10**9)])
def test_nearest_equals_all_pairs(spark, cases, both, block, few, monkeypatch):
    queries, refs = cases
    split = search.postings
    monkeypatch.setattr(search, "postings", lambda index, _: split(index, block))
    got = search.nearest(spark.createDataFrame(queries, QUERIES), spark.createDataFrame(refs, REFS), K, both, few)
    assert {r["query_id"]: (r["strand"], r["ref_id"], r["shared"]) for r in got.collect()} == plain(queries, refs, both)


def test_postings_are_whole_and_split(spark):
    index = spark.range(1000).selectExpr("id AS ref_id", "1L AS kmer").unionAll(spark.range(3).selectExpr("id AS ref_id", "2L AS kmer"))
    rows = search.postings(index, 50).collect()
    assert sorted(x for r in rows if r["kmer"] == 1 for x in r["ref_ids"]) == list(range(1000))
    assert len([r for r in rows if r["kmer"] == 1]) == 20 and [sorted(r["ref_ids"]) for r in rows if r["kmer"] == 2] == [[0, 1, 2]]


def test_common_kmers_are_not_expanded(spark, cases):
    """A whole copy of a reference bounds the search: only its rarest postings are read again."""
    _, refs = cases
    lists = []
    real = search._named
    try:
        search._named = lambda sets, found, lead: lists.append(real(sets, found, lead)) or lists[-1]
        search.nearest(spark.createDataFrame([(0, refs[1][1])], QUERIES), spark.createDataFrame(refs, REFS), K, few=0).collect()
    finally:
        search._named = real
    pairs = sum(len(words(refs[1][1]) & words(s)) for _, s in refs)
    assert sum(r["met"] for r in lists[1].collect()) < pairs / 4


def test_empty_tables(spark):
    some, none = spark.createDataFrame([(1, "ACGTACGTA")], QUERIES), spark.createDataFrame([], QUERIES)
    refs = spark.createDataFrame([(1, "ACGTACGTA")], REFS)
    assert search.nearest(none, refs, K, True).count() == 0
    assert search.nearest(none, refs, K, True, few=-1).count() == 0
    assert search.nearest(some, refs.limit(0), K).count() == 0
    assert [tuple(r) for r in search.nearest(some, refs, K).collect()] == [(1, 0, 1, 4)]
