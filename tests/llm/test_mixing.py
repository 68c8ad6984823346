import random
import re
from fractions import Fraction

import oracle
import pytest

from taxaspark.llm import mixing as M


@pytest.fixture
def mixed(spark):
    def build(rows):
        return spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, source string, text string, size int")

    return build


def waterfill(sizes, weights=(5, 2, 1)):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), {}
    while True:
        left = [s for s in order if s not in full]
        rest, weight = total - sum(full.values()), sum(w[s] for s in left)
        over = [s for s in left if Fraction(rest * w[s], weight) > 3 * sizes[s]] if left else []
        if not over:
            return {s: full.get(s, Fraction(rest * w[s], weight) if left and s in left else 0) for s in order}
        full.update((s, 3 * sizes[s]) for s in over)


def test_targets_and_totals(mixed):
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "b", "B", "z", "é", None, "tiny"]) if i else "tiny", "w " * rng.randint(0, 60)) for i in range(1500)]
    rows = [(i, s if s != "tiny" or i < 40 else "a", t) for i, s, t in rows] + [(7, "a", None), (7, "a", None), (None, "b", "x y")]
    out = M.mix(mixed(rows), buckets=16).collect()
    assert len(out) == len(rows)
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = waterfill(sizes)
    taken = {}
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - float(want[r["source"]])) < 1e-6
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for s, t in taken.items():
        assert abs(t - float(want[s])) <= 60
    again = M.mix(mixed(rows).repartition(9), buckets=16).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_longer_documents_have_better_odds(mixed):
    rng = random.Random(6)
    rows = [(i, "ab"[i % 2], "w " * rng.choice([5, 20, 80])) for i in range(600)]
    times = {i: 0 for i in range(600)}
    for k in range(6):
        out = M.mix(mixed(rows), key=f"k{k}").collect()
        for r in out:
            times[r["doc_id"]] += r["copies"]
    by = {}
    for r in out:  # plain computation of the expected copies
        own = [x for x in out if x["source"] == r["source"]]
        usual = sum(x["size"] for x in own) // len(own)
        grades = {x["doc_id"]: x["size"] * 1000 // (x["size"] + usual) for x in own}
        each, middle = r["target"] / r["source_size"], sum(x["size"] * grades[x["doc_id"]] for x in own) / r["source_size"]
        want = each * (1 + min(1, (3 - each) / each) * (grades[r["doc_id"]] - middle) / 1000)
        assert abs(want - r["expected"]) < 1e-9 and r["copies"] in (int(want), int(want) + 1)
        by.setdefault((r["source"], r["size"]), []).append((want, times[r["doc_id"]] / 6))
    for source in "ab":
        wants = [by[source, n][0][0] for n in (5, 20, 80)]
        assert wants[0] < wants[1] < wants[2] < 3
        for n, want in zip((5, 20, 80), wants):  # drawn about as often as expected
            got = [x for _, x in by[source, n]]
            assert abs(sum(got) / len(got) - want) < 0.12


def test_empty_and_wordless(mixed):
    assert M.mix(mixed([])).count() == 0
    r = M.mix(mixed([(1, "a", ""), (2, None, None)])).collect()
    assert [x["taken"] for x in r] == [0, 0]


def test_sql(spark, sf_dir):
    from taxaspark.llm.queries import op7_mixing

    assert oracle.difference(spark, oracle.connect(sf_dir), op7_mixing, M.ORACLE_SQL, sf_dir) == ""


def test_exact_dedup_sql(spark, sf_dir):
    from taxaspark.llm import exact_dedup
    from taxaspark.llm.queries import op4_exact_dedup

    assert oracle.difference(spark, oracle.connect(sf_dir), op4_exact_dedup, exact_dedup.ORACLE_SQL, sf_dir) == ""
