"""Reads with errors and gaps find their place; plain edit distances."""

import random

from taxaspark.functions import dna
from taxaspark.operators import mapping as M


def plain_edits(read, part):
    row = [0] * (len(part) + 1)
    for i, c in enumerate(read, 1):
        now = [i]
        for j, d in enumerate(part, 1):
            now.append(min(row[j - 1] + (c != d), row[j] + 1, now[j - 1] + 1))
        row = now
    return min(row)


def changed(rng, text, subs, dels, ins):
    text = list(text)
    for p in rng.sample(range(5, len(text) - 5), subs):
        text[p] = rng.choice([c for c in "ACGT" if c != text[p]])
    for _ in range(dels):
        text.pop(rng.randrange(5, len(text) - 5))
    for _ in range(ins):
        text.insert(rng.randrange(5, len(text) - 5), rng.choice("ACGT"))
    return "".join(text)


def test_edits_equal_plain():
    rng = random.Random(1)
    word = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    reads, parts = [""], ["ACGT"]
    for _ in range(60):
        ref = word(120)
        at = rng.randint(8, 12)
        read = changed(rng, ref[at : at + rng.randint(40, 90)], rng.randint(0, 4), rng.randint(0, 2), rng.randint(0, 2))
        reads.append(read)
        parts.append(ref[at - 8 :])
    got = M.edits(reads, parts, 8)
    assert got.tolist() == [plain_edits(r, p[: len(r) + 17]) for r, p in zip(reads, parts, strict=True)]


def test_places(spark, monkeypatch):
    monkeypatch.setattr(M, "TILE", 500)
    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    refs = {"h": word(3000), "g": word(700) + "N" * 10 + word(600)}
    rows, truth = [], {}
    for i in range(60):
        name = rng.choice("hg")
        at = rng.choice([0, 450, 495, len(refs[name]) - 120, rng.randint(0, len(refs[name]) - 120)])
        read = changed(rng, refs[name][at : at + 120], *((3, 1, 1) if i % 2 else (0, 0, 0)))
        rows.append((i, dna.reverse_complement_text(read) if i % 3 == 0 else read))
        truth[i] = (name, "-" if i % 3 == 0 else "+", at)
    rows += [(100, word(120)), (101, "ACGT"), (102, ""), (103, changed(rng, refs["h"][100:220], 12, 2, 2))]
    df = spark.createDataFrame(rows, "read_id long, seq string")
    got = {r["read_id"]: r for r in M.map_reads(df, spark.createDataFrame(list(refs.items()), "ref_id string, seq string")).collect()}
    assert set(got) == set(truth)
    for i, (name, strand, at) in truth.items():
        assert (got[i]["ref_id"], got[i]["strand"]) == (name, strand) and abs(got[i]["start"] - at) <= 20 and got[i]["edits"] <= 5 * (i % 2)


def test_pairs(spark):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    host = word(5000)
    away = lambda at: changed(rng, host[at : at + 110], 3, 1, 1)
    rows = [
        ("both", away(100), dna.reverse_complement_text(away(300))),
        ("far", away(100), dna.reverse_complement_text(away(4000))),
        ("same strand", away(100), away(300)),
        ("one", away(200), word(110)),
        ("none", word(110), word(110)),
    ]
    df = spark.createDataFrame([(i, (a, a), (b, b)) for i, a, b in rows], "pair_id string, r1 struct<seq: string, qual: string>, r2 struct<seq: string, qual: string>")
    refs = spark.createDataFrame([("h", host)], "ref_id string, seq string")
    left = lambda need: {r["pair_id"] for r in M.screen_pairs(df, refs, need).collect()}
    assert left("concordant") == {"far", "same strand", "one", "none"}
    assert left("both") == {"one", "none"} and left("either") == {"none"}


def test_only_reads_with_a_known_seed_are_turned_and_sought(spark, monkeypatch):
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    ref = word(2000)
    rows = [(i, word(100)) for i in range(2000)]
    for i, at in enumerate(range(0, 1800, 60)):
        read = changed(rng, ref[at : at + 110], 2, 1, 0)
        rows.append((3000 + i, dna.reverse_complement_text(read) if i % 2 else read))
    rows += [(4000, ref[:50] + "N" + ref[51:100]), (4001, None), (4002, word(2000) + ref[:30])]
    df, refs = spark.createDataFrame(rows, "read_id long, seq string"), spark.createDataFrame([("h", ref)], "ref_id string, seq string")
    made, settle = [], M.settle
    monkeypatch.setattr(M, "settle", lambda table: made.append(settle(table)) or made[-1])
    got = {tuple(r) for r in M.map_reads(df, refs).collect()}
    assert sum(t.count() for t in made if "strand" in t.columns) <= 100
    # The same places where nothing is left out beforehand.
    full = M.kmers.np.full(1 << 22, 255, M.kmers.np.uint8)
    monkeypatch.setattr(M.kmers, "code_filter", lambda *_: full)
    made.clear()
    assert got == {tuple(r) for r in M.map_reads(df, refs).collect()} and {i for i, *_ in got} == {*range(3000, 3030), 4000}
    assert sum(t.count() for t in made if "strand" in t.columns) > 4000
