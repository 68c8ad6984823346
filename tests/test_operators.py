"""Worked values and plain-Python mirrors of the engine's operators."""

import math
import random

import pytest
from pyspark.sql import functions as F

from taxaspark.functions import counts, dna, lineage
from taxaspark.operators import reads, stats, tables, taxonomy, tree, truncation


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'string' if v is None or isinstance(v, str) else 'double' if isinstance(v, float) else 'array<string>' if isinstance(v, list) else 'long'}" for k, v in values.items()) or "x int"
    return spark.createDataFrame([tuple(values.values()) or (1,)], schema).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("n, want", [(5_294_079, 265), (1_603_409, 80), (0, 10), (100, 10), (None, 10)])
def test_depth_threshold(spark, n, want):
    assert spark.sql(f"SELECT cast({'null' if n is None else n} AS long) AS n").select(counts.depth_threshold(F.col("n"))).first()[0] == want


@pytest.mark.parametrize("mean, want", [(125, 100), (126, 150), (20, 50), (900, 300)])
def test_nearest_read_length(spark, mean, want):
    assert one(spark, counts.nearest_read_length(F.col("m")), m=mean) == want


def test_ratios(spark):
    assert one(spark, counts.ratio_text(F.col("a"), F.col("b"), 1), a=980110, b=224500) == "4.4"
    assert one(spark, counts.ratio_text(F.col("a"), F.col("b"), 1), a=196778, b=426) == "461.9"
    assert one(spark, counts.ratio_text(F.col("a"), F.col("b")), a=1, b=0) == "NA"
    assert round(counts.minimizer_floor(1000, 35, 31), 0) == 333


def test_dna_functions(spark):
    assert one(spark, dna.reverse_complement(F.col("s")), s="AACGTRYN") == "NRYACGTT"
    assert one(spark, dna.expected_errors(F.col("q")), q="IIII5+") == pytest.approx(0.1104)
    assert one(spark, dna.expected_errors(F.col("q")), q="") == 0.0
    assert one(spark, dna.kmers(F.col("s"), 3), s="ACGTA") == ["ACG", "CGT", "GTA"]
    assert one(spark, dna.kmers(F.col("s"), 9), s="ACGTA") == []
    seq = "".join(random.Random(1).choice("ACGT") for _ in range(60))
    want = [min(seq[i + j : i + j + 5] for j in range(4)) for i in range(len(seq) - 7)]
    assert one(spark, dna.minimizers(F.col("s"), 8, 5), s=seq) == want
    assert one(spark, dna.minimizers(F.col("s"), 8, 5), s="ACG") == []


def test_percentile_takes_floor_index(spark):
    rng = random.Random(3)
    rows = [("g%d" % (i % 5), rng.randint(1, 40)) for i in range(333)]
    got = {r["k"]: r for r in stats.length_summary(spark.createDataFrame(rows, "k string, v int"), ["k"], "v").collect()}
    for k in {r[0] for r in rows}:
        x = sorted(v for g, v in rows if g == k)
        for name, p in stats.PERCENTS.items():
            assert got[k][name] == x[min(int(p / 100 * len(x)), len(x) - 1)]
    one_row = stats.length_summary(spark.createDataFrame([("a", 7)], "k string, v int"), ["k"], "v").first()
    assert (one_row["stdev"], one_row["p99"]) == (0.0, 7)


def test_coverage_cap_worked_example(spark):
    reach = {289: 1, 288: 3, 285: 23, 282: 908, 281: 91_950, 276: 122_513, 275: 159_712, 272: 162_376, 271: 211_888, 79: 211_974}
    lengths = sorted(reach, reverse=True)
    rows = [("s", n, reach[n] - (reach[lengths[i - 1]] if i else 0)) for i, n in enumerate(lengths)]
    df = spark.createDataFrame(rows, "s string, len int, n long")
    for pct, want in {50: 276, 80: 271, 90: 271, 95: 271, 98: 271, 99: 271, 100: 79}.items():
        assert stats.coverage_cap(df, ["s"], "len", "n", pct).first()["cap"] == want


def test_length_window_priority():
    probe = {"n": 9, "q1": 200, "p95": 300}
    assert stats.resolve_window("auto", (10, 20), probe, 50, 400) == (10, 20)
    assert stats.resolve_window("auto", None, probe, 50, 400) == (150, 350)
    assert stats.resolve_window("auto", None, None, 50, 401) == (340, 462)
    with pytest.raises(ValueError):
        stats.resolve_window("auto", None, None, 50, None)


def random_tree(seed, n=200):
    rng, rows, depth = random.Random(seed), [], 0
    for i in range(n):
        depth = 0 if i == 0 else rng.randint(1, min(depth + (2 if rng.random() < 0.05 else 1), 6))
        direct = rng.randint(0, 40)
        rows.append({"sample": f"s{seed}", "idx": i, "depth": depth, "rank": "RDPGSS1"[depth] if depth < 5 else "S1", "taxid": "1" if i == 0 else f"t{i}", "name": f"n{i}", "direct_reads": direct, "distinct_minimizers": rng.randint(0, 700)})
    parents, stack = [], []
    for r in rows:
        while stack and rows[stack[-1]]["depth"] >= r["depth"]:
            stack.pop()
        p = stack[-1] if stack and rows[stack[-1]]["depth"] == r["depth"] - 1 else None
        parents.append(p)
        stack.append(r["idx"])
    ends = [next((j for j in range(i + 1, n) if rows[j]["depth"] <= r["depth"]), n) for i, r in enumerate(rows)]
    for i, r in enumerate(rows):
        r["clade_reads"] = sum(rows[j]["direct_reads"] for j in range(i, ends[i]))
        r["total_minimizers"] = 2 * r["distinct_minimizers"]
    return rows, parents, ends


SCHEMA = "sample string, idx long, depth int, rank string, taxid string, name string, direct_reads long, distinct_minimizers long, clade_reads long, total_minimizers long"


def test_tree_links_and_gate(spark):
    trees = [random_tree(s) for s in (1, 2, 3)]
    df = spark.createDataFrame([tuple(r[c.split()[0]] for c in SCHEMA.split(", ")) for t in trees for r in t[0]], SCHEMA)
    linked = tree.link(df).cache()
    got = {(r["sample"], r["idx"]): r for r in linked.collect()}
    for rows, parents, ends in trees:
        for r, p, e in zip(rows, parents, ends, strict=True):
            g = got[r["sample"], r["idx"]]
            assert (g["parent_idx"], g["end_idx"]) == (p, e)
            assert g["ancestors"] == [a for a in range(r["idx"]) if ends[a] > r["idx"]]
    verdict = tree.verdicts(df, "G", 333, 0, 0.5)
    marked = tree.mark(linked, "G", 333, 0, 0.5)
    pruned = {(r["sample"], r["idx"]) for r in verdict.where("decision = 'prune'").collect()}
    assert pruned
    for r in marked.collect():
        above = any((r["sample"], a) in pruned for a in r["ancestors"])
        own = (r["sample"], r["idx"]) in pruned
        assert (r["in_drop"], r["topmost"]) == (own or above, own and not above)
    credit = tree.credits(marked)
    gated = tree.gated(marked, credit)
    before = {r["sample"]: r["s"] for r in linked.groupBy("sample").agg(F.sum("direct_reads").alias("s")).collect()}
    after = {r["sample"]: r["s"] for r in gated.groupBy("sample").agg(F.sum("direct_reads").alias("s")).collect()}
    orphaned = {r["sample"]: r["credit"] for r in credit.where("parent_idx IS NULL").collect()}
    for s in before:  # reads are moved, not lost
        assert before[s] == after[s] + orphaned.get(s, 0)


def test_deep_trees_and_samples_over_many_batches(spark):
    deep = [("a", i, i, "x") for i in range(60)] + [("a", 60, 3, "x"), ("a", 61, 60, "x")]
    wide = [("b", i, i % 3, "y") for i in range(2500)] + [(None, 0, 5, "z")]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = tree.link(spark.createDataFrame(deep + wide, "sample string, idx long, depth int, name string")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = {(r["sample"], r["idx"]): r for r in rows}
    assert len(rows) == len(deep) + len(wide)
    assert got["a", 59]["ancestors"] == list(range(59)) and got["a", 59]["parent_idx"] == 58 and got["a", 59]["end_idx"] == 60
    assert got["a", 60]["ancestors"] == [0, 1, 2] and got["a", 61]["ancestors"] == [0, 1, 2, 60] and got["a", 61]["parent_idx"] is None and got["a", 0]["end_idx"] == 62
    assert got["b", 2499]["parent_idx"] is None and got["b", 2498]["parent_idx"] == 2497 and got["b", 1]["end_idx"] == 3 and got[None, 0]["end_idx"] == 1


def test_gate_trees_hold_every_case(spark):
    """The queries that are compared with SQL at sf0.01 see all reasons, nested and orphaned taxa and dead credit."""
    from taxaspark.plans import queries as q

    sf = "/root/testdata/sf0.01"
    reasons = {r["reason"].split(":")[0].rstrip("0123456789 <") for r in q.evidence_table(spark, sf).select("reason").distinct().collect()}
    assert {x.split(" ")[0] for x in reasons} == {"passed", "protected", "distinct", "clade"}
    credit = q.gate_credit(spark, sf)
    assert credit.where("parent_idx IS NULL").count() and credit.where("parent_idx IS NOT NULL").count() and q.gate_dead_credit(spark, sf).count()
    nested = q._marked(spark, sf)[0].where("in_drop AND NOT topmost AND rank = 'S'")
    assert nested.count() and q.gate_summary(spark, sf).where("protected <> '' AND pct_of_all > 0").count()


def test_verdict_examples(spark):
    rows = [("s", 0, 0, "R", "1", "root", 0, 0, 100_000, 0), ("s", 1, 1, "S", "a", "a", 373, 189, 373, 0), ("s", 2, 1, "S", "b", "b", 134, 3547, 134, 0), ("s", 3, 1, "S", "c", "c", 5000, 10, 5000, 0), ("s", 4, 1, "S1", "d", "d", 9, 1, 9, 0)]
    got = {r["taxid"]: (r["decision"], r["reason"]) for r in tree.verdicts(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {k: v[0] for k, v in got.items()} == {"a": "prune", "b": "keep", "c": "keep"}
    assert got["c"][1] == "protected: 5.00% of classified reads"


def test_raise_cuts_is_the_greedy_merge(spark):
    rng = random.Random(11)
    for _ in range(8):
        q = {m: [rng.randint(10, 38) for _ in range(40)] for m in (1, 2)}
        cut = {m: rng.randint(5, 20) for m in (1, 2)}
        need = rng.randint(1, 25)
        want = dict(cut)
        for _ in range(need):  # the better next base, mate 1 on ties
            nxt = {m: q[m][want[m]] if want[m] < 40 else -math.inf for m in (1, 2)}
            run = {m: min(q[m][cut[m] : want[m] + 1], default=math.inf) if want[m] < 40 else -math.inf for m in (1, 2)}
            want[1 if run[1] >= run[2] else 2] += 1
            del nxt
        profile = spark.createDataFrame([(m, i + 1, float(x)) for m in q for i, x in enumerate(q[m])], "mate int, pos int, q1 double")
        cuts = spark.createDataFrame([(m, c, 40) for m, c in cut.items()], "mate int, cut int, last_pos int")
        assert {r["mate"]: r["cut"] for r in truncation.raise_cuts(profile, cuts, need).collect()} == want


def test_pick_policies(spark):
    q = {1: [35.0] * 30 + [18.0] * 10, 2: [35.0] * 20 + [16.0] * 20}
    profile = spark.createDataFrame([(m, i + 1, x) for m in q for i, x in enumerate(q[m])], "mate int, pos int, q1 double")
    assert truncation.pick(profile, length=30)["resolved_via"] == "first_drop"
    up = truncation.pick(profile, length=46)
    assert (up["r1"], up["r2"], up["resolved_via"]) == (38, 20, "raise_trunc")
    low = truncation.pick(profile, length=46, policy="relax_q")
    assert (low["r1"], low["r2"], low["q_threshold_used"]) == (40, 20, 18)
    assert truncation.pick(profile, marker="ITS")["resolved_via"] == "its_no_truncation"
    for bad in ({"length": 90}, {"length": 46, "policy": "error"}, {"length": 46, "policy": "what"}, {"length": 66, "policy": "relax_q", "floor": 17}):
        with pytest.raises(ValueError):
            truncation.pick(profile, **bad)


def test_expected_length():
    assert truncation.expected_length([200, 300]) == 300
    assert truncation.expected_length("auto", {"p95": 411}) == 411
    for bad in (None, True, "x", [3, 2], 20, "auto"):
        with pytest.raises(ValueError):
            truncation.expected_length(bad)


def test_keep_discard_tokens(spark):
    rows = spark.createDataFrame([("g__Bacillus; s__x",), ("g__Bacillus_A",), ("",), (None,)], "l string")
    names = lambda df: [r["l"] for r in df.collect()]
    assert names(taxonomy.keep_discard(rows, F.col("l"), "g__Bacillus")) == ["g__Bacillus; s__x"]
    assert len(names(taxonomy.keep_discard(rows, F.col("l"), None, ["g__Bacillus"]))) == 3
    assert names(taxonomy.keep_discard(rows, F.col("l"), ["g__Bacillus"], ["s__x"])) == []
    with pytest.raises(ValueError):
        taxonomy.keep_discard(rows, F.col("l"), ["zzz"], on_empty="error")


def test_lineage_strings(spark):
    norm = lambda x: one(spark, lineage.full_binomial(F.col("l")), l=x)
    assert norm(["g__Streptococcus", "s__thermophilus"])[1] == "s__Streptococcus thermophilus"
    assert norm(["g__A", "s__Candidatus X"])[1] == "s__Candidatus X"
    assert norm(["g__A", "s__TP778L"])[1] == "s__TP778L"
    assert norm(["g__A", "s__sp. MFA1 R4"])[1] == "s__A sp. MFA1 R4"
    assert norm(["g__", "s__x"])[1] == "s__x"
    parsed = one(spark, lineage.parse_assignments(F.col("a"), ["d__", "g__"]), a='d:Bacteria,junk, g:"g__Bacillus",s:')
    assert parsed == {"d": "Bacteria", "g": "Bacillus"}
    assert one(spark, lineage.numeric_suffix(F.col("a")), a="ASV_12") == 12
    assert one(spark, lineage.numeric_suffix(F.col("a")), a="odd") == 10**9
    with pytest.raises(Exception, match="unexpected header"):
        one(spark, lineage.convert_root_header(F.col("h")), h=">x Bacteria;y")


def test_collapse_lists_members_by_number(spark):
    rows = spark.createDataFrame([("ASV_142", "ACGT"), ("ASV_7", "ACGT"), ("odd", "ACGT"), ("ASV_3", "GG")], "asv_id string, seq string")
    got = {r["representative"]: r["merged_asvs"] for r in tables.collapse_identical(rows).collect()}
    assert got == {"ASV_7": "ASV_7,ASV_142,odd", "ASV_3": "ASV_3"}


def test_tracking_missing_is_na_or_error(spark):
    samples = spark.createDataFrame([("a",), ("b",)], "sample string")
    stages = spark.createDataFrame([("a", "raw", 5), ("b", "raw", 6), ("a", "kept", 1)], "sample string, stage string, n long")
    got = {r["sample"]: r["kept"] for r in tables.tracking(samples, stages, ["raw", "kept"]).collect()}
    assert got == {"a": "1", "b": "NA"}
    with pytest.raises(Exception, match="no kept count"):
        tables.checked_tracking(samples, stages, ["raw", "kept"]).collect()


def pair(a, qa, b, qb):
    return (a, qa), (b, qb)


PAIRS = "pair_id int, sample string, r1 struct<seq: string, qual: string>, r2 struct<seq: string, qual: string>"


def test_filter_pairs_rules(spark):
    good = ("A" * 40, "I" * 40)
    rows = [
        (1, "s", good, good),
        (2, "s", ("A" * 40, "I" * 30 + "#" + "I" * 9), good),  # cut at quality 2, too short for the length
        (3, "s", ("A" * 20 + "N" + "A" * 19, "I" * 40), good),
        (4, "s", ("A" * 40, "%" * 40), good),  # too many expected errors
        (5, "s", ("A" * 30, "I" * 30), good),
    ]
    df = spark.createDataFrame(rows, PAIRS)
    assert [r["pair_id"] for r in reads.filter_pairs(df, (35, 35)).collect()] == [1]
    assert sorted(r["pair_id"] for r in reads.filter_pairs(df, (0, 0)).collect()) == [1, 2, 5]
    assert {len(r["r1"]["seq"]) for r in reads.filter_pairs(df, (35, 30)).collect()} == {35}


def test_quality_trim(spark):
    df = spark.createDataFrame([(("ACGTACGTAC", "##IIIIII##"), ("A", "I"))], "r1 struct<seq: string, qual: string>, r2 struct<seq: string, qual: string>")
    assert df.select(reads.quality_trim(F.col("r1"), 2, 20).alias("r")).first()["r"]["seq"] == "CGTACGT"


def test_primers_and_mixed_orientation(spark):
    rng = random.Random(4)
    body = "".join(rng.choice("ACGT") for _ in range(120))
    fwd, rev = "GTGYCAGCMGCCGCGGTAA", "GGACTACNVGGGTWTCTAAT"
    whole = "GTGCCAGCAGCCGCGGTAA" + body + dna.reverse_complement_text("GGACTACAAGGGTATCTAAT")
    back = whole[::-1].translate(str.maketrans("ACGT", "TGCA"))
    q = "I" * len(whole)
    rows = [(1, "s", (whole, q), (back, q)), (2, "s", (back, q), (whole, q)), (3, "s", (body, "I" * 120), (back, q))]
    df = spark.createDataFrame(rows, PAIRS)
    fixed = reads.trim_primers(df, fwd, rev, 0.0).collect()
    assert [(r["pair_id"], r["r1"]["seq"]) for r in fixed] == [(1, body)]
    mixed = reads.trim_primers(df, fwd, rev, 0.0, orientation="mixed").collect()
    assert sorted((r["pair_id"], r["r1"]["seq"]) for r in mixed) == [(1, body), (2, body)]
    near = whole[:3] + ("A" if whole[3] != "A" else "G") + whole[4:]
    wrong = spark.createDataFrame([(1, "s", (near, q), (back, q))], PAIRS)
    assert reads.trim_primers(wrong, fwd, rev, 0.0).count() == 0
    assert reads.trim_primers(wrong, fwd, rev, 0.2).first()["r1"]["seq"] == body
    refs = spark.createDataFrame([("a", "TT" + whole + "CC"), ("b", body)], "ref_id string, seq string")
    assert [(r["ref_id"], r["seq"]) for r in reads.in_silico_pcr(refs, fwd, rev, 0.0).collect()] == [("a", body)]


def test_merge_pairs_overlap(spark):
    rng = random.Random(5)
    s = "".join(rng.choice("ACGT") for _ in range(60))
    rc = lambda x: x[::-1].translate(str.maketrans("ACGT", "TGCA"))
    rows = [(1, "s", (s[:40], "I" * 40), (rc(s[28:]), "I" * 32)), (2, "s", (s[:40], "I" * 40), (rc(s[29:]), "I" * 31)), (3, "s", (s[:40], "I" * 40), (rc(s[20:30] + "A" + s[31:]), "I" * 40))]
    df = spark.createDataFrame(rows, PAIRS)
    assert [(r["pair_id"], r["merged"], r["overlap"]) for r in reads.merge_pairs(df).where("pair_id < 3").collect()] == [(1, s, 12)]
    strict, loose = reads.merge_pairs(df).count(), reads.merge_pairs(df, 10, 1).count()
    assert strict <= loose == 3
    assert "NNNN" in reads.merge_pairs(df, concatenate=True).first()["merged"]


def test_contaminants_by_pair(spark):
    rng = random.Random(6)
    ref = "".join(rng.choice("ACGT") for _ in range(200))
    other = "".join(rng.choice("ACGT") for _ in range(80))
    hit, near = ref[50:130], ref[50:70] + ("A" if ref[70] != "A" else "C") + ref[71:81]
    q = lambda s: (s, "I" * len(s))
    df = spark.createDataFrame([(1, "s", q(hit), q(other)), (2, "s", q(hit), q(hit)), (3, "s", q(other), q(other)), (4, "s", q(near), q(other))], PAIRS)
    refs = spark.createDataFrame([(ref,)], "seq string")
    ids = lambda d: sorted(r["pair_id"] for r in d.collect())
    assert ids(reads.remove_contaminant_pairs(df, refs)) == [3, 4]
    assert ids(reads.remove_contaminant_pairs(df, refs, need="both")) == [1, 3, 4]
    assert ids(reads.remove_contaminant_pairs(df, refs, distance=1)) == [3]


def test_classifier_moves_up_until_confident(spark):
    rng = random.Random(7)
    seq = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    common, a, b_ = seq(100), seq(100), seq(100)
    refs = spark.createDataFrame([("a", common + a, ["r", "g", "a"]), ("b", common + b_, ["r", "g", "b"])], "ref_id string, seq string, path array<string>")
    db = taxonomy.kmer_database(refs, 21, 15)
    queries = spark.createDataFrame([("own", a), ("shared", common), ("both", common + a[:30]), ("none", seq(100)), ("short", "ACG")], "read_id string, seq string")
    got = {r["read_id"]: r["taxon"] for r in taxonomy.classify_reads(queries, db, 21, 15, 0.15, 1).collect()}
    assert got["own"] == "a" and got["shared"] == "g" and got["none"] is None and "short" not in got
    strict = {r["read_id"]: r["taxon"] for r in taxonomy.classify_reads(queries, db, 21, 15, 0.5, 1).collect()}
    assert strict["both"] == "g"


def test_naive_bayes_mirror(spark):
    rng = random.Random(8)
    refs = [(f"r{i}", "".join(rng.choice("ACGT") for _ in range(80)), f"g{i % 3}") for i in range(9)]
    qs = [(f"q{i}", refs[i][1][10:60]) for i in range(5)]
    k = 6
    ks = lambda s: {s[i : i + k] for i in range(len(s) - k + 1)}
    n, total = {}, len(refs)
    for _, s, _ in refs:
        for w in ks(s):
            n[w] = n.get(w, 0) + 1
    prior = lambda w: (n[w] + 0.5) / (total + 1)
    want = {}
    for q, s in qs:
        best = []
        for g in sorted({r[2] for r in refs}):
            own = [ks(r[1]) for r in refs if r[2] == g]
            best.append((round(sum(math.log((sum(w in o for o in own) + prior(w)) / (len(own) + 1)) for w in ks(s) if w in n), 6), g))
        want[q] = max(best)
    got = taxonomy.naive_bayes(spark.createDataFrame(qs, "query_id string, seq string"), spark.createDataFrame(refs, "ref_id string, seq string, genus string"), k)
    assert {r["query_id"]: (round(r["score"], 6), r["genus"]) for r in got.collect()} == want


def test_vote_is_the_same_under_any_partitioning(spark):
    rng = random.Random(9)
    refs = spark.createDataFrame([(i, "".join(rng.choice("ACGT") for _ in range(100)), ["d", f"g{i % 2}", f"s{i}"]) for i in range(6)], "ref_id int, seq string, lineage array<string>")
    qs = refs.select(F.col("ref_id").alias("query_id"), F.substring("seq", 5, 60).alias("seq"))
    a = sorted(map(tuple, taxonomy.bootstrap_vote(qs, refs, rounds=10).collect()))
    b = sorted(map(tuple, taxonomy.bootstrap_vote(qs.repartition(7), refs.repartition(3), rounds=10).collect()))
    assert a == b and all(t == f"s{q}" for q, k, t, c in a if k == 2)
    cut = {r["query_id"]: r["lineage"] for r in taxonomy.cut_by_confidence(taxonomy.bootstrap_vote(qs, refs, rounds=10), 0.8).collect()}
    assert cut[3] == ["d", "g1", "s3"]


def test_bootstrap_bayes_knows_its_references_on_both_strands(spark):
    rng = random.Random(8)
    seqs = ["".join(rng.choice("ACGT") for _ in range(300)) for _ in range(4)]
    refs = spark.createDataFrame([(i, s, f"g{i // 2}", ["d", f"g{i // 2}"]) for i, s in enumerate(seqs)], "ref_id long, seq string, genus string, lineage array<string>")
    turned = dna.reverse_complement_text(seqs[3])
    out = taxonomy.bootstrap_bayes(spark.createDataFrame([(0, seqs[0]), (3, turned)], "query_id long, seq string"), refs, rounds=20, try_reverse=True)
    assert sorted(map(tuple, out.collect())) == [(0, 0, "d", 1.0), (0, 1, "g0", 1.0), (3, 0, "d", 1.0), (3, 1, "g1", 1.0)]
