"""Reports and k-mer distributions against plain computations."""

import random
import re
from collections import Counter

from taxaspark.functions import kmers
from taxaspark.operators import profiling as P
from taxaspark.operators import taxonomy, tree
from taxaspark.sources import readers, sinks

CALLS = [("a", i, p) for i, p in enumerate([["b", "x", "s1"]] * 3 + [["b", "x", "s2"]] * 5 + [["b", "y"]] * 8 + [["b"]] + [["c", "z", "s3", "t"]] * 9 + [[], None])] + [("e", 1, [])]
HITS = [("a", ["b", "x", "s1"], m) for m in (1, 1, 2)] + [("a", ["b", "x"], 2), ("a", ["b"], 9), ("a", ["c", "z", "s3", "t"], 4), ("a", ["q"], 5)]


def test_report_of_calls(spark, tmp_path):
    calls, hits = spark.createDataFrame(CALLS, "sample string, read_id long, path array<string>"), spark.createDataFrame(HITS, "sample string, path array<string>, minimizer long")
    names = spark.createDataFrame([("b", "Bacteria"), ("s1", "One")], "taxid string, name string")
    for exact in (True, False):
        rows = P.report(calls, hits, names, ("D", "P", "S"), exact)
        got = [tuple(r)[2:] for r in rows.where("sample = 'a'").orderBy("idx").collect()]
        assert [(d, p.strip(), *rest) for d, p, *rest in got] == [
            (0, "7.14", 2, 2, 0, 0, "U", "0", "unclassified"),
            (0, "92.86", 26, 0, 7, 5, "R", "1", "root"),
            (1, "60.71", 17, 1, 5, 3, "D", "b", "Bacteria"),
            (2, "28.57", 8, 0, 4, 2, "P", "x", "x"),
            (3, "17.86", 5, 5, 0, 0, "S", "s2", "s2"),
            (3, "10.71", 3, 3, 3, 2, "S", "s1", "One"),
            (2, "28.57", 8, 8, 0, 0, "P", "y", "y"),
            (1, "32.14", 9, 0, 1, 1, "D", "c", "c"),
            (2, "32.14", 9, 0, 1, 1, "P", "z", "z"),
            (3, "32.14", 9, 0, 1, 1, "S", "s3", "s3"),
            (4, "32.14", 9, 9, 1, 1, "S1", "t", "t"),
        ]
        assert [tuple(r)[2:] for r in rows.where("sample = 'e'").collect()] == [(0, "100.00", 1, 1, 0, 0, "U", "0", "unclassified")]
    # the lines are a report that the reader and the gate take
    sinks.report_lines(rows).where("sample = 'a'").coalesce(1).sortWithinPartitions("idx").select("value").write.text(str(tmp_path / "r"))
    [path] = (tmp_path / "r").glob("part-*.txt")
    again = readers.tree_report(spark, str(path))
    assert again.count() == 11 and [r["depth"] for r in tree.link(again).orderBy("idx").collect()] == [0, 0, 1, 2, 3, 3, 2, 1, 2, 3, 4]
    assert P.report(calls.limit(0), hits).count() == 0


def genomes(seed):
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    shared, genus = word(120), word(150)
    return [("r1", word(200) + shared + genus, ["d", "g1", "s1"]), ("r2", genus + word(180) + shared[:80], ["d", "g1", "s2"]), ("r3", word(100) + "N" + shared + word(150), ["d", "g2", "s3"]), ("r4", word(30), ["d", "g2", "s3"]), ("r5", word(100), ["d"])]


def test_own_calls_become_a_report(spark):
    refs = spark.createDataFrame(genomes(1), "ref_id string, seq string, path array<string>")
    database = taxonomy.kmer_database(refs, 21, 17)
    reads = [("s", i * 1000 + j, g[j : j + 60]) for i, (_, g, _) in enumerate(genomes(1)) for j in range(0, max(1, len(g) - 60), 30)]
    df = spark.createDataFrame(reads, "sample string, read_id long, seq string")
    calls = taxonomy.classify_reads(df, database, 21, 17, 0.0, 1).join(df.select("read_id", "sample"), "read_id")
    hits = P.minimizer_hits(df, database, 21, 17)
    sketch, exact = (P.report(calls, hits, ranks=("D", "G", "S"), exact=e) for e in (False, True))
    exact = {r["taxid"]: r for r in exact.collect()}
    assert exact["1"]["clade_reads"] + exact.get("0", {"clade_reads": 0})["clade_reads"] == len(reads)
    for r in sketch.collect():
        e = exact[r["taxid"]]
        assert (r["clade_reads"], r["total_minimizers"]) == (e["clade_reads"], e["total_minimizers"]) and abs(r["distinct_minimizers"] - e["distinct_minimizers"]) <= 0.03 * e["distinct_minimizers"] + 1
    assert exact["g1"]["clade_reads"] >= exact["s1"]["clade_reads"] + exact["s2"]["clade_reads"]


def test_kmer_distribution_equals_calling_every_window(spark):
    import pyarrow as pa

    refs = genomes(2)
    df = spark.createDataFrame(refs, "ref_id string, seq string, path array<string>")
    database = taxonomy.kmer_database(df, 21, 17)
    known = {r["minimizer"]: tuple(r["path"]) for r in database.collect()}
    want = Counter()
    for _, seq, path in refs:
        for at in range(len(seq) - 50 + 1 if len(path) >= 3 else 0):
            _, codes = kmers.minimizers(pa.array([seq[at : at + 50]]), 21, 17)
            counts = Counter(known[c] for c in codes.tolist() if c in known)
            if counts:
                call = P._called(counts)
                want[path[2], call[-1] if call else "1"] += 1
    for tile in (20_000, 64):
        got = P.kmer_distribution(df, database, 50, 21, 17, 3, tile)
        assert {(r["taxid"], r["called"]): r["n"] for r in got.collect()} == want
    share = {(r["anc_taxid"], r["taxid"]): r["share"] for r in P.kmer_share(got).collect()}
    assert abs(sum(v for (_, t), v in share.items() if t == "s1") - 1) < 1e-12 and 0 < share["g1", "s1"] < 1


def test_distinct_values_below_nodes(spark):
    from pyspark.sql import functions as F

    from taxaspark.operators import profiling

    rows = [("a", p, v) for p, v in (("r/x", 1), ("r/x", 1), ("r/y", 1), ("q", 1), ("r", 2), ("r/x", 2), ("", 3), ("r/x", None))] + [("b", "r/x", 1)]
    df = spark.createDataFrame(rows, "s string, p string, v long").withColumn("p", F.when(F.col("p") == "", F.array().cast("array<string>")).otherwise(F.split("p", "/")))
    got = {(r["s"], "/".join(r["node"])): r["n"] for r in profiling.distinct_below(df, ["s"], "p", "v").collect()}
    assert got == {("a", ""): 3, ("a", "r"): 2, ("a", "r/x"): 2, ("a", "r/y"): 1, ("a", "q"): 1, ("b", ""): 1, ("b", "r"): 1, ("b", "r/x"): 1}


def test_counts_below_nodes_are_dealt_by_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr(P, "PART", 100)
    rng = random.Random(5)
    paths = [[], ["a"], ["a", "b"], ["a", "b", "c"], ["a", "bc"], ["d"], ["d", "b"], ["d", "b", "c"], None]
    # One value in a third of all rows, null values, repeated rows.
    rows = [(rng.choice("st"), rng.choice(paths), rng.choice([7, None, rng.randrange(300)])) for _ in range(3000)]
    total, distinct = Counter(), {}
    for sample, path, value in rows:
        for i in range(len(path) + 1 if path is not None else 0):
            node = sample, tuple(path[:i])
            total[node] += 1
            distinct.setdefault(node, set()).update({value} - {None})
    hits = spark.createDataFrame(rows, "sample string, path array<string>, minimizer long")
    plans, settle = [], P.settle
    monkeypatch.setattr(P, "settle", lambda table: plans.append(table._jdf.queryExecution().optimizedPlan().toString()) or settle(table))
    got = {(r["sample"], tuple(r["node"])): (r["total"], r["distinct"]) for r in P.counted_below(hits, ["sample"], "path", "minimizer").collect()}
    assert got == {node: (n, len(distinct[node])) for node, n in total.items()}
    calls = spark.createDataFrame([("s", i, p) for i, p in enumerate(paths)], "sample string, read_id long, path array<string>")
    for r in P.report(calls, hits, exact=True).where("taxid IN ('1', 'bc')").collect():
        node = "s", ("a", "bc") if r["taxid"] == "bc" else ()
        assert (r["total_minimizers"], r["distinct_minimizers"]) == (total[node], len(distinct[node]))
    assert any(re.search(r"RepartitionByExpression \[[^\]]*\], 30\b", p) for p in plans)


ODD = [[], ["a"], ["a", "b"], ["a", "b", "c"], ["ab"], [""], ["", "b"], None]


def below(rows):
    """Rows and distinct values below every node, in Python's own sets."""
    total, values = Counter(), {}
    for sample, path, value in rows:
        for i in range(len(path) + 1 if path is not None else 0):
            total[sample, tuple(path[:i])] += 1
            values.setdefault((sample, tuple(path[:i])), set()).update({value} - {None})
    return {node: (n, len(values[node])) for node, n in total.items()}


def test_paths_are_dealt_as_numbers_and_counted_alike_without(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(rng.choice(["s", "t", None]), rng.choice(ODD), rng.choice([7, None, rng.randrange(60)])) for _ in range(1500)]
    for some in (rows, [r for r in rows if r[1] is None], []):
        df = spark.createDataFrame(some, "sample string, path array<string>, minimizer long")
        want = below(some)
        for most, number in ((P.PATHS, True), (3, False)):
            monkeypatch.setattr(P, "PATHS", most)
            counted, distinct = P.counted_below(df, ["sample"], "path", "minimizer"), P.distinct_below(df, ["sample"], "path", "minimizer")
            assert {(r["sample"], tuple(r["node"])): (r["total"], r["distinct"]) for r in counted.collect()} == want
            assert {(r["sample"], tuple(r["node"])): r["n"] for r in distinct.collect()} == {k: d for k, (_, d) in want.items() if d}
            if some is rows:
                for plan in (x._jdf.queryExecution().optimizedPlan().toString() for x in (counted, distinct)):
                    assert bool(re.search(r"lag\(_code#\d+L,", plan)) == number
            monkeypatch.undo()


def test_numbers_of_paths_rise_in_their_order(spark):
    some = [*ODD, [None], ["a", None], ["a", None, "c"]]
    coded, table = P._numbered(spark.createDataFrame([(p,) for p in some * 2], "_path array<string>"), 10)
    assert coded.count() == 2 * (len(some) - 1)
    paths = [r["_path"] for r in table.orderBy("_code").collect()]
    assert paths == sorted((p for p in some if p is not None), key=lambda p: [(x is not None, x or "") for x in p])


def test_null_taxa_are_counted_as_with_whole_paths(spark, monkeypatch):
    # A null taxon that a value's longer path has after a shorter one isn't counted as new, with numbers as with paths.
    rows = [("s", p, v) for v, some in ((1, [["a"], ["a", None, "c"]]), (2, [["a", None]]), (3, [["a"], ["a", None]]), (4, [["a", "b"], ["a", None, "c"]])) for p in some]
    df = spark.createDataFrame(rows, "sample string, path array<string>, minimizer long")
    for most in (P.PATHS, 0):
        monkeypatch.setattr(P, "PATHS", most)
        got = {tuple(r["node"]): (r["total"], r["distinct"]) for r in P.counted_below(df, ["sample"], "path", "minimizer").collect()}
        assert got == {(): (7, 4), ("a",): (7, 4), ("a", None): (4, 3), ("a", None, "c"): (2, 2), ("a", "b"): (1, 1)}
        assert {tuple(r["node"]): r["n"] for r in P.distinct_below(df, ["sample"], "path", "minimizer").collect()} == {k: d for k, (_, d) in got.items()}
