"""Readers, writers, configuration, pipelines and the report stream."""

import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from taxaspark.operators import tables, tree
from taxaspark.plans import bindings, pipelines
from taxaspark.sources import config, lines, readers, sinks
from taxaspark.streaming import reports


def put(folder, name, text):
    path = folder / name
    if name.endswith(".gz"):
        path.write_bytes(gzip.compress(text.encode()))
    else:
        path.write_text(text)
    return str(path)


def test_lines_are_numbered_across_blocks(spark, tmp_path):
    path = put(tmp_path, "big.txt", "".join(f"line {i}\n" for i in range(5000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = lines.numbered(spark, path)
        assert df.rdd.getNumPartitions() >= 1 and df.select("block").distinct().count() > 3
        assert df.where(F.concat(F.lit("line "), F.col("line_no").cast("string")) != F.col("value")).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_fastq_and_fasta(spark, tmp_path):
    text = "".join(f"@r{i} x\nACG{'T' * i}\n+\n@II{'I' * i}\n" for i in range(5))
    for name in ("a_R1.fastq", "b_R1.fastq.gz"):
        put(tmp_path, name, text)
    got = readers.fastq(spark, [str(tmp_path / "a_R1.fastq"), str(tmp_path / "b_R1.fastq.gz")]).orderBy("sample", "ordinal").collect()
    assert [(r["sample"], r["ordinal"], r["read_id"], r["seq"]) for r in got[:6]] == [("a", i, f"r{i}", "ACG" + "T" * i) for i in range(5)] + [("b", 0, "r0", "ACG")]
    with pytest.raises(Exception, match="broken FASTQ"):
        readers.fastq(spark, put(tmp_path, "c.fastq", "@r\nACGT\n+\nII\n")).collect()
    fa = put(tmp_path, "x.fa", ">a first\nACG\nT\n>b\n>c third\nGG \n")
    rows = readers.fasta(spark, fa).orderBy("record").collect()
    assert [(r["ref_id"], r["seq"]) for r in rows] == [("a", "ACGT"), ("b", ""), ("c", "GG")]
    assert readers.fasta(spark, fa, keep_empty=False).count() == 2


def test_tree_report_reader(spark, tmp_path):
    text = "1.0\t5\t5\t0\t0\tU\t0\tunclassified\n99\t95\t0\t9\t8\tR\t1\troot\n\n50\t50\t50\t9\t8\tS\t7\t  Genus species\n"
    rows = readers.tree_report(spark, put(tmp_path, "s1_report.txt", text)).orderBy("idx").collect()
    assert [(r["sample"], r["idx"], r["depth"], r["name"]) for r in rows] == [("s1", 0, 0, "unclassified"), ("s1", 1, 0, "root"), ("s1", 2, 1, "Genus species")]
    df = readers.tree_report(spark, put(tmp_path, "s1_report.txt", text))
    assert tree.total_classified(df).first()["classified"] == 95
    assert tuple(tree.unclassified_and_root(df).first())[1:] == (5, 95)
    back = sinks.report_lines(df).orderBy("idx").collect()
    assert back[2]["value"] == "50\t50\t50\t9\t8\tS\t7\t  Genus species"
    with pytest.raises(Exception, match="8 columns"):
        readers.tree_report(spark, put(tmp_path, "bad.txt", "a\tb\n")).collect()
    short = readers.short_report(spark, put(tmp_path, "six.txt", "50\t50\t50\tS\t7\t    X y\n")).first()
    assert (short["taxid"], short["clade_reads"], short["depth"]) == ("7", 50, 2)


def test_quality_report_reader(spark, tmp_path):
    text = ">>Per base sequence quality\tpass\n#Base\tMean\n1\t30\t31\t29.5\n2-5\t30\t31\t20\n>>END_MODULE\n>>Sequence Length Distribution\tpass\n#Length\tCount\n35\t10.0\n40-44\t5.0\n>>END_MODULE\n"
    path = put(tmp_path, "smp_R2_fastqc_data.txt", text)
    bins = readers.quality_bins(spark, path).orderBy("bin_start").collect()
    assert [tuple(r) for r in bins] == [("smp", 2, 1, 1, 29.5), ("smp", 2, 2, 5, 20.0)]
    assert sorted(tuple(r) for r in readers.length_bins(spark, path).collect()) == [("smp", 2, 35, 10.0), ("smp", 2, 40, 5.0)]


def test_small_readers(spark, tmp_path):
    assert [tuple(r) for r in readers.count_lines(spark, put(tmp_path, "c.counts", "a : 5\nTotal read count : 5\nx\n")).collect()] == [("a", 5)]
    assert tuple(readers.match_stats(spark, put(tmp_path, "s.stats", "#File\tx\n#Total\t100\n#Matched\t7\t1%\n")).first()) == ("s", 50, 3)
    assert tuple(readers.surviving_pairs(spark, put(tmp_path, "h.txt", "nothing\n")).first()) == ("h", 0)
    fp = {"summary": {"before_filtering": {"total_reads": 21}, "after_filtering": {"read1_mean_length": 150, "read2_mean_length": 149}}, "filtering_result": {"passed_filter_reads": 13}}
    assert tuple(readers.trim_summary(spark, put(tmp_path, "t.json", json.dumps(fp))).first()) == ("t", 10, 6, 150, 149)
    m = readers.matrix(spark, put(tmp_path, "m.tsv", '""\t"ASV_1"\t"ASV_2"\n"s1"\t3\t0\n"s2"\t1\t2\n'))
    assert sorted(tuple(r) for r in m.collect()) == [("s1", "ASV_1", 3), ("s1", "ASV_2", 0), ("s2", "ASV_1", 1), ("s2", "ASV_2", 2)]
    a = readers.assignments(spark, put(tmp_path, "a.txt", "ASV_1\tx\t+\td:B\n"))
    assert tuple(a.first()) == ("ASV_1", "d:B")
    with pytest.raises(Exception, match="4 fields"):
        readers.assignments(spark, put(tmp_path, "b.txt", "ASV_1\tx\t+\n")).collect()
    k = readers.read_calls(spark, put(tmp_path, "k.txt", "C\tr1\tEscherichia (taxid 562)\t150\tx\nU\tr2\t0\t150\tx\n"))
    assert sorted((r["read_id"], r["taxid"]) for r in k.collect()) == [("r1", "562"), ("r2", "0")]


def test_discovery():
    assert readers.discover_samples(["b_R1.fq", "b_R2.fq", "a_R1.fq", "x_1.fq"]) == {"a": ("a_R1.fq", "a_R2.fq"), "b": ("b_R1.fq", "b_R2.fq")}
    assert readers.discover_samples(["x_1.fastq.gz"]) == {"x": ("x_1.fastq.gz", "x_2.fastq.gz")}
    assert readers.discover_samples(["x_1.fastq.gz"], amplicon=True) == {}
    for bad in (["a_R1.fq", "b_R1.fastq"], ["a b_R1.fq"]):
        with pytest.raises(ValueError):
            readers.discover_samples(bad)


def test_sinks(spark, tmp_path):
    counts = spark.createDataFrame([("s1", "ASV_1", 3), ("s2", "ASV_2", 4)], "sample string, asv_id string, n long")
    text = [r["value"] for r in sinks.matrix_lines(counts, "asv_id", "sample", ["s1", "s2"]).orderBy("no", "key").collect()]
    assert text == ['\t"s1"\t"s2"', '"ASV_1"\t3\t0', '"ASV_2"\t0\t4']
    assert sorted(map(tuple, tables.lengthen(tables.widen(counts, "asv_id", "sample", ["s1", "s2"]), "asv_id").collect())) == [("ASV_1", "s1", 3), ("ASV_2", "s2", 4)]
    otu = spark.createDataFrame([("s1", "9", 12.0, "k__A; s__b")], "sample string, taxid string, n double, lineage string")
    assert [r["value"] for r in sinks.otu_lines(otu, ["s1", "s2"]).orderBy("no").collect()][2] == "9\t12.0\t0.0\tk__A;s__b"
    fa = sinks.fasta_lines(spark.createDataFrame([(2, "b", "GG"), (1, "a", "AC")], "no int, id string, seq string"), F.col("id"), F.col("seq"), "no")
    sinks.write_lines(fa, str(tmp_path / "fa"), ["no"])
    assert [(r["ref_id"], r["seq"]) for r in readers.fasta(spark, str(tmp_path / "fa")).orderBy("ref_id").collect()] == [("a", "AC"), ("b", "GG")]
    seen = sinks.length_counts(spark.createDataFrame([(30, 2), (20, 1)], "len int, n long"), "len").first()["length_counts"]
    assert list(seen.items()) == [(20, 1), (30, 2)]


def test_config(tmp_path):
    assert config.merge({"a": {"b": 1, "c": [1]}, "d": 2}, {"a": {"c": None}, "d": {"x": 1}}) == {"a": {"b": 1, "c": None}, "d": {"x": 1}}
    (tmp_path / "one").mkdir()
    (tmp_path / "two").mkdir()
    put(tmp_path / "one", "M.json", '{"ranks": ["a"], "prefixes": ["a__"], "references": {"db": "x/{region}.fa"}}')
    put(tmp_path / "two", "M.json", '{"ranks": [], "prefixes": [], "references": {"db": "y.fa"}}')
    packs = config.load_packs(str(tmp_path / "one"), str(tmp_path / "two"))
    assert config.find_pack(packs, "m")["references"]["db"] == "y.fa"
    one = config.load_packs(str(tmp_path / "one"))["M"]
    assert config.reference_path({}, one, "db", "ITS2") == "x/ITS2.fa"
    assert config.reference_path({"references": {"db": "own.fa"}}, one, "db") == "own.fa"
    assert config.Marker.of("M", one).prefixes == ["a__"]
    assert config.validate(config.DEFAULTS) == []
    for over in ({"mode": "x"}, {"shotgun": {"bracken": {"threshold_alpha": 1}}}, {"shotgun": {"kmer_evidence": {"protect_frac": 0}}}, {"amplicon": {"taxonomy": {"filter": {"keep_regex": "x"}}}}, {"amplicon": {"length_filter": {"range": [3, 1]}}}):
        with pytest.raises(ValueError):
            config.validate(config.merge(config.DEFAULTS, over))


def test_amplicon_pipeline(spark, tmp_path):
    rng = random.Random(12)
    seq = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    rc = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    fwd, rev = "GTGCCAGCAGCCGCGGTAA", "GGACTACAAGGGTATCTAAT"
    bodies = [seq(150) for _ in range(3)]
    rows, k = [], 0
    for s in ("a", "b"):
        for i, body in enumerate(bodies):
            for _ in range(4 + i):
                r1, r2 = fwd + body[:110], rev + rc(body[40:])
                rows.append((k, s, (r1, "I" * len(r1)), (r2, "I" * len(r2))))
                k += 1
    df = spark.createDataFrame(rows, "pair_id int, sample string, r1 struct<seq: string, qual: string>, r2 struct<seq: string, qual: string>")
    refs = spark.createDataFrame([(i, b, ["d__x", f"g__{i}"]) for i, b in enumerate(bodies)], "ref_id int, seq string, lineage array<string>")
    out = pipelines.amplicon(df, refs, {"amplicon": {"taxonomy": {"filter": {"discard": ["g__0"]}}}}, str(tmp_path), fwd, rev)
    got = {(r["sample"], r["lineage"]): r["n"] for r in out["table"].collect()}
    assert got == {(s, f"d__x;g__{i}"): 4 + i for s in "ab" for i in (1, 2)}
    assert out["tracking"].where("sample = 'a'").first()["raw"] == "15"


def test_shotgun_pipeline_and_stream(spark, sf_dir, tmp_path):
    rep = bindings.report(spark, sf_dir).withColumn("pct", F.lit("0"))
    calls = spark.createDataFrame([("1995", "x", "s1")], "sample string, read_id string, taxid string")
    name = rep.where("taxid = 's1'").first()["name"]
    out = pipelines.shotgun(rep, {"mode": "shotgun", "shotgun": {"kmer_evidence": {"enabled": True, "min_distinct": 5}, "extract_taxa": [name]}}, calls.select("sample", "read_id"), calls)
    assert out["otu"].count() > 0 and out[f"reads:{name}"].count() == 1
    before, after = rep.agg(F.sum("direct_reads")).first()[0], out["gated"].agg(F.sum("direct_reads")).first()[0]
    assert before == after
    cols = [c.split()[0] for c in reports.SCHEMA.split(", ")]
    rep.select(*cols).coalesce(1).write.parquet(str(tmp_path / "in"))
    q = reports.gate_stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"), min_distinct=5)
    q.awaitTermination()
    streamed = spark.read.parquet(str(tmp_path / "out/gated"))
    assert streamed.count() == out["gated"].count()


def test_shotgun_reads_are_cleaned(spark, tmp_path):
    rng = random.Random(13)
    seq = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    rc = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    spike, host, own = seq(400), seq(400), seq(400)
    near = "".join(c if i % 60 else "ACGT"[("ACGT".index(c) + 1) % 4] for i, c in enumerate(host))
    pair = lambda i, s, at, n: (i, "s", (s[at : at + n], "I" * n), (rc(s[at + 40 : at + 40 + n]), "I" * n))
    short = own[:110]
    rows = [pair(1, spike, 10, 150), pair(2, near, 20, 150), pair(3, own, 30, 150), (4, "s", (short + "A" * 40, "I" * 150), (rc(short) + "C" * 40, "I" * 150)), (5, "s", (own[:150], "I" * 90 + "#" * 60), (rc(own[40:190]), "I" * 150))]
    df = spark.createDataFrame(rows, "pair_id int, sample string, r1 struct<seq: string, qual: string>, r2 struct<seq: string, qual: string>")
    one = lambda s: spark.createDataFrame([(s,)], "seq string")
    out = pipelines.clean_shotgun_reads(df, {}, str(tmp_path), one(spike), one(host))
    got = {r["pair_id"]: (r["r1"]["seq"], r["r2"]["seq"]) for r in out["clean"].collect()}
    assert sorted(got) == [3, 4] and got[4] == (short, rc(short))
    assert tuple(out["tracking"].first()) == ("s", "5", "4", "3", "3", "2")


def test_an_empty_report_does_not_hide_behind_one_of_the_same_name(spark, tmp_path):
    import pytest

    for folder, text in (("a b", ""), ("c", "100.00\t1\t1\t1\t1\tR\t1\troot\n"), ("d e", "100.00\t1\t1\t1\t1\tR\t1\troot\n")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "x_report.txt").write_text(text)
    for folder in ("c", "d e"):
        assert readers.tree_report(spark, str(tmp_path / folder / "x_report.txt")).count() == 1
    with pytest.raises(ValueError, match="a(%20| )b"):
        readers.tree_report(spark, [str(tmp_path / f / "x_report.txt") for f in ("a b", "c")])
