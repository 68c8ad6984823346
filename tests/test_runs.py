"""Whole runs: from FASTQ files to a table, and from read pairs to a shotgun table."""

import random

from pyspark.sql import functions as F

from taxaspark.functions import dna
from taxaspark.operators import reads
from taxaspark.plans import pipelines
from taxaspark.sources import readers

FWD, REV = "GTGYCAGCMGCCGCGG", "GGACTACNVGGGTWTC"


def concrete(rng, primer):
    return "".join(rng.choice(dna.MEANING[c]) for c in primer)


def test_amplicon_from_fastq_to_table(spark, tmp_path):
    rng = random.Random(21)
    word = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    body = [word(150), word(150), word(146)]
    near = body[0][:70] + ("A" if body[0][70] != "A" else "C") + body[0][71:]
    bodies = [*body, near]
    refs = [(f"r{i}", word(40) + concrete(rng, FWD) + b + dna.reverse_complement_text(concrete(rng, REV)) + word(30), ["d0", f"g{i % 2}", f"s{i}"]) for i, b in enumerate(bodies[:3])]
    abundance = {"a": [120, 60, 0, 30], "b": [0, 70, 90, 0]}
    for sample, numbers in abundance.items():
        out1, out2 = [], []
        for b, n in zip(bodies, numbers, strict=True):
            for k in range(n):
                frag = concrete(rng, FWD) + b + dna.reverse_complement_text(concrete(rng, REV))
                mates = []
                for text in (frag, dna.reverse_complement_text(frag)):
                    q = [38] * 100 + [30] * 20 + [8] * 10  # the last bases are bad
                    mates.append(("".join(rng.choice("ACGT") if rng.random() < 10 ** (-x / 10) else c for c, x in zip(text[:130], q, strict=True)), "".join(chr(33 + x) for x in q)))
                name = f"{sample}{b[:4]}{k}"
                out1.append(f"@{name}\n{mates[0][0]}\n+\n{mates[0][1]}\n")
                out2.append(f"@{name}\n{mates[1][0]}\n+\n{mates[1][1]}\n")
        order = list(range(len(out1)))
        rng.shuffle(order)
        for mate, out in ((1, out1), (2, out2)):
            (tmp_path / f"{sample}_R{mate}.fastq").write_text("".join(out[i] for i in order))
    first, second = (readers.fastq(spark, [str(tmp_path / f"{s}_R{m}.fastq") for s in abundance]) for m in (1, 2))
    pairs = reads.pair_mates(first, second).withColumn("pair_id", F.col("ordinal"))
    refs = spark.createDataFrame(refs, "ref_id string, seq string, lineage array<string>")
    settings = {"amplicon": {"trunc_len": {"min_read_coverage_pct": 90}, "taxonomy": {"sintax_cutoff": 0.5}, "dada2": {"max_ee": [3, 5]}}}
    out, record = pipelines.amplicon_run(pairs, refs, settings, str(tmp_path / "work"), FWD, REV, omega=1e-20)
    assert record["probe"]["n"] == 3 and record["probe"]["p95"] == 150 and record["window"] == (146 - 50, 150 + 50) and record["expected_length"] == 150
    # The primers' 16 bases are gone, and the bad end of the reads with them.
    assert record["resolved_via"] == "first_drop" and (record["r1"], record["r2"]) == (104, 104)
    got = {(r["sample"], r["seq"]): r["n"] for r in out["table"].join(out["asv"].select("asv_id", "seq"), "asv_id").collect()}
    assert set(got) == {(s, b) for s, ns in abundance.items() for b, n in zip(bodies, ns, strict=True) if n}
    assert all(n >= 0.85 * abundance[s][bodies.index(b)] for (s, b), n in got.items())
    lineage = {r["seq"]: r["lineage"] for r in out["taxonomy"].collect()}
    assert [lineage[b] for b in body] == ["d0;g0;s0", "d0;g1;s1", "d0;g0;s2"] and lineage[near].startswith("d0")
    track = {r["sample"]: r for r in out["tracking"].collect()}
    assert track["a"]["raw"] == "210" and int(track["a"]["table"]) == sum(n for (s, _), n in got.items() if s == "a")


def test_shotgun_from_reads_to_table(spark, tmp_path):
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    shared = word(300)
    genomes = {"s1": word(1500) + shared, "s2": shared + word(1500), "s3": word(1800)}
    refs = [(g, ["d", "g2" if s == "s3" else "g1", s]) for s, g in genomes.items()]
    rows = []
    for s, n in (("s1", 200), ("s2", 100), ("s3", 50)):
        for i in range(n):
            at = rng.randint(0, 1800 - 260)
            frag = genomes[s][at : at + 260]
            rows.append(("x", f"{s}-{i}", (frag[:110], "I" * 110), (dna.reverse_complement_text(frag)[:110], "I" * 110)))
    rows += [("x", f"u-{i}", (word(110), "I" * 110), (word(110), "I" * 110)) for i in range(20)]
    df = spark.createDataFrame(rows, "sample string, pair_id string, r1 struct<seq: string, qual: string>, r2 struct<seq: string, qual: string>")
    refs = spark.createDataFrame(refs, "seq string, path array<string>")
    out = pipelines.shotgun_run(df, refs, {"mode": "shotgun", "shotgun": {"kmer_evidence": {"enabled": True, "min_distinct": 50}, "extract_taxa": ["s3"]}}, str(tmp_path), 31, 25, ("D", "G", "S"))
    report = {r["taxid"]: r for r in out["report"].collect()}
    assert report["0"]["clade_reads"] == 20 and report["1"]["clade_reads"] == 350 and report["s3"]["clade_reads"] == 50
    assert report["g1"]["direct_reads"] + report["s1"]["clade_reads"] + report["s2"]["clade_reads"] == 300 and report["g1"]["direct_reads"] > 0
    got = {r["taxid"]: r["estimate"] for r in out["otu"].collect()}
    assert set(got) == {"s1", "s2", "s3"} and abs(sum(got.values()) - 350) < 1e-6 and got["s1"] > report["s1"]["clade_reads"]
    assert {r["read_id"] for r in out["reads:s3"].collect()} == {f"s3-{i}" for i in range(50)}
