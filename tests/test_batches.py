"""What is done for whole Arrow batches, against the column functions and plain computations."""

import numpy as np

from pyspark.sql import functions as F

from taxaspark.functions import dna


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sequences_are_made_once_a_row(spark, sf_dir):
    from taxaspark.plans import sequence_queries as q

    text = spark.createDataFrame([(1, "Ünder the Sea, 3 KK zzz\0Az"), (2, None), (3, ""), (4, "abcdefghijklmnopqrstuvwxyz" * 20_000)], "id int, seq string")
    want = {r["id"]: r["s"] for r in text.select("id", dna.pseudo_dna(F.col("seq")).alias("s")).collect()}
    assert {r["id"]: r["seq"] for r in dna.from_prose(text).collect()} == want
    assert "translate(" not in plan(q.in_silico_pcr(spark, sf_dir))  # pushed filters computed it again and again


def test_a_long_sequence_is_cut_in_one_pass(spark):
    text = "ACGTTGCA" * 75_000
    got = dna.tiles(spark.createDataFrame([(7, text), (8, ""), (9, "ACGTA")], "id int, seq string"), 6, quality=("ACGT", "I?5+")).collect()
    own = {r["tile"]: r["seq"] for r in got if r["id"] == 7}
    assert "".join(own[i] for i in range(len(own))) == text and len(got) == 100_001
    assert all(r["qual"] == r["seq"].translate(str.maketrans("ACGT", "I?5+")) for r in got)
    whole = dna.tiles(spark.createDataFrame([(9, "ACGTACA")], "id int, seq string"), 6, True).collect()
    assert [(r["id"], r["tile"], r["seq"]) for r in whole] == [(9, 0, "ACGTAC")]


def test_smallest_words_of_every_window(spark):
    from taxaspark.functions import kmers

    seqs = ["ACGTTGCATGCANGTACCATGATTTACGA", "ACGTACGTACG", "", None, "GATTACAGATTACA"]
    got = {(r["id"], r["pos"]): r["minimizer"] for r in kmers.least_rows(spark.createDataFrame(list(enumerate(seqs)), "id int, seq string"), ["id"], 12, 7).collect()}
    want = {(i, p + 1): min(s[p + j : p + j + 7] for j in range(6)) for i, s in enumerate(seqs) if s for p in range(len(s) - 11) if "N" not in s[p : p + 12]}
    assert got == want


def test_quality_profile_counts_in_batches(spark):
    from taxaspark.operators import reads

    rng = np.random.default_rng(3)
    rows = [(s, t, "".join(chr(33 + x) for x in rng.integers(2, 41, rng.integers(0, 30)))) for s in ("a", None) for t in (1, 2) for _ in range(50)]
    df = reads.base_profile(spark.createDataFrame([*rows, ("a", 3, None)], "s string, t int, q string"), ["s", "t"], "q")
    assert "Generate" not in plan(df)  # no row for every base
    want = {}
    for s, t, q in rows:
        for i, c in enumerate(q):
            want.setdefault((s, t, i + 1), []).append(ord(c) - 33)
    assert {(r["s"], r["t"], r["pos"]): (r["q1"], r["median"], r["n"]) for r in df.collect()} == {k: (np.percentile(v, 25), np.percentile(v, 50), len(v)) for k, v in want.items()}


def counted(spark, rows):
    """Counts of sequences, and how many rows have been made of them so far."""
    made = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    return spark.createDataFrame(rows, "sample string, seq string, n long").mapInArrow(run, "sample string, seq string, n long"), made


def test_chimeras_read_their_counts_once(spark):
    from taxaspark.operators import reads

    df, made = counted(spark, [("a", "AAAACCCC", 100), ("a", "GGGGTTTT", 90), ("a", "AAAATTTT", 3)])
    assert {r["seq"] for r in reads.bimeras(df).where("is_bimera").collect()} == {"AAAATTTT"} and made.value == 3


def test_neighbours_read_their_counts_once(spark):
    from taxaspark.operators import reads

    df, made = counted(spark, [("a", "AAAA", 100), ("a", "AAAT", 9), ("a", "AATT", 1), ("a", "GGGG", 5)])
    assert {r["seq"]: r["centre"] for r in reads.denoise(df).collect()} == {"AAAA": "AAAA", "AAAT": "AAAA", "AATT": "AAAA", "GGGG": "GGGG"} and made.value == 4


def test_pairs_are_filtered_in_batches(spark):
    from taxaspark.operators import reads

    rng = np.random.default_rng(5)
    read = lambda n: ("".join(rng.choice(list("ACGTN"), n, p=[0.249] * 4 + [0.004])), "".join(chr(33 + x) for x in rng.choice([2, 10, 20, 30, 40], n, p=[0.004, 0.046, 0.1, 0.25, 0.6])))
    rows = [(i, read(int(rng.integers(0, 120))), read(int(rng.integers(15, 90)))) for i in range(400)] + [(400, None, read(60)), (401, (None, None), read(60)), (402, ("ACGT" * 20, None), ("ACGT" * 20, "I" * 80))]
    df = spark.createDataFrame(rows, "id int, r1 struct<seq:string,qual:string>, r2 struct<seq:string,qual:string>").repartition(3)
    for cut in ((0, 0), (40, 30)):
        trimmed = df.withColumns({f"r{i}": reads.trim_read(F.col(f"r{i}"), 2, cut[i - 1]) for i in (1, 2)})
        ok = F.lit(True)
        for i, most in ((1, 2), (2, 5)):
            ok = ok & (F.length(f"r{i}.seq") >= 20) & ~F.col(f"r{i}.seq").contains("N") & (dna.expected_errors(F.col(f"r{i}.qual")) <= most) & (F.length(f"r{i}.seq") <= 100)
        want = trimmed.where(ok).withColumns({f"ee{i}": dna.expected_errors(F.col(f"r{i}.qual")) for i in (1, 2)}).collect()
        got = reads.filter_pairs(df, cut, max_len=100, errors=True).collect()
        assert len(want) > 20 and sorted(want) == sorted(got)


def test_code_filter_keeps_every_known_code(spark):
    from taxaspark.functions import kmers

    rng = np.random.default_rng(2)
    codes = np.append(rng.integers(0, 1 << 60, 3000), 0)  # place 0 stands in a bucket of its own
    found = kmers.code_filter(spark.createDataFrame([(int(c),) for c in codes] + [(None,)], "kmer long"), "kmer")
    assert kmers.flagged(found, codes).all() and kmers.flagged(found, rng.integers(0, 1 << 60, 10_000)).mean() < 0.01
