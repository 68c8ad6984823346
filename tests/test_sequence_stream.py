"""Samples that arrive in any order give the batch run's table."""

import random

from taxaspark.operators import reads
from taxaspark.streaming import sequence_tables as S


def test_same_table_in_any_order(spark, tmp_path):
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    parents = [word(30) for _ in range(4)]
    chimera = parents[0][:12] + parents[1][12:]
    samples = {f"s{i}": [(p, rng.randint(40, 90)) for p in parents] + [(chimera, 5), (word(30), 3), ("ACG", 2)] for i in range(5)}
    rows = [(s, q, n) for s, own in samples.items() for q, n in own]
    df = spark.createDataFrame(rows, S.SCHEMA)
    bad = reads.bimeras(df).where("is_bimera").select("seq")
    want = sorted(map(tuple, reads.sequence_table(df.join(bad, "seq", "left_anti")).collect()))
    assert chimera not in {r[2] for r in want} and "ACG" in {r[2] for r in want}
    for turn in range(2):
        home = tmp_path / str(turn)
        order = list(samples)
        rng.shuffle(order)
        # one sample first, then the others, over a restart of the stream
        for part in (order[:1], order[1:]):
            for s in part:
                spark.createDataFrame([(s, q, n) for q, n in samples[s]], S.SCHEMA).coalesce(1).write.mode("append").parquet(str(home / "in"))
            S.start(spark, str(home / "in"), str(home / "state"), str(home / "checkpoint"), files=2).awaitTermination()
        assert sorted(map(tuple, S.table(spark, str(home / "state")).collect())) == want
