import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from taxaspark.llm import queries
from taxaspark.llm import source_divergence as S

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return [t.translate(UPPER) for t in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text or "")]


def plain(rows, least):
    """The contract over (text, lang, source), with dictionaries."""
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = plain_terms(text)
        counts[lang, source].update(found)
        docs[lang].update(set(found))
    out = []
    for lang in {g for g, _ in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        sources = sorted((s for g, s in groups if g == lang), key=lambda s: s.encode())

        def shares(c, kept=kept):
            total = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 5) // total for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pair = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            term = [(q[t] - p[s][t], t.encode(), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            out += [(lang, s, "pair", o, -v, k) for k, (v, _, o) in enumerate(sorted(pair), 1)]
            out += [(lang, s, "term", t, -v, k) for k, (v, _, t) in enumerate(sorted(term)[:50], 1)]
    return sorted(out)


def corpus(seed, n, sources):
    rng = random.Random(seed)
    common = [f"w{i}"[0] + "abcdefghij"[i % 10] * (i // 10 + 1) for i in range(60)] + ["É", "日本", "ſ", "K", "ß\U00010400"]
    rows = []
    for _ in range(n):
        s = rng.randrange(sources)
        own = ["own" + "klmnopqrst"[s % 10] * (s // 10 + 1)] * rng.randrange(3)
        text = rng.choice([" ", "-", "1", "\n\t"]).join(rng.choices(common, k=rng.randrange(30)) + own)
        rows.append((text.upper() if rng.random() < 0.3 else text, rng.choice(["en", "de", None, ""]), rng.choice([f"s{s}", f"s{s}", "hot", "hot", None])))
    return rows + [(None, "en", "empty"), ("", "xx", "a"), (None, "xx", None), ("x" * 300_000 + " w" * 1000, "en", "s1")] + rows[:5]


@pytest.mark.parametrize("light,block", [(8, 256), (0, 7), (1000, 256), (3, 2)])
def test_equals_plain(spark, monkeypatch, light, block):
    monkeypatch.setattr(S, "BLOCK", block)
    monkeypatch.setattr(S, "DENSE", 16)
    monkeypatch.setattr(S, "SPARSE", 50)
    rows = corpus(light, 500, 14)
    df = spark.createDataFrame(rows, "text string, lang string, source string").selectExpr("*", "1 AS term", "2 AS g", "3 AS Value")
    got = sorted(tuple(r) for r in S.audit(df, least_docs=6, light=light).collect())
    assert got == plain(rows, 6)


def test_no_kept_terms_and_no_rows(spark):
    df = spark.createDataFrame([("a b", "en", "x"), ("c", "en", "y"), (None, None, None)], "text string, lang string, source string")
    assert sorted(map(tuple, S.audit(df).collect())) == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]
    assert S.audit(df.limit(0)).count() == 0


def test_terms_of_a_slice():
    texts = pa.array(["skip me", "Ab1É\tx", None, "", "yZ", "z"]).slice(1)
    owner, spelled = S.terms(texts.fill_null(""))
    assert list(zip(owner.tolist(), spelled.to_pylist(), strict=True)) == [(0, "ab"), (0, "É"), (0, "x"), (3, "yz"), (4, "z")]


def test_shares_of_huge_counts(spark):
    from pyspark.sql import functions as F

    big = 5 * 10**14
    df = spark.createDataFrame([(big, 3 * big, 10**9)], "c long, n long, v long").select(S.share(F.col("c"), F.col("n"), F.col("v")).alias("p"))
    assert df.first()["p"] == 1 + 10**9 * (big + 5) // (3 * big + 5 * 10**9)


def test_query_equals_sql(spark):
    from oracle import connect, difference

    assert difference(spark, connect("/root/testdata/sf0.01"), queries.op11_source_divergence, S.ORACLE_SQL, "/root/testdata/sf0.01") == ""
