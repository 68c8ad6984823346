import itertools
import random
import zlib

import numpy as np
import pyarrow as pa

from taxaspark.llm import language_crf as L

SYL = {"en": "th er on an re he in ed nd ha".split(), "fr": "eau oi que ment tion elle é ai oux".split(), "de": "sch ung keit ein ich pf tz ü ver".split()}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(SYL[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(1)
    e, t = rng.normal(size=(4, 3)), rng.normal(size=(3, 3))
    got, pairs = L.marginals(e, np.array([0, 4, 4]), t, pairs=True)
    want, expected, z = np.zeros((4, 3)), np.zeros((3, 3)), 0
    for path in itertools.product(range(3), repeat=4):
        w = np.exp(sum(e[i, k] for i, k in enumerate(path)) + sum(t[a, b] for a, b in itertools.pairwise(path)))
        z += w
        for i, k in enumerate(path):
            want[i, k] += w
        for a, b in itertools.pairwise(path):
            expected[a, b] += w
    assert np.allclose(got, want / z) and np.allclose(pairs, expected / z)
    many = np.concatenate([e, e[:2], e])
    again, _ = L.marginals(many, np.array([0, 4, 6, 10]), t)
    assert np.allclose(again[:4], got) and np.allclose(again[6:], got)


def test_words_are_labelled_in_mixed_text():
    rng = random.Random(2)
    model = L.train([(text(rng, x, 80), x) for x in SYL for _ in range(12)], rounds=15)
    vocabulary, codes, offsets = L.words(pa.array([text(rng, "en", 30) + " " + text(rng, "fr", 30)]))
    post, _ = L.marginals(model.emissions(vocabulary)[codes], offsets, model.transitions)
    best = [model.labels[k] for k in post.argmax(1)]
    assert np.mean([b == "en" for b in best[:30]]) > 0.9 and np.mean([b == "fr" for b in best[30:]]) > 0.9


def test_held_out_accuracy(spark):
    rng = random.Random(3)
    rows = [(i, text(rng, x, rng.randint(5, 60)), x, "s") for i, x in enumerate(rng.choice(list(SYL)) for _ in range(400))]
    extra = [(1000, None, "en", "s"), (1001, "", "en", "s"), (1002, "123 !", None, "s"), (1003, text(rng, "de", 30_000), None, "s"), (0, rows[0][1], "en", "s")]
    d = spark.createDataFrame([(*r, 0.5) for r in rows + extra], "doc_id long, text string, lang string, source string, score double")
    out = {(r["doc_id"]): r for r in L.identify(d, L.fit(d)).collect()}
    held = [r for r in rows if out[r[0]]["held_out"]]
    assert np.mean([out[r[0]]["lang_pred"] == r[2] for r in held]) > 0.97
    assert [out[i]["lang_pred"] for i in (1000, 1001, 1002, 1003)] == ["und"] * 3 + ["de"]
    assert all(0 <= r["score"] <= 1 for r in out.values())
    assert L.identify(d.limit(0), L.fit(d.limit(0))).count() == 0
    assert {r["lang_pred"] for r in L.identify(d, L.fit(d.limit(0))).collect()} == {"und"}


def test_every_language_can_be_predicted(spark):
    """More languages than the rows of the fit would hold at the full number each, one of them with a single text."""
    rows = [(i, " ".join(f"{chr(97 + k // 26 % 26)}{chr(97 + k % 26)}q{w}" for w in ("uno", "dua", "tri")), f"l{k:03d}") for i, k in enumerate(k for k in range(300) for _ in range(6))]
    rare = next(i for i in range(10_000, 10_100) if zlib.crc32(str(i).encode()) % 3 != 1)
    d = spark.createDataFrame([*rows, (rare, "жжж щщщ ъъъ", "rare")], "doc_id long, text string, lang string")
    model = L.fit(d, max_rows=1000, bits=14)
    learned = {r[2] for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1}  # those with a row that isn't held out
    assert set(model.labels) == learned | {"rare"} and len(learned) > 290
    rows = [r for r in rows if r[2] in learned]
    langs, _ = model.predict(pa.array(["жжж щщщ", *(r[1] for r in rows)]), {}, [])
    assert langs[0] == "rare" and np.mean([a == r[2] for a, r in zip(langs[1:], rows, strict=True)]) > 0.9
