import random
import zlib

import numpy as np

from taxaspark.llm import toxicity as T


def corpus(n, seed=1):
    rng = random.Random(seed)
    syl = "an be co du el fi ga ho in ju ka lo mi no or pa re su ti un".split()
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice(syl) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(20, 120))]
        y = i % 4 == 0
        if y:
            for _ in range(max(1, len(words) // 20)):
                words.insert(rng.randrange(len(words)), rng.choice(["zwyrk", "zwyrkes", "qvexing"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(y)))
    return rows, labels


def test_distributions_sum_to_one():
    codes = np.concatenate([T.grams("the cat sat on the mat", 3), T.grams("a dog ran", 3)])
    counts = np.bincount(codes, minlength=T.SYMBOLS**3).astype(float)
    low = T.shared_backoff(counts, 3)
    assert np.allclose(low.reshape(-1, T.SYMBOLS).sum(1), 1)
    assert np.allclose(T.class_model(counts, low).reshape(-1, T.SYMBOLS).sum(1), 1)


def test_grams_fold_and_mark_the_end():
    assert len(T.grams(None)) == len(T.grams("")) == len(T.grams("!? ...")) == 0
    assert (T.grams("Été") == T.grams("ete")).all() and (T.grams("a  - b") == T.grams("a b")).all()
    code = 0
    for x in (0, 0, 0, 1):
        code = code * T.SYMBOLS + x
    assert T.grams("a")[0] == code and len(T.grams("a")) == 2


def test_held_out_accuracy(spark, docs):
    rows, labels = corpus(900)
    d = docs(rows + [(10_000, None), (10_001, ""), (0, rows[0][1])])
    model = T.fit(d, spark.createDataFrame(labels + [(None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int"))
    out = T.score(d, model).collect()
    assert len(out) == len(rows) + 3
    truth = {i: y for i, _, y in labels}
    held = [r for r in out if r["held_out"] and r["doc_id"] in truth]
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) == r["held_out"] for r in out)
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in out)
    empty = [r["score"] for r in out if r["doc_id"] in (10_000, 10_001)]
    assert empty[0] == empty[1] < 0.7
    kept = T.drop_toxic(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert kept.columns == d.columns and 600 < kept.count() < 750


def test_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert T.score(docs([(1, "a b")]), T.fit(docs([(1, "a b")]), none)).first()["predicted"] == 0
    assert T.score(docs([]), T.fit(docs([]), none)).count() == 0


def test_other_alphabets_and_rare_labels(spark, docs):
    # Same word lengths in both classes; the folded characters can't tell them apart.
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(600):
        words = ["".join(rng.choice("абвгдежзик") for _ in range(4)) for _ in range(30)]
        bad = i % 5 == 0
        words[7], words[19] = ("щщщщ", "ыыыы") if bad else ("лллл", "мммм")
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    truth = {i: y for i, _, y in labels}
    d, known = docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    small = {r["doc_id"]: r for r in T.score(d, T.fit(d, known)).collect()}
    assert np.mean([r["predicted"] == truth[i] for i, r in small.items() if r["held_out"]]) > 0.97
    # a table of expressions too large for a broadcast is joined, with the same scores
    joined = {r["doc_id"]: r for r in T.score(d, T.fit(d, known, max_expressions=0)).collect()}
    assert len(joined) == len(small) and all(abs(joined[i]["score"] - small[i]["score"]) < 1e-6 for i in small)
    assert sorted(r["doc_id"] for r in T.drop_toxic(d, known, max_expressions=0).select("doc_id").collect()) == sorted(i for i, r in small.items() if not r["predicted"])


def test_expressions_of_all_scripts():
    import pyarrow as pa

    owner, key, count, n = T.expressions(pa.array(["One two one two", None, "你好 你好", "!?", "\U00010400\U00010401 x"]))
    assert n.tolist() == [4, 0, 4, 0, 2] and len(set(key.tolist())) == 4 + 4 + 3
    assert np.bincount(owner, count, 5).tolist() == [7, 0, 7, 0, 3]


def test_every_labelled_row_is_counted(spark, docs):
    rows = [(i, f"word{i} word{i}") for i in range(60)]
    fitted = T.fit(docs(rows), spark.createDataFrame([(i, 1, i % 2) for i in range(60)], "doc_id long, quality int, toxic int"))
    assert fitted.table.count() == sum(zlib.crc32(str(i).encode()) % 3 != 1 for i in range(60))


def test_ratios_are_those_of_a_plain_class_conditional_model():
    import math

    texts, labels = ["good day sun", "bad day bad", "bad scum day", "sun day"], np.array([0, 1, 1, 0])
    stands = lambda w, y: sum(w in t.split() for t, z in zip(texts, labels, strict=True) if z == y)
    kinds = sorted({w for t in texts for w in t.split()})
    total, seen = [sum(stands(w, y) for w in kinds) for y in (0, 1)], [sum(stands(w, y) > 0 for w in kinds) for y in (0, 1)]
    sizes = T.Sizes(total[1], total[0], seen[1], seen[0], len(kinds))

    def p(w, y, spelled):
        shared = max(stands(w, 0) + stands(w, 1) - 1, 0) / sum(total) + len(kinds) / sum(total) * spelled
        return max(stands(w, y) - 1, 0) / total[y] + seen[y] / total[y] * shared

    for w, a, b in (("bad", 0.01, 0.02), ("day", 0.1, 0.1), ("new", 0.001, 0.0005)):
        got = T._np_ratio(sizes, np.array([stands(w, 1)]), np.array([stands(w, 0)]), np.array([a]), np.array([b]))[0]
        assert abs(got - math.log(p(w, 1, a) / p(w, 0, b))) < 1e-12


def test_own_counts_are_taken_out():
    import pyarrow as pa

    texts, labels = ["one two two", "three one", "four two"], np.array([True, False, True])

    def counted(which):
        both = [np.zeros(T.SYMBOLS**3), np.zeros(T.SYMBOLS**3)]
        for i in which:
            np.add.at(both[0 if labels[i] else 1], T.grams(texts[i], 3), 1)
        return both

    every = counted(range(3))
    backoff = T.shared_backoff(every[0] + every[1], 3)
    words = T.read_words(pa.array(texts))
    a, b = T.CharacterCounts(tuple(every), backoff, 3).without_own(words, labels)
    for i in range(3):
        rest = counted([k for k in range(3) if k != i])
        logs = [np.log(T.class_model(c, backoff)) for c in rest]
        for k in np.flatnonzero(words.owner == i):
            codes = T.word_codes([words.spelled[words.code[k]]], 3)[0]
            assert abs(a[k] - logs[0][codes].sum()) < 1e-9 and abs(b[k] - logs[1][codes].sum()) < 1e-9


def test_held_out_area(spark):
    from taxaspark.llm import queries

    sf = "/root/testdata/sf0.1"
    got = queries.op3_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out AND toxic IS NOT NULL").toPandas()
    order, y = got["score"].rank().to_numpy(), got["toxic"].to_numpy()
    area = (order[y == 1].mean() - order[y == 0].mean()) / len(y) + 0.5
    assert area > 0.95 and got["predicted"][y == 1].mean() >= 0.8 and got["predicted"][y == 0].mean() < 0.02


def test_pairs_tell_where_words_do_not(spark, docs):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(600):
        words = [rng.choice(["red", "blue", "green", "tall", "thin", "old"]) for _ in range(20)]
        bad = i % 3 == 0
        words[4:6] = ["left", "right"] if bad else ["right", "left"]
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    truth = {i: y for i, _, y in labels}
    d, known = docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    for most in (2_000_000, 0):
        got = [r for r in T.score(d, T.fit(d, known, pairs=True, max_expressions=most)).collect() if r["held_out"]]
        assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in got]) > 0.95
