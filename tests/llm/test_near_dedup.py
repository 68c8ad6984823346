import itertools
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from taxaspark.llm import near_dedup as N


def sets(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def plain(rows):
    s = {i: sets(t) for i, t in rows}
    root = {i: i for i in s}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(s), 2):
        if s[a] and s[b] and len(s[a] & s[b]) >= 0.8 * len(s[a] | s[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in s}


def corpus(seed=2):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    rows, k = [], 0
    for _ in range(60):
        base = [rng.choice(words) for _ in range(rng.randint(30, 200))]
        for _ in range(rng.choice([1, 1, 1, 2, 4])):
            w = list(base)
            for _ in range(rng.randint(0, len(w) // 40)):
                w[rng.randrange(len(w))] = rng.choice(words)
            rows.append((k, " ".join(w)))
            k += 1
    hub = [rng.choice(words) for _ in range(150)]
    for i in range(80):  # a chain-like group: links only through the middle
        w = list(hub)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((k, " ".join(w)))
        k += 1
    rows += [(k, None), (k + 1, ""), (k + 2, "... !"), (k + 3, "two words"), (k + 4, "Two, words."), (k + 5, "a"), (k + 6, " ".join(words * 12))]
    return rows


def test_classes_equal_brute_force(docs):
    rows = corpus()
    want = plain(rows)
    out = {r["doc_id"]: (r["class_id"], r["class_size"], r["kept"]) for r in N.classes(docs(rows)).collect()}
    sizes = {}
    for c in want.values():
        sizes[c] = sizes.get(c, 0) + 1
    assert out == {i: (c, sizes[c], i == c) for i, c in want.items()}
    kept = N.drop_near_copies(docs(rows))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want.values())) and kept.columns == docs([]).columns


def test_repeated_rows_null_ids_and_empty(docs):
    t = "one two three four five six seven"
    out = N.classes(docs([(4, t), (4, t), (None, t), (9, "other words are in this text here")])).collect()
    assert sorted((str(r["doc_id"]), r["class_id"], r["class_size"]) for r in out) == [("4", 4, 3), ("4", 4, 3), ("9", 9, 1), ("None", 4, 3)]
    assert N.drop_near_copies(docs([(4, t), (None, t)])).count() == 2
    assert N.classes(docs([])).count() == 0


def test_signature_estimates_probability_jaccard():
    rng = np.random.default_rng(3)
    ids = rng.integers(1, 2**63, 300).astype(np.uint64)
    x, y = dict.fromkeys(range(0, 200), 1.0), dict.fromkeys(range(80, 300), 1.0)
    for k in range(80, 140):
        x[k] = 4.0
    want = sum(1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in x.keys() | y.keys()) for d in x.keys() & y.keys())
    owner = np.array([0] * len(x) + [1] * len(y))
    sh, w = ids[[*x, *y]], np.array([*x.values(), *y.values()])
    sig = N.signatures(owner, sh, w, 2, 4096)
    assert abs((sig[0] == sig[1]).mean() - want) < 0.04


def test_shingles_of_short_and_repeated_texts():
    h, o = N.word_hashes(pa.array(["a b c", "", None, "x y z x y z x y z x y z", "a b c d e"]))
    owner, sh, count = N.shingles(h, o)
    assert np.bincount(owner, minlength=5).tolist() == [1, 0, 0, 3, 1] and count.sum() == 1 + 8 + 1


def test_common_counts_both_ways():
    rng = np.random.default_rng(1)
    make = lambda n, top: np.unique(rng.integers(0, top, n)).astype(np.uint32)
    a, b = [make(50, 100) for _ in range(5)], [make(60, 100) for _ in range(4)]
    want = [[len(np.intersect1d(x, y)) for y in b] for x in a]
    assert N.common_counts(a, b).tolist() == want
    big = [make(60_000, 70_000), make(60_000, 70_000)]
    assert N.common_counts(big[:1], big[1:])[0, 0] == len(np.intersect1d(*big))


def test_repeated_lines_keep_their_links(docs):
    rng = random.Random(4)
    rows = []
    for i in range(40):
        base, line = ([f"{w}{i}x{rng.randrange(10**6)}" for _ in range(n)] for w, n in (("a", 104), ("b", 18)))
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(base + line * 200))]
    want = plain(rows)
    linked = [i for i in range(40) if want[2 * i + 1] == 2 * i]
    out = {r["doc_id"]: r["class_id"] for r in N.classes(docs(rows)).collect()}
    assert len(linked) == 40 and out == want


def test_a_key_that_two_texts_share_is_parted(docs, monkeypatch):
    h, o = N.word_hashes(pa.array(["a b", "a b", "c d"]))
    first, _ = N._node(h, o)
    again, _ = N._node(h, o, frozenset(first.tolist()))
    assert first[0] == first[1] != first[2] and again[0] == again[1] != again[2] and not set(again.tolist()) & set(first.tolist())
    # all second keys of a first one must agree, or the texts are read again with that key parted
    seen = []
    own = N.sketch

    def sketch(d, words, shared=frozenset()):
        seen.append(shared)
        out = own(d, words, shared=shared)
        return out if shared else out.withColumn("second", F.xxhash64("doc_id"))

    monkeypatch.setattr(N, "sketch", sketch)
    rows = [(i, " ".join(f"w{i // 2}x{k}" for k in range(40))) for i in range(6)]
    out = {r["doc_id"]: r["class_id"] for r in N.classes(docs(rows)).collect()}
    assert [len(x) for x in seen] == [0, 3] and out == {i: i // 2 * 2 for i in range(6)}


def test_recall_against_exact_search(spark):
    """Queries are all rows whose id is divisible by 50; every row of exact Jaccard 0.8 or more counts."""
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    known = {i: sets(t) for i, t in rows}
    out = {r["doc_id"]: r["class_id"] for r in N.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    pairs = [(a, b) for a in known if a % 50 == 0 and known[a] for b in known if a != b and known[b] and len(known[a] & known[b]) >= 0.8 * len(known[a] | known[b])]
    found = sum(out[a] == out[b] for a, b in pairs)
    assert len(pairs) and found >= 0.9 * len(pairs)


def test_mixed_buckets_in_small_blocks(spark):
    rng = np.random.default_rng(5)
    base = [np.unique(rng.integers(0, 2**32, 40)).astype(np.uint32) for _ in range(6)]
    sets_ = [np.sort(np.concatenate([base[i % 6][: 40 - i // 30], rng.integers(0, 2**32, i // 30)]).astype(np.uint32)) for i in range(90)]
    member = spark.createDataFrame([(7, i, i) for i in range(90)], "bucket long, node long, root long")
    table = spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in enumerate(sets_)], "node long, shingles binary")
    for block, size in ((64, 1 << 20), (7, 1 << 20), (64, 1000)):
        got = {tuple(sorted(r)) for r in N.search_mixed(member, table, block=block, block_bytes=size).collect()}
        assert got == {(i, j) for i in range(90) for j in range(i + 1, 90) if len(np.intersect1d(sets_[i], sets_[j])) >= 0.8 * len(np.union1d(sets_[i], sets_[j]))}
