import random
import zlib

import numpy as np
import pyarrow as pa

from taxaspark.llm import quality_cnn as Q
from taxaspark.llm import queries


def plain_score(net, text):
    """One place, one filter at a time."""
    raw = (text or "").encode()
    chunks = [raw[s : s + Q.CHUNK].ljust(Q.CHUNK, b"\0") for s in Q.chunk_starts(len(raw))]
    said = []
    for c in chunks:
        places = [[sum(net.embed[c[i + k]] @ net.filters[k][:, f] for k in range(Q.WIDTH)) for i in range(Q.CHUNK - Q.WIDTH + 1)] for f in range(Q.FILTERS)]
        said.append([max(0.0, max(p) + net.bias[f]) for f, p in enumerate(places)])
    x = [*np.mean(said, 0), *np.max(said, 0)]
    return 1 / (1 + np.exp(-(np.dot(x, net.head) + net.intercept[0])))


def test_equals_plain():
    net = Q.Network.fresh(3)
    net.intercept[:] = 0.2
    texts = ["", None, "a short text", "é" * 300 + " tail", "x" * 511, "y" * 512 + "z", "skipped"]
    got = net.score(pa.array([*texts, "k"]).slice(0, 6))
    assert np.allclose(got, [plain_score(net, t) for t in texts[:6]], atol=1e-4)


def test_chunks_cover_every_byte():
    for n in (0, 1, 32, 33, 511, 512, 513, 992, 993, 5000):
        seen = np.zeros(n, bool)
        for s in Q.chunk_starts(n):
            seen[s : s + Q.CHUNK] = True
        assert seen.all() and (n == 0 or Q.chunk_starts(n)[-1] < n)
    raw = np.arange(1, 200, dtype=np.uint8)
    assert Q.cut_chunks(raw, np.array([0]), np.array([199]))[0, :199].tolist() == raw.tolist()


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    net = Q.Network(*(p.astype(np.float64) for p in Q.Network.fresh().parts()))
    net.tables = lambda: net.embed @ net.filters
    chunks = rng.integers(0, 256, (5, 64)).astype(np.uint8)
    args = (chunks, np.array([0, 0, 1, 2, 2]), np.array([0.0, 1, 1]), np.array([1.0, 2, 1]))
    _, slopes = net.gradients(*args)
    for part, slope in zip(net.parts(), slopes, strict=True):
        for _ in range(5):
            i = tuple(int(rng.integers(s)) for s in part.shape) if part is not net.embed else (int(chunks[0, 5]), int(rng.integers(Q.EMBED)))
            part[i] += 1e-5
            high = net.gradients(*args)[0]
            part[i] -= 2e-5
            low = net.gradients(*args)[0]
            part[i] += 1e-5
            assert abs((high - low) / 2e-5 - slope[i]) < 1e-6


def test_junk_deep_in_a_long_text_and_held_out(spark, docs):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("aeiou") + rng.choice("bdlmnrst") for _ in range(rng.randint(1, 4)))
    text = lambda n, y: " ".join(word() + ("" if y else rng.choice(["###", "&&&"])) for _ in range(n))
    rows = [(i, text(rng.randint(5, 200), i % 3 > 0)) for i in range(300)]
    labels = [(i, int(i % 3 > 0), 0) for i in range(300)] + [(None, 1, 0), (7, None, 0)]
    d = docs([*rows, (None, "no id"), (900, None), (901, ""), (902, text(3000, 1) + text(3000, 0)), (903, text(3000, 1)), rows[3]])
    net = Q.fit(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), steps=200)
    out = Q.score(d, net).collect()
    assert len(out) == 306 and all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in out)
    got = {r["doc_id"]: r for r in out}
    assert np.mean([got[i]["predicted"] == (i % 3 > 0) for i in range(300) if got[i]["held_out"]]) > 0.95
    assert got[900]["score"] == got[901]["score"] and got[902]["score"] < got[903]["score"]


def test_labels_missing(spark, docs):
    label = lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    d = docs([(1, "a"), (2, "b")])
    assert {r["score"] for r in Q.score(d, Q.fit(d, label([]))).collect()} == {0.5}
    assert all(r["predicted"] == 0 for r in Q.score(d, Q.fit(d, label([(1, 0, 0), (2, 0, 0)]))).collect())
    assert Q.score(docs([]), Q.fit(docs([]), label([]))).count() == 0


def test_held_out_area(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op13_quality_cnn(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out AND quality IS NOT NULL").toPandas()
    order = got["score"].rank().to_numpy()
    y = got["quality"].to_numpy()
    area = (order[y == 1].mean() - order[y == 0].mean()) / len(y) + 0.5
    assert area > 0.99 and (got["predicted"] == got["quality"]).mean() > 0.97
