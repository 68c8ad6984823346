import math
import random

import numpy as np
import pyarrow as pa
import pytest

from taxaspark.llm import hard_negatives as H
from taxaspark.llm import queries


def plain(rows):
    """The contract, row by row, in Python's own numbers."""
    good = []
    for i, v, y in rows:
        if y is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        good.append((i, (y + 1) % 10 if i is not None and i % 7 == 0 else y, [math.floor(256 * x) for x in v]))
    order = lambda s: (-s[0], s[1] is None, s[1] or 0)
    out = []
    for a, (i, y, v) in enumerate(good):
        if i is None or i % 50:
            continue
        every = [(sum(p * q for p, q in zip(v, w, strict=False)), j, z) for b, (j, z, w) in enumerate(good) if b != a]
        for s, j, _ in sorted((x for x in every if x[2] == y), key=order)[:5]:
            window = [x for x in every if x[2] != y and 50 * s <= 100 * x[0] <= 95 * s]
            out += [(i, j, k + 1, n, s, t) for k, (t, n, _) in enumerate(sorted(window, key=order)[:3])]
    return sorted(out, key=repr)


def mined(spark, rows, **extra):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    for name in extra:
        df = df.selectExpr("*", f"1 AS `{name}`")
    return sorted((tuple(r) for r in H.mine(H.quantised(df)).collect()), key=repr)


@pytest.mark.parametrize("seed,dims,scale", [(1, 8, 0.4), (2, 3, 0.02), (3, 70, 1e4), (4, 5, 1e5)])
def test_equals_plain(spark, seed, dims, scale):
    rng = random.Random(seed)
    rows = [(i * 5, [rng.gauss(0.3, 1) * scale for _ in range(dims)], rng.randrange(3)) for i in range(160)]
    rows += rows[:12] + rows[30:34]  # repeated rows, among them anchors
    rows += [(1000, None, 1), (1050, [1.0] * dims, None), (1100, [1.0, None] + [0.0] * (dims - 2), 1), (1150, [float("nan")] * dims, 2), (None, [scale] * dims, 1), (1250, [], 0), (1300, [scale] * (dims - 1), 1), (-50, [scale] * dims, -3), (1350, [scale] * dims, 1), (1351, [scale] * dims, 2)]
    assert mined(spark, rows) == plain(rows) != []


def test_ties_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK", 3)
    monkeypatch.setattr(H, "GROUP", 40)
    rng = random.Random(9)
    rows = [(i * 10, [rng.choice([0.25, 0.5, 0.75]) for _ in range(4)], rng.randrange(2)) for i in range(200)]
    assert mined(spark, rows, row=1, v=1, score=1) == plain(rows)


def test_nothing(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1)]) == [] and mined(spark, [(50, [1.0], 1)]) == []
    with pytest.raises(ValueError, match="long"):
        mined(spark, [(50, [1e300], 1), (51, [1.0], 1)])


def test_intervals_save_products():
    rng = np.random.default_rng(0)
    v = np.floor(256 * rng.normal(0, 0.125, (1500, 64))).astype(np.int64)
    shape = H.Shape.of(64, float(np.abs(v).max()))
    assert shape.kind is np.float32
    sweep = H.Sweep(shape, v[:50], np.arange(50), np.zeros(50, np.int64), np.full((50, 1), -np.inf), np.full((50, 1), np.inf), 5, True)
    sweep.add(shape.slice(v), np.arange(1500), np.zeros(1500, np.int64), np.zeros(1500, bool), np.arange(1500))
    exact = v[:50] @ v.T
    np.fill_diagonal(exact, -(1 << 40))
    assert sweep.best[1].reshape(50, 5).tolist() == np.sort(exact, 1)[:, :-6:-1].tolist()
    assert sweep.products < 0.8 * v[:50].size * 1500 * shape.planes  # of all planes for all pairs


def streamed(v, label, anchors, low, high, keep, same, tile=500):
    shape = H.Shape.of(v.shape[1], float(np.abs(v).max()))
    sweep = H.Sweep(shape, v[anchors], np.asarray(anchors), label[anchors], low, high, keep, same)
    for i in range(0, len(v), tile):
        n = len(v[i : i + tile])
        sweep.add(shape.slice(v[i : i + tile]), np.arange(i, i + n), label[i : i + tile], np.zeros(n, bool), np.arange(i, i + n))
    return sweep


def test_only_rows_of_the_label_are_multiplied(monkeypatch):
    rng = np.random.default_rng(1)
    v, label = np.floor(256 * rng.normal(0, 0.125, (2000, 16))).astype(np.int64), rng.integers(0, 10, 2000)
    anchors, calls, partition = np.arange(0, 2000, 5), [], np.partition
    monkeypatch.setattr(np, "partition", lambda x, *a: calls.append(x.shape) or partition(x, *a))
    none = np.full((400, 1), -np.inf)
    sweep = streamed(v, label, anchors, none, -none, 5, True)
    score = np.where(label[anchors][:, None] == label, v[anchors] @ v.T, -(1 << 40))
    score[np.arange(400), anchors] = -(1 << 40)
    assert sweep.best[1].reshape(400, 5).tolist() == np.sort(score, 1)[:, :-6:-1].tolist()
    assert sweep.products < 0.5 * v[anchors].size * 2000 * sweep.shape.planes
    # Rows held from the first tile bound the others: their lower ends aren't looked for.
    assert calls and sum(a * b for a, b in calls) <= 400 * 500 * sweep.shape.planes


@pytest.mark.parametrize("scale,kind", [(1, np.float32), (1e4, np.float64), (1e6, np.int64)])
def test_parts_of_anchors_and_few_planes_held_give_the_same(monkeypatch, scale, kind):
    rng = np.random.default_rng(2)
    v, label = np.floor(scale * rng.normal(0, 20, (300, 7))).astype(np.int64), rng.integers(-2, 5, 300)
    anchors = np.arange(0, 300, 4)
    goal = np.sort(rng.integers(1, int(800 * scale * scale), (75, 3)).astype(float), 1)
    wanted = None
    for at_once, held in ((1000, 1 << 30), (7, 1 << 30), (3, 1)):
        monkeypatch.setattr(H, "AT_ONCE", at_once)
        monkeypatch.setattr(H, "PLANES_HELD", held)
        got = [streamed(v, label, anchors, *args, tile=90) for args in ((np.full((75, 1), -np.inf), np.full((75, 1), np.inf), 5, True), (goal // 2, goal, 3, False))]
        assert got[0].shape.kind is kind and len(got[1].best[0])
        found = [[c.tolist() for c in sweep.best] for sweep in got]
        wanted = wanted or found
        assert found == wanted
    score = v[anchors] @ v.T
    for place, i in enumerate(anchors):
        fits = [score[place, j] for j in range(300) if label[j] != label[i] and goal[place, 1] // 2 <= score[place, j] <= goal[place, 1]]
        mine = np.asarray(found[1][0]) == place * 3 + 1
        assert np.asarray(found[1][1])[mine].tolist() == sorted(fits, reverse=True)[:3]


def test_planes_give_the_numbers_back():
    v = np.array([[-256, 255, 0], [1, -1, 127]])
    shape = H.Shape.of(3, 256.0)
    data = shape.slice(v)
    again = sum((-(1 << shape.planes - 1) if k == 0 else 1 << shape.planes - 1 - k) * shape.plane(data, k, 2) for k in range(shape.planes))
    assert (again == v).all() and pa.array([data], pa.binary())[0].as_py() == data


def test_query_equals_sql(spark, sf_dir):
    from oracle import connect, difference

    assert difference(spark, connect(sf_dir), queries.op12_hard_negatives, H.ORACLE_SQL, sf_dir) == ""
