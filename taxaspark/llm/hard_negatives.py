"""Hard negatives by bit-sliced integer products.

Vectors are integers per component. Rows are packed into tiles that hold them as bit-planes, sign
plane first; anchors are packed into blocks of whole numbers. A task streams the tiles of one group of
rows past one block of anchors. Within a tile the planes are multiplied most significant first: with
``p`` planes still to come, a product lies between ``sum + (2**p - 1) * negative`` and ``sum +
(2**p - 1) * positive``, the sums of the anchor's negative and positive components. A candidate
goes as soon as its interval can't reach what its anchor holds already, or lies outside the anchor's
window. Where labels must be the same, only rows of an anchor's label and its neighbours' are multiplied. While many candidates are left a plane is one matrix product, later only the pairs that
remain are multiplied. Products are exact: the number type follows from the largest possible score.

The first sweep finds each anchor's positives, the second its negatives below each positive. A sweep
gives the best few per anchor and group of rows, never pairs, and a window merges the groups.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxaspark.llm.common import cut

#: Rows of a tile, anchors of a block (about), rows of a group (at least), groups (at most).
TILE, BLOCK, GROUP, GROUPS = 2048, 2048, 8192, 1024
#: Anchors of a block that are multiplied with a tile at once.
AT_ONCE = 128
#: Bytes of a tile's planes that are kept unpacked from one part of the anchors to the next.
PLANES_HELD = 32 << 20
#: Below this share of candidates only the remaining pairs are multiplied.
SPARSE = 1 / 16
PAIRS_AT_ONCE = 50_000


def quantised(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", scale: float = 256.0, shift_every: int = 7, classes: int = 10) -> DataFrame:
    """vec_id, label, v (double): rows that take part, components as floor(scale * x), labels of every ``shift_every``-th id moved on by one.

    Rows with a null label, a null vector or any null or non-finite component are left out. A null
    id takes part (never as an anchor), an empty vector has only zero components.
    """
    x = F.col(f"`{vector}`")
    number = F.transform(x, lambda c: c.cast("double"))
    odd = F.exists(number, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    i, y = F.col(f"`{vec_id}`").cast("long"), F.col(f"`{label}`").cast("long")
    moved = F.when(i % shift_every == 0, (y + 1) % classes).otherwise(y)
    return rows.where(x.isNotNull() & y.isNotNull()).where(~odd).select(
        i.alias("vec_id"), moved.alias("label"), F.transform(number, lambda c: _floor(c * scale)).alias("v")
    )


def _floor(x: Column) -> Column:
    """floor as a double, also where a long can't hold it (there every double is whole)."""
    return F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x)


@dataclass
class Shape:
    """What the products need: components, planes and the type that holds every sum exactly."""

    dims: int
    planes: int
    kind: type

    @staticmethod
    def of(dims: int, largest: float) -> Shape:
        planes = int(largest).bit_length() + 1
        bound = max(1, dims) * max(1, int(largest)) << planes
        if bound >= 1 << 62:
            raise ValueError(f"scores of {dims} components up to {largest:.4g} don't fit in a long")
        return Shape(dims, planes, np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64)

    def slice(self, v: np.ndarray) -> bytes:
        """Bit-planes of whole numbers (rows, dims), sign plane first, each padded to whole bytes."""
        u = v.astype(np.int64) & ((1 << self.planes) - 1)
        return b"".join(np.packbits(((u >> k) & 1).astype(bool).ravel()).tobytes() for k in range(self.planes - 1, -1, -1))

    def bits(self, data: bytes, k: int, rows: int) -> np.ndarray:
        """The ``k``-th plane of a tile, as bytes 0 and 1."""
        size = -(-rows * self.dims // 8)
        return np.unpackbits(np.frombuffer(data, np.uint8, size, k * size), count=rows * self.dims).reshape(rows, self.dims)

    def plane(self, data: bytes, k: int, rows: int) -> np.ndarray:
        """The ``k``-th plane of a tile, as 0 and 1."""
        return self.bits(data, k, rows).astype(self.kind)

    def within(self, score: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether scores (anchors, rows) lie in each anchor's [low, high], whole numbers or infinite."""
        if self.kind is np.float32:  # scores stay below 2**24, and up to there every whole number has its own value
            low, high = (np.clip(x, -(1 << 24), 1 << 24).astype(np.float32) for x in (low, high))
        else:
            score = score.astype(np.float64, copy=False)
        fits = score >= low[:, None]
        if high.min(initial=np.inf) < (1 << 24 if self.kind is np.float32 else np.inf):
            fits &= score <= high[:, None]
        return fits


class Sweep:
    """One block of anchors past which tiles are streamed; keeps the best ``keep`` rows for each goal of each anchor.

    Goals are windows [low, high] of scores, one or several per anchor. ``same`` tells whether rows of the
    anchor's label are wanted or rows of other labels.
    """

    def __init__(self, shape: Shape, v: np.ndarray, row: np.ndarray, label: np.ndarray, low: np.ndarray, high: np.ndarray, keep: int, same: bool):
        self.shape, self.v, self.row, self.label, self.keep, self.same = shape, v.astype(shape.kind), row, label, keep, same
        self.low, self.high = low.astype(np.float64), high.astype(np.float64)
        self.need = self.low.copy()  # the least score that can still enter
        self.positive, self.negative = np.maximum(self.v, 0).sum(1), np.minimum(self.v, 0).sum(1)
        self.parts = [p for p in np.array_split(np.argsort(label, kind="stable"), -(-len(label) // AT_ONCE) or 1) if len(p)]
        # goal (anchor * goals + goal), score, no id, id of the rows held
        self.best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))
        self.products = 0  # component products made, for the tests

    def add(self, data: bytes, row: np.ndarray, label: np.ndarray, no_id: np.ndarray, ids: np.ndarray) -> None:
        held = max(1, PLANES_HELD // max(1, len(row) * self.shape.dims))
        plane = lru_cache(held)(lambda k: self.shape.bits(data, k, len(row)))
        found = [self._remaining(plane, row, label, part, rows) for part, rows in self._meeting(label)]
        at, to, score = (np.concatenate(x) for x in zip((np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, self.shape.kind)), *found, strict=True))
        goals = self.low.shape[1]
        at, to, score = np.repeat(at, goals), np.repeat(to, goals), np.repeat(score, goals)
        goal = np.tile(np.arange(goals), len(at) // goals) if goals else at
        fits = (score >= self.need[at, goal]) & (score <= self.high[at, goal])
        at, to, goal, score = at[fits], to[fits], goal[fits], score[fits].astype(np.int64)
        cols = [np.concatenate(x) for x in zip(self.best, (at * goals + goal, score, no_id[to], ids[to]), strict=True)]
        order = np.lexsort((cols[3], cols[2], -cols[1], cols[0]))
        cols = [c[order] for c in cols]
        first = np.searchsorted(cols[0], cols[0])
        place = np.arange(len(order)) - first
        held = place < self.keep
        full = place == self.keep - 1
        where = cols[0][full]
        self.need.ravel()[where] = np.maximum(self.need.ravel()[where], cols[1][full])
        self.best = tuple(c[held] for c in cols)

    def _meeting(self, label: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Anchors in parts, and the rows of a tile that may be wanted for them: where labels must be the same, those from the part's least to its greatest."""
        order = np.argsort(label, kind="stable")
        for part in self.parts:
            first, last = np.searchsorted(label[order], self.label[part[0]]), np.searchsorted(label[order], self.label[part[-1]], "right")
            rows = order[first:last] if self.same else np.arange(len(label))
            if len(rows):
                yield part, rows

    def _remaining(self, plane: Callable[[int], np.ndarray], row: np.ndarray, label: np.ndarray, part: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchor (of ``part``), row of the tile (of ``rows``) and exact score of the pairs that no interval ruled out."""
        shape, n, v = self.shape, len(rows), self.v[part]
        need, highest, positive, negative = self.need[part], self.high[part], self.positive[part], self.negative[part]
        alive = (self.label[part][:, None] == label[rows]) == self.same
        alive &= self.row[part][:, None] != row[rows]
        alive &= (self.low[part] <= highest).any(1)[:, None] if self.low.shape[1] else False
        least, most = need.min(1, initial=np.inf), highest.max(1, initial=-np.inf)
        # Only an anchor that doesn't hold enough rows yet has no bound of its own.
        open_ = self.low.shape[1] == 1 and n > self.keep and highest.min(initial=np.inf) == np.inf and least.min(initial=np.inf) == -np.inf
        total = np.zeros(alive.shape, shape.kind)
        pairs = None
        for k in range(shape.planes):
            left = shape.planes - 1 - k
            weight = shape.kind(-(1 << left) if k == 0 else 1 << left)
            slack = (1 << left) - 1
            bits = plane(k)
            if pairs is None:
                total += (weight * v) @ bits[rows].astype(shape.kind).T
                self.products += v.size * n
                low, high = negative * shape.kind(slack), positive * shape.kind(slack)
                if open_:
                    # The keep-th best lower end within the tile is as good as a row held.
                    ends = np.where(alive, total.astype(np.float64), -np.inf)
                    least = np.maximum(least, np.partition(ends, n - self.keep, 1)[:, n - self.keep] + low)
                alive &= shape.within(total, least - high, most - low)
                if np.count_nonzero(alive) <= SPARSE * alive.size:
                    pairs = np.nonzero(alive)
                    score = total[pairs]
            else:
                at, to = pairs
                for i in range(0, len(at), PAIRS_AT_ONCE):
                    some = slice(i, i + PAIRS_AT_ONCE)
                    score[some] += weight * np.einsum("ij,ij->i", v[at[some]], bits[rows[to[some]]])
                self.products += len(at) * shape.dims
                high, low = score + positive[at] * shape.kind(slack), score + negative[at] * shape.kind(slack)
                keep = np.zeros(len(at), bool)
                for g in range(self.low.shape[1]):
                    keep |= (high >= np.maximum(need[at, g], least[at])) & (low <= highest[at, g])
                pairs, score = (at[keep], to[keep]), score[keep]
        if pairs is None:
            pairs = np.nonzero(alive)
            score = total[pairs]
        return part[pairs[0]], rows[pairs[1]], score


def _tiles(base: DataFrame, shape: Shape, groups: int) -> DataFrame:
    """part, kind 1, rows, labels, ids and bit-planes of the rows, packed where they stand."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, TILE):
                b = whole.slice(k, TILE)
                v = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, shape.dims)
                lists = [pa.array([b.column(c).to_pylist()], pa.list_(pa.int64())) for c in ("row", "label", "vec_id")]
                yield pa.RecordBatch.from_arrays([*lists, pa.array([shape.slice(v)], pa.binary())], ["rows", "labels", "ids", "data"])

    out = base.mapInArrow(pack, "rows array<long>, labels array<long>, ids array<long>, data binary")
    return out.withColumn("part", F.pmod(F.xxhash64(F.col("rows")[0]), F.lit(groups)))


def _blocks(anchors: DataFrame, count: int) -> DataFrame:
    """block and its anchors (row, vec_id, label, v, goals); about ``BLOCK`` of them each, however many there are."""
    one = F.struct("row", "vec_id", "label", "v", "goals")
    return anchors.groupBy(F.pmod(F.xxhash64("row"), F.lit(count)).alias("block")).agg(F.collect_list(one).alias("anchors"))


def _sweep(tiles: DataFrame, blocks: DataFrame, groups: int, count: int, shape: Shape, keep: int, same: bool, low: int, high: int) -> DataFrame:
    """Best rows of every anchor, goal and group of rows.

    Tiles are dealt to every block, blocks to every group; a partition holds cells (group, block) in order,
    the block before its tiles, so a task has one block, one tile and the best rows in memory.
    """
    parts = tiles.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(count - 1)))).withColumn("block", F.col("block").cast("long"))
    parts = parts.select("part", "block", F.lit(1).alias("kind"), "rows", "labels", "ids", "data", F.lit(None).cast(blocks.schema["anchors"].dataType).alias("anchors"))
    firsts = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<long>")))
    none = [F.lit(None).cast(t).alias(c) for c, t in (("rows", "array<long>"), ("labels", "array<long>"), ("ids", "array<long>"), ("data", "binary"))]
    cells = parts.unionByName(firsts.select("part", "block", F.lit(0).alias("kind"), *none, "anchors"))
    cells = cells.repartition(min(20_000, 3 * groups * count), "part", "block").sortWithinPartitions("part", "block", "kind")
    dims = shape.dims

    def begin(anchors: pa.ListScalar) -> tuple[Sweep, pa.StructArray]:
        a = anchors.values
        n = len(a)
        v = a.field("v").flatten().to_numpy(zero_copy_only=False).reshape(n, dims)
        goals = [[s for _, s, _ in map(dict.values, g or ())] for g in a.field("goals").to_pylist()]
        if same:
            lows, highs = np.full((n, 1), -np.inf), np.full((n, 1), np.inf)
        else:
            width = max(1, max(map(len, goals), default=1))
            lows, highs = np.full((n, width), np.inf), np.full((n, width), -np.inf)
            for i, g in enumerate(goals):
                for j, s in enumerate(g):
                    lows[i, j], highs[i, j] = -(-low * s // 100), high * s // 100
        return Sweep(shape, v, a.field("row").to_numpy(), a.field("label").to_numpy(), lows, highs, keep, same), a

    def told(sweep: Sweep, a: pa.StructArray) -> pa.RecordBatch:
        goal, score, no_id, ids = sweep.best
        anchor = pa.array(goal // sweep.low.shape[1])
        return pa.RecordBatch.from_arrays(
            [a.field("row").take(anchor), a.field("vec_id").take(anchor), pa.array((goal % sweep.low.shape[1]).astype(np.int32)), pa.array(score), pa.array(ids, mask=no_id)],
            ["row", "anchor_id", "goal", "score", "other_id"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for b in batches:
            for i in range(b.num_rows):
                if b.column("kind")[i].as_py() == 0:
                    if now is not None:
                        yield told(*now)
                    now = begin(b.column("anchors")[i])
                elif now is not None:
                    row, label, ids = (b.column(c)[i].values for c in ("rows", "labels", "ids"))
                    no_id = ids.is_null().to_numpy(zero_copy_only=False)
                    now[0].add(b.column("data")[i].as_py(), row.to_numpy(), label.to_numpy(), no_id, ids.fill_null(0).to_numpy())
        if now is not None:
            yield told(*now)

    return cells.mapInArrow(run, "row long, anchor_id long, goal int, score long, other_id long")


def _first(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("other_id"))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def mine(rows: DataFrame, anchor: Column | None = None, n_positives: int = 5, n_negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """Negatives of every anchor and positive: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` has vec_id, label and v (whole numbers as doubles, as ``quantised`` gives them). Anchors are the
    rows for which ``anchor`` holds (ids divisible by 50). An anchor's positives are its first
    ``n_positives`` other rows of its label by score, ties by smaller id, null ids last; its negatives for one
    of them the first ``n_negatives`` rows of other labels with ``low * positive <= 100 * negative <=
    high * positive``. Shorter vectors count as filled up with zeros. Repeated rows are rows of
    their own: each can be an anchor, and a copy can be another's positive. Anchors without
    positives and positives without negatives give no row, an empty table gives none. Scores must fit in a
    long, otherwise a ValueError tells so before any is made.
    """
    base = cut(rows.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("v").cast("array<double>")))
    anchor = F.col("vec_id") % 50 == 0 if anchor is None else anchor
    got = base.agg(F.count("*").alias("n"), F.count(F.when(anchor, 1)).alias("anchors"), F.max(F.size("v")).alias("dims"), F.max(F.array_max(F.transform("v", F.abs))).alias("most")).first()
    shape = Shape.of(got["dims"] or 1, got["most"] or 0.0)
    base = base.withColumn("v", F.concat("v", F.array_repeat(F.lit(0.0), F.lit(shape.dims) - F.size("v"))))
    groups = max(1, min(GROUPS, math.ceil(got["n"] / GROUP)))
    count = max(1, math.ceil(got["anchors"] / BLOCK))
    tiles = cut(_tiles(base, shape, groups))
    anchors = base.where(anchor)
    goal = "struct<goal: int, score: long, positive_id: long>"
    found = _sweep(tiles, _blocks(anchors.withColumn("goals", F.lit(None).cast(f"array<{goal}>")), count), groups, count, shape, n_positives, True, low, high)
    positives = cut(_first(found, ["row"], n_positives).select("row", (F.col("rank") - 1).alias("goal"), "score", F.col("other_id").alias("positive_id")))
    goals = positives.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("goal", "score", "positive_id"))).alias("goals"))
    below = _sweep(tiles, _blocks(anchors.join(goals, "row"), count), groups, count, shape, n_negatives, False, low, high)
    return _first(below, ["row", "goal"], n_negatives).join(positives.withColumnRenamed("score", "positive_score"), ["row", "goal"]).select(
        "anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


ORACLE_SQL = """
WITH r AS (
  SELECT row_number() OVER () AS rn, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.rn AS ar, a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM r a JOIN r b ON a.rn <> b.rn WHERE a.vec_id % 50 = 0),
p AS (
  SELECT ar, anchor_id, other_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY ar ORDER BY score DESC, other_id) AS place
  FROM s WHERE same QUALIFY place <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.ar, p.place ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
  s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.ar = p.ar AND NOT s.same AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""
