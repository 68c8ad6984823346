"""Text quality by a convolutional network over bytes.

A document's UTF-8 bytes are cut into overlapping chunks that cover the whole text. Bytes have learned
embeddings, filters of several bytes' width slide over each chunk, and a chunk's response to a filter
is the largest over its places. A document's features are the mean and the maximum of its chunks'
responses; a logistic head turns them into one probability. Everything is numpy: embedding times filter
is one table per place of a filter, so a convolution is a sum of table rows.

The network is fitted by Adam on a bounded sample of labelled rows, of each of which a few chunks
reach the driver, drawn by a hash from its whole text. Scoring is a map over batches: nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaspark.llm.common import join_checked, slices, unit_hash

CHUNK, OVERLAP = 512, 32
STEP = CHUNK - OVERLAP
WIDTH, EMBED, FILTERS = 8, 8, 24
#: Chunks convolved at once, so that their responses stay in a core's cache.
AT_ONCE = 32


def chunk_starts(length: int) -> np.ndarray:
    """Where the chunks of a text of so many bytes start; the last one reaches its end. An empty text has one chunk."""
    return np.arange(max(1, -(-(length - OVERLAP) // STEP))) * STEP


def cut_chunks(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Chunks (n, CHUNK) of ``raw`` from ``starts``; what lies beyond the text's end is 0."""
    at = starts[:, None] + np.arange(CHUNK)
    inside = at < ends[:, None]
    return np.where(inside, raw[np.minimum(at, max(0, len(raw) - 1))] if len(raw) else 0, 0).astype(np.uint8)


@dataclass
class Network:
    """Embeddings (256, EMBED), filters (WIDTH, EMBED, FILTERS), their bias, head (2 * FILTERS) and intercept."""

    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    head: np.ndarray
    intercept: np.ndarray

    @staticmethod
    def fresh(seed: int = 17) -> Network:
        draw = np.random.default_rng(seed)
        return Network(*(a.astype(np.float32) for a in (
            draw.normal(0, 0.5, (256, EMBED)), draw.normal(0, (WIDTH * EMBED) ** -0.5, (WIDTH, EMBED, FILTERS)), np.zeros(FILTERS), draw.normal(0, 0.1, 2 * FILTERS), np.zeros(1),
        )))

    def parts(self) -> tuple[np.ndarray, ...]:
        return self.embed, self.filters, self.bias, self.head, self.intercept

    def tables(self) -> np.ndarray:
        """Response of every filter at each of its places to every byte: (WIDTH, 256, FILTERS)."""
        return np.ascontiguousarray(self.embed @ self.filters, np.float32)

    @staticmethod
    def convolve(tables: np.ndarray, chunks: np.ndarray) -> np.ndarray:
        """Sums of table rows at each place: (n, places, FILTERS)."""
        places = chunks.shape[1] - WIDTH + 1
        out = np.take(tables[0], chunks[:, :places], axis=0)
        for k in range(1, WIDTH):
            out += np.take(tables[k], chunks[:, k : k + places], axis=0)
        return out

    def responses(self, chunks: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """Each chunk's largest response to each filter, cut off at 0: (n, FILTERS)."""
        most = [self.convolve(tables, chunks[k : k + AT_ONCE]).max(1) for k in range(0, len(chunks), AT_ONCE)]
        return np.maximum(np.concatenate(most) + self.bias, 0)

    def score(self, texts: pa.Array) -> np.ndarray:
        """Probability of label 1 of every whole text; null counts as empty."""
        raw_texts = texts.cast(pa.large_binary())
        offsets = np.frombuffer(raw_texts.buffers()[1], np.int64)[raw_texts.offset : raw_texts.offset + len(texts) + 1]
        raw = np.frombuffer(raw_texts.buffers()[2] or b"", np.uint8)
        tables = self.tables()
        total, most, count = np.zeros((len(texts), FILTERS)), np.zeros((len(texts), FILTERS), np.float32), np.zeros(len(texts))
        starts = [chunk_starts(int(n)) for n in np.diff(offsets)]
        count[:] = [len(s) for s in starts]
        owner = np.repeat(np.arange(len(texts)), count.astype(np.int64))
        places = (np.concatenate(starts) if len(starts) else np.zeros(0, np.int64)) + offsets[:-1][owner]
        for k in range(0, len(owner), 16 * AT_ONCE):
            of = owner[k : k + 16 * AT_ONCE]
            said = self.responses(cut_chunks(raw, places[k : k + 16 * AT_ONCE], offsets[1:][of]), tables)
            first = np.flatnonzero(np.diff(of, prepend=-1))
            total[of[first]] += np.add.reduceat(said.astype(np.float64), first)
            most[of[first]] = np.maximum(most[of[first]], np.maximum.reduceat(said, first))
        x = np.concatenate([total / np.maximum(count, 1)[:, None], most], 1)
        return 1 / (1 + np.exp(-np.clip(x @ self.head.astype(np.float64) + float(self.intercept[0]), -30, 30)))

    def gradients(self, chunks: np.ndarray, doc: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, tuple[np.ndarray, ...]]:
        """Weighted mean loss of documents and its derivative by each part. ``doc``: the (ascending) document of each chunk."""
        n = len(y)
        tables = self.tables()
        out = self.convolve(tables, chunks)
        at = out.argmax(1)
        peak = np.take_along_axis(out, at[:, None], 1)[:, 0] + self.bias
        said = np.maximum(peak, 0)
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        size = np.diff(np.append(first, len(doc)))
        mean, most = np.add.reduceat(said, first) / size[:, None], np.maximum.reduceat(said, first)
        x = np.concatenate([mean, most], 1)
        logit = x @ self.head + self.intercept
        w = weight / weight.sum()
        loss = float((w * (np.logaddexp(0, logit) - y * logit)).sum())
        d = w * (1 / (1 + np.exp(-logit)) - y)
        to_mean, to_most = np.split(d[:, None] * self.head, 2, 1)
        winner = said == most[doc]
        winner &= np.cumsum(winner, 0) - np.concatenate([np.zeros((1, FILTERS), int), np.cumsum(winner, 0)])[first][doc] == 1  # one chunk of a tie
        back = ((to_mean / size[:, None])[doc] + winner * to_most[doc]) * (peak > 0)
        by_table = np.zeros((WIDTH, 256, FILTERS))
        f = np.broadcast_to(np.arange(FILTERS), at.shape)
        for k in range(WIDTH):
            byte = chunks[np.arange(len(chunks))[:, None], at + k]
            by_table[k] = np.bincount((byte.astype(np.int64) * FILTERS + f).ravel(), back.ravel(), 256 * FILTERS).reshape(256, FILTERS)
        by_filters = np.einsum("be,kbf->kef", self.embed, by_table)
        by_embed = np.einsum("kbf,kef->be", by_table, self.filters)
        assert n == len(first)
        return loss, (by_embed, by_filters, back.sum(0), x.T @ d, np.array([d.sum()]))


def train(chunks: list[np.ndarray], y: np.ndarray, steps: int = 1000, batch: int = 48, rate: float = 0.02, seed: int = 17) -> Network:
    """Adam over documents in shuffled order, each class with half of a batch; ``chunks`` has each document's chunks."""
    net, draw = Network.fresh(seed), np.random.default_rng(seed)
    parts = net.parts()
    first, second = ([np.zeros_like(p, np.float64) for p in parts] for _ in range(2))
    kinds = [np.flatnonzero(y == c) for c in (0, 1)]
    for step in range(1, steps + 1):
        picked = np.concatenate([draw.choice(k, min(len(k), batch // 2), replace=False) for k in kinds])
        doc = np.repeat(np.arange(len(picked)), [len(chunks[i]) for i in picked])
        _, slopes = net.gradients(np.concatenate([chunks[i] for i in picked]), doc, y[picked].astype(float), np.ones(len(picked)))
        now = rate * min(1, 3 * (1 - step / (steps + 1)))
        for p, g, m, v in zip(parts, slopes, first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= (now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def held_out(doc_id: Column) -> Column:
    """True for rows that no label may be learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 6_000, sample_chunks: int = 6, **options) -> Network:
    """Network fitted on at most about ``sample_rows`` labelled rows that are not held out, half of each class if there are enough.

    A sampled row gives ``sample_chunks`` chunks of its whole text, drawn by a hash, so the driver gets at most
    about sample_rows * sample_chunks * 512 bytes. Null ids, null labels and unlabelled rows are skipped; of
    several labels of a document the smallest counts, of several texts one. Both classes weigh alike in the fit, however many labels they
    have. With labels of one class only, or none, every score is that class's, or 0.5.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("_y")).where("_id IS NOT NULL AND _y IS NOT NULL")
    known = known.where(~held_out(F.col("_id"))).groupBy("_id").agg((F.min("_y") > 0).cast("int").alias("_y"))
    numbers = {r["_y"]: r["n"] for r in known.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    share = {c: min(1.0, max(sample_rows / 2, sample_rows - numbers.get(1 - c, 0)) / max(1, numbers.get(c, 0))) for c in (0, 1)}
    drawn = known.where(unit_hash(F.col("_id"), F.lit(13)) < F.when(F.col("_y") > 0, share[1]).otherwise(share[0]))
    rows = join_checked(docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("_text")), drawn, ["_id"], "inner", 4 * sample_rows)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            out = []
            for i, text in zip(b.column("_id").to_pylist(), b.column("_text").to_pylist(), strict=True):
                raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
                starts = chunk_starts(len(raw))
                if len(starts) > sample_chunks:
                    starts = np.sort(np.random.default_rng(i & 0xFFFFFFFF).choice(starts, sample_chunks, replace=False))
                out.append(cut_chunks(raw, starts, np.full(len(starts), len(raw))).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("_y"), pa.array(out, pa.binary())], ["_id", "_y", "_chunks"])

    got = rows.select("_id", "_y", "_text").mapInArrow(pick, "_id long, _y int, _chunks binary").groupBy("_id").agg(F.first("_y").alias("_y"), F.min("_chunks").alias("_chunks")).toPandas().sort_values("_id")
    y = got["_y"].to_numpy()
    chunks = [np.frombuffer(c, np.uint8).reshape(-1, CHUNK) for c in got["_chunks"]]
    if 0 < y.sum() < len(y):
        return train(chunks, y, **options)
    net = Network.fresh()
    net.head[:], net.intercept[:] = 0, 0.0 if not len(y) else 4.0 if y[0] else -4.0
    return net


def score(docs: DataFrame, net: Network, threshold: float = 0.3) -> DataFrame:
    """Score every whole text: doc_id, held_out, score, predicted.

    Null and empty texts are one chunk of zeros. Repeated rows are scored alike, one output row each; columns
    of ``docs`` other than doc_id and text are ignored. An empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            s = sent.value.score(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), held_out(F.col("doc_id")).alias("held_out"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
