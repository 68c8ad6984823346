"""Language identification of code-switched text by a linear-chain conditional random field.

Every word of a text gets a language by forward-backward: emission scores are sums of learned
weights of hashed features (prefixes, suffixes, character n-grams, lexicon membership), transitions
between the languages of neighbouring words are learned too. The text's language is the one with
the largest share of posterior mass over its words, and that share is the score.

The weights are fitted on a bounded sample of labelled rows (``per_language`` texts for each
language, chosen by a hash of the id, whole). Training sequences splice stretches of texts in
different languages, so that the transitions are learned from switches.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaspark.llm.common import cut, held_out, join_checked, unit_hash

BITS = 17
PER_LANGUAGE = 120
STRETCH = 40
LEXICON = 2_000
UNDETERMINED = "und"


def words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words (lower-cased runs of letters), the word code at each position, and offsets."""
    plain = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"[^\pL]+", " ")
    lists = pc.split_pattern(pc.utf8_trim(plain, " "), " ")
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    values = lists.flatten()
    if not len(values):
        return [], np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    coded = pc.dictionary_encode(values)
    vocabulary, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
    if "" in vocabulary:  # a text without letters splits to one empty word
        empty = codes == vocabulary.index("")
        owner = np.repeat(np.arange(len(lengths)), lengths)
        lengths = lengths - np.bincount(owner[empty], minlength=len(lengths))
        codes = codes[~empty]
    return vocabulary, codes, np.concatenate([[0], np.cumsum(lengths)])


def features(word: str, lexicon: dict[str, int], size: int) -> list[int]:
    """Hashed features of one word; the first cells are the lexicons' own."""
    crc = zlib.crc32
    edge = f"^{word}$"
    raw = edge.encode("utf-8", "surrogatepass")
    found = {crc(raw[k : k + 2]) for k in range(len(raw) - 1)} | {crc(raw[k : k + 3]) for k in range(len(raw) - 2)} | {crc(raw[k : k + 4], 1) for k in range(len(raw) - 3)}
    found |= {crc(word[:k].encode("utf-8", "surrogatepass"), 2) for k in (1, 2, 3)} | {crc(word[-k:].encode("utf-8", "surrogatepass"), 3) for k in (1, 2, 3, 4)}
    out = [256 + f % (size - 256) for f in found]
    mask = lexicon.get(word)
    if mask:
        # The first 256 languages have cells of their own, further ones share those of the hashed features.
        out += [k if k < 256 else 256 + crc(b"%d" % k, 5) % (size - 256) for k in range(mask.bit_length()) if mask >> k & 1]
        out.append(256 + crc(raw, 4) % (size - 256))
    return out


def marginals(scores: np.ndarray, offsets: np.ndarray, transitions: np.ndarray, pairs: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Posterior of every position's label by forward-backward, over all sequences at once.

    With ``pairs`` the expected number of each transition is returned too.
    """
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    starts, lengths = offsets[:-1][order], lengths[order]
    n_labels = scores.shape[1]
    if not len(starts):
        return np.zeros_like(scores), np.zeros((n_labels, n_labels)) if pairs else None
    e = np.exp(scores - scores.max(1, keepdims=True))
    a = np.exp(transitions - transitions.max()).astype(e.dtype)
    alpha = np.empty_like(e)
    active = np.searchsorted(-lengths, -np.arange(lengths[0] + 1), side="left")  # sequences longer than t
    now = e[starts]
    now /= now.sum(1, keepdims=True)
    alpha[starts] = now
    for t in range(1, lengths[0]):
        k = active[t]
        at = starts[:k] + t
        now = (now[:k] @ a) * e[at]
        now /= now.sum(1, keepdims=True)
        alpha[at] = now
    beta = np.ones((len(starts), n_labels), e.dtype)
    expected = np.zeros((n_labels, n_labels)) if pairs else None
    back = a.T.copy()
    for t in range(lengths[0] - 2, -1, -1):
        k = active[t + 1]
        ahead = beta[:k] * e[starts[:k] + t + 1]
        at = starts[:k] + t
        if pairs:
            joint = alpha[at][:, :, None] * a * ahead[:, None, :]
            expected += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
        now = ahead @ back
        now /= now.sum(1, keepdims=True)
        beta[:k] = now
        alpha[at] *= now
    alpha /= alpha.sum(1, keepdims=True)
    return alpha, expected


@dataclass
class Crf:
    """Learned labels, feature weights, transitions and lexicons; bounded by its parameters."""

    labels: list[str]
    weights: np.ndarray
    transitions: np.ndarray
    lexicon: dict[str, int]

    def emissions(self, vocabulary: list[str]) -> np.ndarray:
        out = np.zeros((len(vocabulary), len(self.labels)), np.float32)
        for k in range(0, len(vocabulary), 20_000):
            cells, offsets = _cells(vocabulary[k : k + 20_000], self.lexicon, len(self.weights))
            out[k : k + 20_000] = np.add.reduceat(self.weights[cells], offsets[:-1], axis=0)
        return out

    def predict(self, texts: pa.Array, cache: dict[str, int], table: list[np.ndarray]) -> tuple[list[str], list[float]]:
        """Language and score of each text. ``cache`` and ``table`` keep emissions between calls."""
        vocabulary, codes, offsets = words(texts)
        if len(cache) > 400_000:
            cache.clear()
            table.clear()
        new = [w for w in vocabulary if w not in cache]
        if new:
            base = len(cache)
            cache.update((w, base + i) for i, w in enumerate(new))
            table[:] = [np.concatenate([*table, self.emissions(new)])]
        if not len(codes):
            return [UNDETERMINED] * len(texts), [0.0] * len(texts)
        own = table[0][np.fromiter((cache[w] for w in vocabulary), np.int64, len(vocabulary))]
        posterior, _ = marginals(own[codes], offsets, self.transitions)
        n = np.diff(offsets)
        mass = np.zeros((len(texts), len(self.labels)))
        some = np.flatnonzero(n > 0)
        mass[some] = np.add.reduceat(posterior.astype(np.float64), offsets[:-1][some], axis=0)
        best = mass.argmax(1)
        share = mass[np.arange(len(texts)), best] / np.maximum(n, 1)
        return [self.labels[b] if k else UNDETERMINED for b, k in zip(best, n, strict=True)], [float(min(1.0, s)) if k else 0.0 for s, k in zip(share, n, strict=True)]


def _cells(vocabulary: list[str], lexicon: dict[str, int], size: int) -> tuple[np.ndarray, np.ndarray]:
    each = [features(w, lexicon, size) for w in vocabulary]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in each])]).astype(np.int64)
    return np.fromiter((c for x in each for c in x), np.int64, int(offsets[-1])), offsets


def train(rows: list[tuple[str, str]], bits: int = BITS, rounds: int = 25, rate: float = 0.5) -> Crf:
    """Fit on (text, language) rows by Adagrad on the exact conditional likelihood."""
    rows = sorted(rows, key=lambda r: (zlib.crc32(r[0].encode("utf-8", "surrogatepass")), r[1], r[0]))
    labels = sorted({r[1] for r in rows})
    number = {x: k for k, x in enumerate(labels)}
    vocabulary, codes, offsets = words(pa.array([r[0] for r in rows], pa.string()))
    counts: list[Counter] = [Counter() for _ in labels]
    stretches = []
    for i, (_, lang) in enumerate(rows):
        own = codes[offsets[i] : offsets[i + 1]]
        counts[number[lang]].update(own.tolist())
        stretches += [(number[lang], own[k : k + STRETCH]) for k in range(0, len(own), STRETCH)]
    lexicon: dict[str, int] = {}
    for k, c in enumerate(counts):
        for code, seen in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:LEXICON]:
            if seen > 1:
                lexicon[vocabulary[code]] = lexicon.get(vocabulary[code], 0) | 1 << k
    np.random.RandomState(5).shuffle(order := np.arange(len(stretches)))
    spliced = [stretches[k] for k in order]
    sizes = [sum(len(x[1]) for x in spliced[k : k + 6]) for k in range(0, len(spliced), 6)]
    chain = np.concatenate([x[1] for x in spliced]) if spliced else np.zeros(0, np.int64)
    gold = np.concatenate([np.full(len(x[1]), x[0]) for x in spliced]) if spliced else np.zeros(0, np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    size, n_labels = 1 << bits, len(labels)
    weights, transitions = np.zeros((size, n_labels), np.float32), np.zeros((n_labels, n_labels))
    model = Crf(labels, weights, transitions, lexicon)
    if not len(chain):
        return model
    cells, at = _cells(vocabulary, lexicon, size)
    sums_w, sums_t = np.full((size, n_labels), 1e-6, np.float32), np.full((n_labels, n_labels), 1e-6)
    inside = np.ones(len(chain), bool)
    inside[ends[:-1]] = False
    where = np.flatnonzero(inside)
    seen_t = np.zeros((n_labels, n_labels))
    np.add.at(seen_t, (gold[where - 1], gold[where]), 1)
    for _ in range(rounds):
        scores = np.add.reduceat(weights[cells], at[:-1], axis=0)
        posterior, expected = marginals(scores[chain], ends, transitions, pairs=True)
        posterior[np.arange(len(chain)), gold] -= 1
        per_word = np.stack([np.bincount(chain, posterior[:, k], len(vocabulary)) for k in range(n_labels)], 1)
        spread = np.repeat(per_word, np.diff(at), axis=0)
        grad = np.stack([np.bincount(cells, spread[:, k], size) for k in range(n_labels)], 1) / len(chain)
        sums_w += (grad * grad).astype(np.float32)
        weights -= (rate * grad / np.sqrt(sums_w)).astype(np.float32)
        grad_t = (expected - seen_t) / len(chain)
        sums_t += grad_t * grad_t
        transitions -= rate * grad_t / np.sqrt(sums_t)
    return model


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, max_rows: int = 24_000, bits: int = BITS) -> Crf:
    """Fit on about ``per_language`` rows of every language, and on about ``max_rows`` altogether.

    Where there are so many languages that ``max_rows`` isn't enough, each has an equal share of them, and at
    least one row, so that every learned value of ``lang`` can be predicted. Only rows that are not held out and
    have a language are read; null and empty texts among them teach nothing. Without any
    labelled row the model has no labels.
    """
    rows = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    rows = rows.withColumn("_h", unit_hash(F.col("doc_id"), F.lit(9)))
    counts = cut(rows.groupBy("lang").agg(F.count("*").alias("_n"), F.min("_h").alias("_least")))
    languages = counts.count()
    if not languages:
        return Crf([], np.zeros((1 << 9, 0), np.float32), np.zeros((0, 0)), {})
    each = max(1, min(per_language, max_rows // languages))
    dealt = join_checked(rows, counts, ["lang"])
    sample = dealt.where((F.col("_h") < F.lit(each) / F.col("_n")) | (F.col("_h") == F.col("_least"))).select("text", "lang").collect()
    return train([(r["text"] or "", r["lang"]) for r in sample], bits)


def identify(docs: DataFrame, model: Crf, max_chars: int = 6_000_000) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every whole text.

    ``und`` with score 0 stands for null texts, texts without letters, and for all texts if the
    model has no labels. Repeated rows repeat; other columns are ignored; an empty table gives an
    empty result. ``max_chars`` bounds how much text is worked on at once, not how much is read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, int] = {}
        table: list[np.ndarray] = []
        for b in batches:
            texts = b.column("text")
            sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
            start = 0
            while start < b.num_rows:
                base = sizes[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(sizes, base + max_chars, side="right")))
                part = b.slice(start, stop - start)
                start = stop
                if sent.value.labels:
                    lang, score = sent.value.predict(part.column("text"), cache, table)
                else:
                    lang, score = [UNDETERMINED] * part.num_rows, [0.0] * part.num_rows
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(lang), pa.array(score, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out(F.col("doc_id")).alias("held_out"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
