"""Toxicity by class-conditional Kneser-Ney models of expressions and of characters.

Expressions are the words of the texts, in any alphabet (scripts written without
spaces count by the character), and on demand word pairs. A word's probability in a class is the discounted number of the class's texts
it stands in, interpolated with a back-off that both classes share: the discounted number of all texts it
stands in, its continuation count, interpolated with the class's model of characters. So an
expression seen in one text only says no more than its spelling and needs no look-up. Pairs are discounted alike and say
nothing below two texts. The counts are grouped over all labelled rows into a table that grows with the corpus;
while it is small it is broadcast, a larger one is joined by shuffle.

Characters are those within a word, folded to 29 symbols, at order 4, by interpolated Kneser-Ney with shared
continuation counts; these are at most 29**4 cells.

A text's evidence is the difference of the two log-likelihoods by its length: the mean over its words, and,
as a few expressions drown in the mean of a long text, its strongest words, its strongest stretch and what exceeds
the noise of a word. A logistic curve turns these numbers into a score; it is fitted on
labelled rows whose own counts are taken out of the models (leave-one-out), so every labelled row
is counted and can serve the curve as well.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaspark.llm.common import attach, cut, fits, held_out, join_checked, slices, unit_hash

#: Symbols: 0 separator, 1-26 letters, 27 digit, 28 any other letter.
SYMBOLS = 29
ORDER = 4
DISCOUNT = 0.75
PULL = 0.1


def _fold_table() -> np.ndarray:
    table = np.zeros(0x10000, np.uint8)
    for cp in range(0x10000):
        ch = chr(cp).lower()
        base = (unicodedata.normalize("NFKD", ch) or ch)[0]
        if "a" <= base <= "z":
            table[cp] = ord(base) - 96
        elif base.isdigit():
            table[cp] = 27
        elif base.isalpha():
            table[cp] = 28
    return table


_TABLE: list[np.ndarray] = []


def word_codes(words: list[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the n-grams of each word, one for each folded character and one for the end, and the word of each code.

    A word's first characters have only separators before them. Characters that are no letters or digits are passed
    over; words of nothing else have no codes.
    """
    if not _TABLE:
        _TABLE.append(_fold_table())
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    symbols = np.where(points > 0xFFFF, SYMBOLS - 1, _TABLE[0][np.minimum(points, 0xFFFF)])
    owner = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))[symbols > 0]
    symbols = symbols[symbols > 0]
    size = np.bincount(owner, minlength=len(words))
    base = np.cumsum(size + order) - (size + order)
    padded = np.zeros(int((size + order).sum()) + order, np.int64)
    first = np.cumsum(size) - size
    padded[base[owner] + order - 1 + np.arange(len(owner)) - first[owner]] = symbols
    of = np.repeat(np.arange(len(words)), np.where(size > 0, size + 1, 0))
    start = np.arange(len(of)) - np.repeat(np.cumsum(np.where(size > 0, size + 1, 0)) - np.where(size > 0, size + 1, 0), np.where(size > 0, size + 1, 0)) + base[of]
    codes = np.zeros(len(of), np.int64)
    for k in range(order):
        codes = codes * SYMBOLS + padded[start + k]
    return codes, of


def grams(text: str | None, order: int = ORDER) -> np.ndarray:
    """Codes of the n-grams of a text's words. Null and texts without letters or digits have none."""
    words = read_words(pa.array([text], pa.string()))
    return word_codes([words.spelled[c] for c in words.code], order)[0]


def shared_backoff(pooled: np.ndarray, order: int, discount: float = DISCOUNT) -> np.ndarray:
    """p(x | last order-2 symbols) from continuation counts of both classes together, dense."""
    levels, counts = [], pooled
    for n in range(order - 1, 0, -1):
        counts = (counts.reshape(SYMBOLS, -1) > 0).sum(0).astype(np.float64)
        levels.append(counts)
    lower = np.full(SYMBOLS, 1.0 / SYMBOLS)
    for n, counts in enumerate(reversed(levels), 1):
        table = counts.reshape(-1, SYMBOLS)
        total, types = table.sum(1, keepdims=True), (table > 0).sum(1, keepdims=True)
        below = np.tile(lower.reshape(-1, SYMBOLS), (len(table) // (len(lower) // SYMBOLS), 1)) if n > 1 else lower.reshape(1, -1)
        with np.errstate(divide="ignore", invalid="ignore"):
            p = (np.maximum(table - discount, 0) + discount * types * below) / total
        lower = np.where(total > 0, p, below).ravel()
    return lower


def class_model(counts: np.ndarray, backoff: np.ndarray, discount: float = DISCOUNT, pull: float = PULL) -> np.ndarray:
    """p(x | context) of one class: discounted counts, interpolated with the shared back-off.

    ``pull`` is the strength that the back-off has besides the discounted mass (the concentration
    of the Pitman-Yor reading of Kneser-Ney); it keeps contexts that one class hardly saw neutral.
    """
    table = counts.reshape(-1, SYMBOLS).astype(np.float64)
    total, types = table.sum(1, keepdims=True), (table > 0).sum(1, keepdims=True)
    below = np.tile(backoff.reshape(-1, SYMBOLS), (SYMBOLS, 1))
    return ((np.maximum(table - discount, 0) + (pull + discount * types) * below) / (pull + total)).ravel()


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights of a ridge logistic curve by Newton steps; the first is the intercept."""
    z = np.column_stack([np.ones(len(x)), x])
    w, pull = np.zeros(z.shape[1]), np.r_[0.0, np.full(z.shape[1] - 1, ridge)]
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) + pull * w
        hess = (z * (p * (1 - p) + 1e-6)[:, None]).T @ z + np.diag(pull + 1e-9)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class Words:
    """The words of a batch of texts in order: text and spelling of each, words of every text, and the spellings with their hashes."""

    owner: np.ndarray
    code: np.ndarray
    n: np.ndarray
    spelled: list[str]
    hashes: np.ndarray


def read_words(texts: pa.Array) -> Words:
    """Lower-cased runs of letters, marks and digits; null counts as empty."""
    plain = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"[^\pL\pM\pN]+", " ")
    plain = pc.replace_substring_regex(plain, r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])", r" \1 ")
    lists = pc.split_pattern_regex(plain, " +")
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = pc.dictionary_encode(lists.flatten())
    spelled = coded.dictionary.to_pylist()
    codes = coded.indices.to_numpy()
    full = np.fromiter((w != "" for w in spelled), bool, len(spelled))[codes]
    owner = np.repeat(np.arange(len(texts)), lengths)[full]
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in spelled), np.uint64, len(spelled))
    return Words(owner, codes[full].astype(np.int64), np.bincount(owner, minlength=len(texts)), spelled, hashes)


def _distinct(owner: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """owner, key, count and one position of the distinct (owner, key)."""
    order = np.lexsort((key, owner))
    own, k = owner[order], key[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (own[1:] != own[:-1])
    at = np.flatnonzero(new)
    return own[at], k[at], np.diff(np.append(at, len(k))), order[at]


def _pairs(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Text and key of every pair of neighbouring words."""
    h = words.hashes[words.code]
    near = words.owner[1:] == words.owner[:-1]
    both = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ (h[1:] + np.uint64(0x632BE59BD9B4E019)))[near]
    return words.owner[:-1][near], (both * np.uint64(0xD6E8FEB86659FD93) ^ (both >> np.uint64(32))).view(np.int64)


def expressions(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, key, count) of the distinct words and word pairs of each text, and the words of every text."""
    words = read_words(texts)
    owner, key = _pairs(words)
    own, k, count, _ = _distinct(np.concatenate([words.owner, owner]), np.concatenate([words.hashes[words.code].view(np.int64), key]))
    return own, k, count, words.n


@dataclass
class Sizes:
    """What a kind of expression has in both classes: sum of its counts per class, expressions seen per class, expressions in all."""

    toxic: float = 0.0
    plain: float = 0.0
    toxic_kinds: float = 0.0
    plain_kinds: float = 0.0
    kinds: float = 0.0

    def ratio(self, toxic, plain, spelled_toxic, spelled_plain, log, most):
        """log p(expression | toxic) - log p(expression | plain), by numpy or by Spark columns.

        Counts are numbers of texts, discounted by one; the mass so freed goes to the shared back-off, whose own goes to the
        spelling (a probability under each class).
        """
        every = self.toxic + self.plain
        if not self.toxic or not self.plain:
            return toxic * 0.0
        shared = most(toxic + plain - 1) / every
        p, q = (
            most(n - 1) / total + kinds / total * (shared + self.kinds / every * spelled)
            for n, total, kinds, spelled in ((toxic, self.toxic, self.toxic_kinds, spelled_toxic), (plain, self.plain, self.plain_kinds, spelled_plain))
        )
        return log(p) - log(q)


def _np_ratio(sizes: Sizes, toxic: np.ndarray, plain: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return sizes.ratio(toxic, plain, a, b, np.log, lambda x: np.maximum(x, 0))


def _column_ratio(sizes: Sizes, toxic: Column, plain: Column, a: Column, b: Column) -> Column:
    return sizes.ratio(toxic, plain, a, b, F.log, lambda x: F.greatest(x, F.lit(0)))


#: Natural logarithms that a word's ratio must exceed to count as more than noise; least log-likelihood of a spelling; words of a stretch.
MARGINS = (1.0, 2.0, 3.0)
LEAST_LOG = -600.0
STRETCH = 10
#: Sum, largest and mean of the three largest ratios of words, excess over each margin, excess of pairs.
SAID = 4 + len(MARGINS)


@dataclass
class ToxicityModel:
    """Log-likelihoods of all character n-grams per class (29**order floats each), counts of expressions and the fitted curve.

    ``keys`` (sorted), ``toxic`` and ``plain`` hold the expressions' counts, or ``keys`` is None and
    the counts are looked up by a join with a table (key, pair, toxic, plain).
    """

    logs: tuple[np.ndarray, np.ndarray]  # toxic, plain
    curve: np.ndarray
    scale: tuple[np.ndarray, np.ndarray]
    order: int = ORDER
    words: Sizes = field(default_factory=Sizes)
    pairs: Sizes = field(default_factory=Sizes)
    keys: np.ndarray | None = None
    toxic: np.ndarray | None = None
    plain: np.ndarray | None = None

    def look_up(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.keys is None or not len(self.keys):
            return np.zeros(len(key)), np.zeros(len(key))
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        there = self.keys[at] == key
        return np.where(there, self.toxic[at], 0), np.where(there, self.plain[at], 0)

    def spelling(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihood of each spelling under each class."""
        codes, of = word_codes(words.spelled, self.order)
        a, b = (np.bincount(of, table[codes], len(words.spelled)) for table in self.logs)
        return np.maximum(a, LEAST_LOG), np.maximum(b, LEAST_LOG)

    def said(self, words: Words, spelled: tuple[np.ndarray, np.ndarray], label: np.ndarray | None = None) -> np.ndarray:
        """(texts, SAID) evidence of the expressions; with ``label`` without each text's own counts. ``spelled``: per word occurrence or per spelling."""
        texts = len(words.n)
        out = np.zeros((texts, SAID))
        owner, code, count, place = _distinct(words.owner, words.code)
        at = place if len(spelled[0]) == len(words.code) and len(spelled[0]) != len(words.spelled) else code
        toxic, plain = self.look_up(words.hashes[code].view(np.int64))
        toxic, plain = _without(toxic, plain, owner, label)
        ratio = _np_ratio(self.words, toxic, plain, np.exp(spelled[0][at]), np.exp(spelled[1][at]))
        if len(ratio):
            by = np.lexsort((-ratio, owner))
            first = np.flatnonzero(np.diff(owner[by], prepend=-1))
            size = np.diff(np.append(first, len(by)))
            there, high = owner[by][first], ratio[by]
            out[there, 0] = np.bincount(owner, ratio * count, texts)[there]
            out[there, 1] = high[first]
            out[there, 2] = sum(np.where(size > k, high[np.minimum(first + k, len(high) - 1)], 0) for k in range(3)) / np.minimum(size, 3)
            for k, margin in enumerate(MARGINS):
                out[:, 3 + k] = np.bincount(owner, count * np.maximum(ratio - margin, 0), texts)
        if self.pairs.kinds:
            owner, key, count, _ = _distinct(*_pairs(words))
            toxic, plain = _without(*self.look_up(key), owner, label)
            known = toxic + plain >= 2
            none = np.zeros(np.count_nonzero(known))
            ratio = _np_ratio(self.pairs, toxic[known], plain[known], none, none)
            out[:, -1] = np.bincount(owner[known], count[known] * np.maximum(ratio - MARGINS[1], 0), texts)
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.scale[0]) / self.scale[1]
        return 1 / (1 + np.exp(-np.clip(self.curve[0] + z @ self.curve[1:], -30, 30)))


def _without(toxic: np.ndarray, plain: np.ndarray, owner: np.ndarray, label: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    if label is None:
        return toxic, plain
    mine = label[owner] > 0
    return np.maximum(toxic - mine, 0), np.maximum(plain - ~mine, 0)


def features(words: Words, spelled: tuple[np.ndarray, np.ndarray], said: np.ndarray) -> np.ndarray:
    """What the curve sees of each text, by its length; zeros for a text without words. ``spelled`` per occurrence of a word."""
    texts, n = len(words.n), np.maximum(words.n, 1)
    root = np.sqrt(n)
    ratio = spelled[0] - spelled[1]
    sums = np.append(0.0, np.cumsum(ratio))
    stretch = np.bincount(words.owner, ratio, texts) / n
    mean = stretch.copy()
    top, top3 = np.zeros(texts), np.zeros(texts)
    if len(ratio):
        k = np.flatnonzero(words.owner[STRETCH - 1 :] == words.owner[: len(ratio) - STRETCH + 1]) if len(ratio) >= STRETCH else np.zeros(0, np.int64)
        long = words.n >= STRETCH
        stretch[long] = -np.inf
        np.maximum.at(stretch, words.owner[k], (sums[k + STRETCH] - sums[k]) / STRETCH)
        owner, _, _, place = _distinct(words.owner, words.code)
        by = np.lexsort((-ratio[place], owner))
        first = np.flatnonzero(np.diff(owner[by], prepend=-1))
        size, there, high = np.diff(np.append(first, len(by))), owner[by][first], ratio[place][by]
        top[there] = high[first]
        top3[there] = sum(np.where(size > j, high[np.minimum(first + j, len(high) - 1)], 0) for j in range(3)) / np.minimum(size, 3)
    over = np.bincount(words.owner, np.maximum(ratio - MARGINS[1], 0), texts)
    return np.column_stack([said[:, 0] / n, said[:, 1:3], said[:, 3:] / root[:, None], mean, top, top3, stretch, over / root, np.log(n)])


def _labelled(docs: DataFrame, labels: DataFrame, max_label_rows: int) -> DataFrame:
    labels = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("_y"))
    rows = docs.select("doc_id", "text").where(~held_out(F.col("doc_id")))
    return join_checked(rows, labels, ["doc_id"], "inner", max_label_rows)


def count_expressions(rows: DataFrame, pairs: bool = False, flush: int = 400_000) -> DataFrame:
    """key, pair, toxic, plain: in how many toxic and other ``rows`` (text, _y) each word stands, and with ``pairs`` each pair of two rows at least."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def summed(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            key, first, at = np.unique(np.concatenate([p[0] for p in parts]), return_index=True, return_inverse=True)
            pair, toxic = np.concatenate([p[1] for p in parts])[first], np.concatenate([p[2] for p in parts])
            sums = [np.bincount(at, x, len(key)).astype(np.int64) for x in (toxic, ~toxic)]
            return pa.RecordBatch.from_arrays([pa.array(key), pa.array(pair), pa.array(sums[0]), pa.array(sums[1])], ["key", "pair", "toxic", "plain"])

        held, n = [], 0
        for b in slices(batches):
            words = read_words(b.column("text"))
            y = b.column("_y").to_numpy(zero_copy_only=False) > 0
            owner, code, _, _ = _distinct(words.owner, words.code)
            kinds = [(False, owner, words.hashes[code].view(np.int64))]
            if pairs:
                kinds.append((True, *_distinct(*_pairs(words))[:2]))
            for pair, owner, key in kinds:
                held.append((key, np.full(len(key), pair), y[owner]))
                n += len(key)
            if n > flush:
                yield summed(held)
                held, n = [], 0
        if held:
            yield summed(held)

    counted = rows.select("text", "_y").mapInArrow(count, "key long, pair boolean, toxic long, plain long")
    counted = counted.groupBy("key").agg(F.first("pair").alias("pair"), F.sum("toxic").alias("toxic"), F.sum("plain").alias("plain"))
    return counted.where(~F.col("pair") | (F.col("toxic") + F.col("plain") >= 2))


def joined_evidence(rows: DataFrame, table: DataFrame, model: ToxicityModel) -> DataFrame:
    """_k, _said: the expressions' evidence of all ``rows`` (_k, text, perhaps _y), by a shuffled lookup.

    Equal (_k, key) are looked up once. With ``_y``, which ``_k`` then includes, the text's own counts are taken out.
    Words that stand in many texts are salted.
    """
    label = "_y" in rows.columns
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 100):
            words = read_words(b.column("text"))
            a, c = sent.value.spelling(words)
            owner, code, count, _ = _distinct(words.owner, words.code)
            owner2, key2, count2, _ = _distinct(*_pairs(words)) if sent.value.pairs.kinds else (np.zeros(0, np.int64),) * 4
            both = np.concatenate([owner, owner2])
            y = b.column("_y").cast(pa.int64()).to_numpy(zero_copy_only=False)[both] if label else np.zeros(len(both), np.int64)
            none = np.zeros(len(owner2))
            cols = [np.concatenate(x) for x in ((words.hashes[code].view(np.int64), key2), (np.zeros(len(owner), bool), np.ones(len(owner2), bool)), (count, count2), (np.exp(a[code]), none), (np.exp(c[code]), none))]
            yield pa.RecordBatch.from_arrays([b.column("_k").take(pa.array(both)), *map(pa.array, cols), pa.array(y)], ["_k", "key", "two", "count", "a", "b", "y"])

    # Two texts with one hash and length count as one.
    each = rows.mapInArrow(explode, "_k string, key long, two boolean, count long, a double, b double, y long").dropDuplicates(["_k", "key", "two"])
    met = attach(each, table.drop("pair").withColumn("_n", F.col("toxic") + F.col("plain")), "key", F.xxhash64("_k"), "_n", how="left")
    own = F.lit(int(label))
    toxic = F.greatest(F.coalesce("toxic", F.lit(0)) - own * (F.col("y") > 0).cast("int"), F.lit(0))
    plain = F.greatest(F.coalesce("plain", F.lit(0)) - own * (F.col("y") <= 0).cast("int"), F.lit(0))
    met = met.withColumns({"toxic": toxic, "plain": plain}).where(~F.col("two") | (F.col("toxic") + F.col("plain") >= 2))
    one, two = _column_ratio(model.words, F.col("toxic"), F.col("plain"), F.col("a"), F.col("b")), _column_ratio(model.pairs, F.col("toxic"), F.col("plain"), F.col("a"), F.col("b"))
    met = met.withColumn("ratio", F.when(F.col("two"), two).otherwise(one))
    over = lambda x: F.col("count") * F.greatest(F.col("ratio") - x, F.lit(0.0))
    word = ~F.col("two")
    high = F.slice(F.sort_array(F.collect_list(F.when(word, F.col("ratio"))), asc=False), 1, 3)
    sums = [F.sum(F.when(word, F.col("count") * F.col("ratio"))), F.max(F.when(word, F.col("ratio"))), F.aggregate(high, F.lit(0.0), lambda s, x: s + x) / F.size(high)]
    sums += [F.sum(F.when(word, over(m))) for m in MARGINS] + [F.sum(F.when(F.col("two"), over(MARGINS[1])))]
    return met.groupBy("_k").agg(F.array(*[F.coalesce(x.cast("double"), F.lit(0.0)) for x in sums]).alias("_said"))


def with_said(rows: DataFrame, table: DataFrame, model: ToxicityModel) -> DataFrame:
    """``rows`` (with text, perhaps _y) and ``_said``, the evidence of expressions; null where a broadcast model gives it, or no word is there."""
    if model.keys is not None:
        return rows.withColumn("_said", F.lit(None).cast("array<double>"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    label = ["_y"] if "_y" in rows.columns else []
    keyed = rows.withColumn("_k", F.concat_ws(":", F.xxhash64(text), F.xxhash64(F.lit(1), text), F.octet_length(text), *label))
    own = joined_evidence(keyed.select("_k", "text", *label), table, model)
    return keyed.join(own, "_k", "left").drop("_k")


def _measured(model: ToxicityModel, b: pa.RecordBatch, label: np.ndarray | None = None, counts: CharacterCounts | None = None) -> np.ndarray:
    """Features of a batch's texts; with ``label`` and ``counts`` without their own counts."""
    words = read_words(b.column("text"))
    if counts is None:
        per = model.spelling(words)
        spelled = tuple(x[words.code] for x in per)
    else:
        spelled = counts.without_own(words, label)
    said = model.said(words, spelled, label) if model.keys is not None else np.array([x or [0.0] * SAID for x in b.column("_said").to_pylist()]).reshape(-1, SAID)
    return features(words, spelled, said)


@dataclass
class CharacterCounts:
    """Counts of character n-grams per class with the shared back-off; gives texts' log-likelihoods without their own counts."""

    counts: tuple[np.ndarray, np.ndarray]  # toxic, plain
    backoff: np.ndarray
    order: int = ORDER

    def __post_init__(self) -> None:
        self.totals = [(c.reshape(-1, SYMBOLS).sum(1), (c.reshape(-1, SYMBOLS) > 0).sum(1)) for c in self.counts]

    def without_own(self, words: Words, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihood of every occurrence of a word under each class, the own text's counts taken out of its class."""
        out = [np.zeros(len(words.code)), np.zeros(len(words.code))]
        codes, of = word_codes(words.spelled, self.order)
        begin = np.searchsorted(of, np.arange(len(words.spelled)))
        size = np.bincount(of, minlength=len(words.spelled))
        ends = np.cumsum(words.n)
        for i, bad in enumerate(label):
            part = slice(ends[i] - words.n[i], ends[i])
            kinds, again, times = np.unique(words.code[part], return_inverse=True, return_counts=True)
            many = size[kinds]
            mine = codes[np.repeat(begin[kinds] - (np.cumsum(many) - many), many) + np.arange(many.sum())]
            at, n = np.unique(mine, return_inverse=True)
            own = np.bincount(n, np.repeat(times, many), len(at))
            context = at // SYMBOLS
            which, where = np.unique(context, return_inverse=True)
            low = self.backoff[at % len(self.backoff)]
            for c in (0, 1):
                had, (total, types) = self.counts[c][at], (x[context] for x in self.totals[c])
                if bool(bad) == (c == 0):
                    had = had - own
                    total = total - np.bincount(where, own, len(which))[where]
                    types = np.maximum(types - np.bincount(where, had <= 0, len(which))[where], 0)
                logs = np.log((np.maximum(had - DISCOUNT, 0) + (PULL + DISCOUNT * types) * low) / (PULL + total))
                per = np.bincount(np.repeat(np.arange(len(kinds)), many), logs[n], len(kinds))
                out[c][part] = np.maximum(per, LEAST_LOG)[again]
        return out[0], out[1]


@dataclass
class _Fitted:
    """A model with the table of its expressions."""

    model: ToxicityModel
    table: DataFrame
    telling: DataFrame | None = None  # the rows that say more than the spelling


def fit(docs: DataFrame, labels: DataFrame, order: int = ORDER, calibration_rows: int = 20_000, max_label_rows: int = 5_000_000, max_expressions: int = 2_000_000, pairs: bool = False) -> _Fitted:
    """Fit on labelled rows that are not held out.

    All of them are counted, whole. At most about ``calibration_rows`` of them (by a hash of the id,
    half of them toxic if there are enough) fit the logistic curve, each without its own counts; the rarer class
    weighs by the root of the ratio of the classes. Labels are read from ``labels.toxic``;
    null labels, null ids and unlabelled rows are skipped, and a document labelled twice is toxic
    if any label says so. ``pairs`` counts word pairs as expressions, too. With no usable labels every score is 0.5 or the label rate.
    """
    rows = _labelled(docs, labels, max_label_rows)
    size = SYMBOLS**order

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = [np.zeros(size), np.zeros(size)]
        for b in slices(batches):
            words = read_words(b.column("text"))
            bad = b.column("_y").to_numpy(zero_copy_only=False)[words.owner] > 0
            codes, of = word_codes(words.spelled, order)
            for k, chosen in ((1, bad), (0, ~bad)):
                times = np.bincount(words.code[chosen], minlength=len(words.spelled))
                np.add.at(both[k], codes, times[of])
        seen = np.flatnonzero(both[0] + both[1])
        for k in range(0, len(seen), 100_000):
            part = seen[k : k + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(both[1][part].astype(np.int64)), pa.array(both[0][part].astype(np.int64))], ["code", "toxic", "plain"])

    counted = rows.select("text", "_y").mapInArrow(count, "code long, toxic long, plain long").groupBy("code").agg(F.sum("toxic").alias("toxic"), F.sum("plain").alias("plain"))
    got = counted.toPandas()  # at most 29**order rows
    toxic, plain = np.zeros(size), np.zeros(size)
    toxic[got["code"]], plain[got["code"]] = got["toxic"], got["plain"]
    backoff = shared_backoff(toxic + plain, order)
    logs = tuple(np.log(class_model(c, backoff)).astype(np.float32) for c in (toxic, plain))

    table = cut(count_expressions(rows, pairs))
    seen = lambda c: F.count(F.when(F.col(c) > 0, 1))
    sums = {r["pair"]: Sizes(*map(float, r[1:])) for r in table.groupBy("pair").agg(F.sum("toxic"), F.sum("plain"), seen("toxic"), seen("plain"), F.count("*")).collect()}
    wide = SAID + 6
    model = ToxicityModel(logs, np.zeros(wide + 1), (np.zeros(wide), np.ones(wide)), order, sums.get(False, Sizes()), sums.get(True, Sizes()))
    telling = table.where(F.col("toxic") + F.col("plain") >= 2)
    if fits(telling, max_expressions):
        small = telling.select("key", "toxic", "plain").toArrow().sort_by("key")
        model.keys, model.toxic, model.plain = (small.column(c).to_numpy() for c in ("key", "toxic", "plain"))

    numbers = {r["y"]: r["n"] for r in rows.groupBy((F.col("_y") > 0).alias("y")).agg(F.count("*").alias("n")).collect()}
    share = {y: min(1.0, max(calibration_rows / 2, calibration_rows - numbers.get(not y, 0)) / max(1, numbers.get(y, 0))) for y in (True, False)}
    keep = rows.where(unit_hash(F.col("doc_id"), F.lit(7)) < F.when(F.col("_y") > 0, share[True]).otherwise(share[False]))
    sent = docs.sparkSession.sparkContext.broadcast((model, CharacterCounts((toxic.astype(np.float32), plain.astype(np.float32)), backoff.astype(np.float32), order)))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted, counts = sent.value
        for b in slices(batches):
            y = b.column("_y").to_numpy(zero_copy_only=False) > 0
            x = _measured(fitted, b, y, counts)
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), pa.array(y)], ["x", "y"])

    seen = with_said(keep.select("text", (F.col("_y") > 0).cast("int").alias("_y")), telling, model).mapInArrow(measure, "x array<double>, y boolean").toPandas()
    y = seen["y"].to_numpy().astype(float)
    if len(y) and 0 < y.sum() < len(y):
        x = np.stack(seen["x"].to_numpy())
        # The order of the sampled rows isn't fixed; the curve shouldn't depend on it.
        order_ = np.lexsort(x.T)
        x, y = x[order_], y[order_]
        # Less than a tenth of a nat is noise, and what taking out the own counts leaves behind.
        model.scale = x.mean(0), np.maximum(x.std(0), 0.1)
        model.curve = fit_logistic((x - model.scale[0]) / model.scale[1], y)
        model.curve[0] += 0.5 * np.log(numbers[False] / numbers[True]) - np.log(share[True] / share[False])
    elif len(y):
        model.curve[0] = -2.0 if y.sum() == 0 else 2.0
    return _Fitted(model, table, telling)


def score(docs: DataFrame, fitted: _Fitted, threshold: float = 0.7) -> DataFrame:
    """Score every whole text: doc_id, held_out, score, predicted, log_ratio, n_words.

    Null and empty texts get the score of no evidence (the curve's intercept). Repeated rows are
    scored alike, one output row each; columns of ``docs`` other than doc_id and text are ignored.
    ``log_ratio`` is the mean difference of log-likelihoods of its words. An empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(fitted.model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            x = _measured(sent.value, b)
            s = sent.value.score(x)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(s), pa.array((s >= threshold).astype(np.int32)), pa.array(x[:, 0]), pa.array(np.rint(np.where(np.any(x != 0, 1), np.exp(x[:, -1]), 0)).astype(np.int64))], ["doc_id", "held_out", "score", "predicted", "log_ratio", "n_words"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out(F.col("doc_id")).alias("held_out"))
    return with_said(rows, fitted.telling, fitted.model).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, log_ratio double, n_words long")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **options) -> DataFrame:
    """``docs`` without the rows whose text scores at least ``threshold``; all columns are kept, whatever their names.

    While the expressions can be broadcast the text is scored where it stands, so no row is
    shuffled. Null texts stay.
    """
    fitted = fit(docs, labels, **options)
    sent = docs.sparkSession.sparkContext.broadcast(fitted.model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            s = sent.value.score(_measured(sent.value, b))
            yield pa.RecordBatch.from_struct_array(b.column("row").filter(pa.array(s < threshold)))

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").cast("string").alias("text"))
    return with_said(rows, fitted.telling, fitted.model).mapInArrow(run, docs.schema)
