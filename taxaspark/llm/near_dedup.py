"""MinHash near-dedup with ProbMinHash.

A document is its five-word shingles, each weighing 1 + ln(its count). Every shingle starts a
Poisson process whose rate is its weight; each arrival falls on one register of the signature, and
a register keeps the shingle that arrives first. A shingle stops as soon as its next arrival is
later than the latest register of its document, so most make one step (early termination). Two
signatures agree in a register with the probability Jaccard of the weighted shingles. Bands of
registers make candidates, and exact Jaccard of the shingle sets of at least 0.8 verifies them.
Repeated lines part the weighted sets of texts whose plain sets agree, so bands of a second signature
with weight 1 make candidates by the plain sets too.

Texts with the same word sequence are one node; its 64-bit key is verified by a second one, and a key that
two sequences share is parted. Within a bucket nodes are compared with a few
leaders only; verified links are closed to components, and where a bucket still holds several components,
what lies outside its largest one is compared with all of it in blocks, so pairs within a group are
never emitted and no link between components is given up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaspark.llm.common import anti_by_key, attach, cut, join_checked, slices

WORDS = 5
REGISTERS = 64
ROWS = 4  # registers in a band
SIMILARITY = 0.8
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _odd(k: int) -> np.uint64:
    """The k-th multiple of the golden ratio, modulo 2**64."""
    return np.uint64(0x9E3779B97F4A7C15 * k & (2**64 - 1))


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit keys (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a batch, and the offsets of its texts; words are runs of letters and digits."""
    plain = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"[^\pL\pN]+", " ")
    lists = pc.split_pattern(pc.utf8_trim(plain, " "), " ")
    values = lists.flatten()
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = pc.dictionary_encode(values) if len(values) else None
    if coded is None:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    words = coded.dictionary.to_pylist()
    own = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))
    hashes = own[coded.indices.to_numpy()]
    # a text without words splits to one empty word
    empty = np.fromiter((w == "" for w in words), bool, len(words))[coded.indices.to_numpy()]
    if empty.any():
        owner = np.repeat(np.arange(len(lengths)), lengths)
        lengths = lengths - np.bincount(owner[empty], minlength=len(lengths))
        hashes = hashes[~empty]
    return hashes, np.concatenate([[0], np.cumsum(lengths)])


def shingles(hashes: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, count) of the distinct shingles, sorted; a text of fewer words is one shingle."""
    n = np.diff(offsets)
    rolled = np.zeros(len(hashes), np.uint64)
    for j in range(words):
        part = _mix(hashes + _odd(j + 1))
        rolled[: max(0, len(rolled) - j)] += part[j:]
    rolled = _mix(rolled)
    short = np.flatnonzero((n > 0) & (n < words))
    keep = np.ones(len(hashes), bool)
    last = offsets[1:]
    for j in range(1, words):
        at = last[n >= 1] - j
        keep[at[at >= offsets[:-1][n >= 1]]] = False
    for i in short:
        a, b = offsets[i], offsets[i + 1]
        rolled[a] = _mix(np.array([sum(int(x) * (2 * k + 3) for k, x in enumerate(hashes[a:b])) & (2**64 - 1)], np.uint64))[0]
        keep[a] = True
    owner = np.repeat(np.arange(len(n)), n)[keep]
    rolled = rolled[keep]
    order = np.lexsort((rolled, owner))
    owner, rolled = owner[order], rolled[order]
    first = np.ones(len(rolled), bool)
    first[1:] = (rolled[1:] != rolled[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(first)
    return owner[at], rolled[at], np.diff(np.append(at, len(rolled)))


def signatures(owner: np.ndarray, shingle: np.ndarray, weight: np.ndarray, texts: int, registers: int = REGISTERS) -> np.ndarray:
    """ProbMinHash signatures, one row of ``registers`` shingle hashes for each text (0 without shingles)."""
    times = np.full(texts * registers, np.inf)
    who = np.zeros(texts * registers, np.uint64)
    t = np.zeros(len(shingle))
    step = 0
    while len(shingle):
        step += 1
        drawn = _mix(shingle ^ _odd(2 * step))
        t = t - np.log(((drawn >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)) / weight
        slot = owner * registers + (_mix(drawn + _GOLD) >> np.uint64(33)).astype(np.int64) % registers
        better = t < times[slot]
        s, ts, hs = slot[better], t[better], shingle[better]
        order = np.lexsort((ts, s))
        s, ts, hs = s[order], ts[order], hs[order]
        lead = np.ones(len(s), bool)
        lead[1:] = s[1:] != s[:-1]
        times[s[lead]], who[s[lead]] = ts[lead], hs[lead]
        latest = times.reshape(texts, registers).max(1)
        go = t < latest[owner]
        owner, shingle, weight, t = owner[go], shingle[go], weight[go], t[go]
    return who.reshape(texts, registers)


def _node(hashes: np.ndarray, offsets: np.ndarray, shared: frozenset[int] = frozenset()) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit keys of each word sequence; of those whose first is ``shared`` by several, it is made of both."""
    raw = np.ascontiguousarray(hashes).view(np.uint8).tobytes()
    keys = [xxhash.xxh3_128_intdigest(raw[8 * a : 8 * b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    first, second = (np.array([k >> by & (2**64 - 1) for k in keys], np.uint64) for by in (0, 64))
    if shared:
        twice = np.array([k in shared for k in first.view(np.int64).tolist()], bool)
        first[twice] = _mix(first[twice] ^ _mix(second[twice]))
    return first.view(np.int64), second.view(np.int64)


def sketch(docs: DataFrame, words: int = WORDS, registers: int = REGISTERS, rows: int = ROWS, shared: frozenset[int] = frozenset()) -> DataFrame:
    """doc_id, node (key of the word sequence), second (another key), bands of every row; bands is empty without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            hashes, offsets = word_hashes(part.column("text"))
            owner, shingle, count = shingles(hashes, offsets, words)
            sig = signatures(owner, shingle, 1 + np.log(count), part.num_rows, registers)
            plain = signatures(owner, shingle, np.ones(len(shingle)), part.num_rows, registers)
            bands = np.zeros((part.num_rows, 2 * (registers // rows)), np.uint64)
            for r in range(rows):
                bands = _mix(bands + np.hstack([sig[:, r::rows], plain[:, r::rows]]) + _GOLD)
            full = np.diff(offsets) > 0
            lists = [x if ok else [] for x, ok in zip(bands.view(np.int64).tolist(), full, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *map(pa.array, _node(hashes, offsets, shared)), pa.array(lists, pa.list_(pa.int64()))], ["doc_id", "node", "second", "bands"])

    rows_ = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows_.mapInArrow(run, "doc_id long, node long, second long, bands array<long>")


def shingle_sets(docs: DataFrame, words: int = WORDS, shared: frozenset[int] = frozenset()) -> DataFrame:
    """node and its sorted distinct shingles (32 bits each, as bytes), one row for each node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            hashes, offsets = word_hashes(part.column("text"))
            owner, shingle, _ = shingles(hashes, offsets, words)
            cuts = np.searchsorted(owner, np.arange(part.num_rows + 1))
            top = (shingle >> np.uint64(32)).astype(np.uint32)
            sets = [top[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(_node(hashes, offsets, shared)[0]), pa.array(sets, pa.binary())], ["node", "shingles"])

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "node long, shingles binary").dropDuplicates(["node"])


def verify(pairs: DataFrame, sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) whose exact Jaccard is at least ``similarity``, as (a, b).

    ``b`` may be one node for very many pairs; its set is then dealt over many partitions.
    """
    degree = pairs.groupBy("b").agg(F.count("*").alias("_n"))
    right = degree.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("right")), "b")
    rows = attach(pairs, right, "b", F.xxhash64("a"), "_n", hot=200)
    rows = rows.select("a", "b", "right").join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("left")), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            good = []
            for x, y in zip(b.column("left").to_pylist(), b.column("right").to_pylist(), strict=True):
                p, q = np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)
                if min(len(p), len(q)) < similarity * max(len(p), len(q)) or not len(p):
                    good.append(False)
                    continue
                both = np.sort(np.concatenate([p, q]), kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                good.append(common >= similarity * (len(p) + len(q) - common))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    return rows.select("a", "b", "left", "right").mapInArrow(run, "a long, b long")


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Number of common elements of every set of ``left`` with every set of ``right`` (sorted, distinct)."""
    sizes = [len(x) for x in [*left, *right]]
    if sum(sizes) > 80_000:  # long texts: pair by pair, only where the sizes allow a link
        out = np.zeros((len(left), len(right)), np.int64)
        for i, p in enumerate(left):
            for j, q in enumerate(right):
                if min(len(p), len(q)) >= SIMILARITY * max(len(p), len(q)):
                    both = np.sort(np.concatenate([p, q]), kind="stable")
                    out[i, j] = (both[1:] == both[:-1]).sum()
        return out
    values, codes = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    table = np.zeros((len(sizes), len(values)), np.float32)
    table[np.repeat(np.arange(len(sizes)), sizes), codes] = 1
    return (table[: len(left)] @ table[len(left) :].T).round().astype(np.int64)


def search_mixed(member: DataFrame, sets: DataFrame, similarity: float = SIMILARITY, block: int = 64, block_bytes: int = 4 << 20) -> DataFrame:
    """Links (a, b) between components within the buckets that hold several.

    ``member`` has bucket, node, root. What isn't in a bucket's largest component is compared with all
    the bucket, block by block: a row holds two blocks of sets, never a pair, and only links come
    out. The blocks' number follows the bucket's size in sets and in bytes, and each pair of blocks
    is dealt by itself, so no task holds a whole bucket or does all of its work.
    """
    per = member.groupBy("bucket", "root").agg(F.count("*").alias("m"))
    mixed = per.groupBy("bucket").agg(F.max(F.struct("m", "root"))["root"].alias("main"), F.count("*").alias("roots")).where("roots > 1").select("bucket", "main")
    # A table of its own, so that the join stands alone and Spark may split a large bucket.
    rows = cut(join_checked(member, cut(mixed), ["bucket"]).join(sets, "node").select("bucket", "node", "root", "main", "shingles"))
    blocks = F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum(F.octet_length("shingles")) / block_bytes))
    size = cut(rows.groupBy("bucket").agg(blocks.cast("int").alias("blocks"), F.count("*").alias("n")))
    item = F.struct("node", "root", "shingles")
    rows = attach(rows, size, "bucket", F.xxhash64("node"), "n").withColumn("blk", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    right = rows.groupBy("bucket", "blk").agg(F.collect_list(item).alias("right"))
    left = rows.where("root <> main").groupBy("bucket", "blk", "blocks").agg(F.collect_list(item).alias("left"))
    left = left.select("bucket", "left", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("blk"))
    met = left.join(right, ["bucket", "blk"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: list[tuple[int, int]] = []
            for k in range(b.num_rows):
                left, right = b.column("left")[k].as_py(), b.column("right")[k].as_py()
                p, q = ([np.frombuffer(x["shingles"], np.uint32) for x in side] for side in (left, right))
                np_, nq = np.array([len(x) for x in p])[:, None], np.array([len(x) for x in q])[None, :]
                rp, rq = np.array([x["root"] for x in left])[:, None], np.array([x["root"] for x in right])[None, :]
                common = common_counts(p, q)
                good = (common >= similarity * (np_ + nq - common)) & (rp != rq) & (np_ > 0)
                found += [(left[i]["node"], right[j]["node"]) for i, j in zip(*np.nonzero(good), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], ["a", "b"])

    return met.select("left", "right").mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """node, root (smallest node of the component) for all nodes of ``edges`` (a, b).

    Large-star and small-star steps until the edges stay the same; if they don't in ``rounds`` rounds, that is an
    error (their number grows with the square of the logarithm of the component). The least neighbours are a table of their own before
    they are joined, so the joins stand alone and Spark may split a hub's edges.
    """
    edges = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    for _ in range(rounds):
        both = edges.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.u", "e.v")
        low = cut(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = cut(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = cut(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        edges = cut(small.select("e.u", "e.v").where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise ValueError(f"the components aren't settled after {rounds} rounds")
    roots = edges.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _leader_pairs(buckets: DataFrame, stats: DataFrame) -> DataFrame:
    """Pairs of each bucket's nodes with the bucket's leaders, once each, as (node a, leader b)."""
    rows = attach(buckets, stats, "bucket", F.xxhash64("node"), "n")
    pairs = rows.select(F.col("node").alias("a"), F.explode(F.array_distinct("leaders")).alias("b")).where("a <> b")
    # A pair of leaders would come twice; any other pair has its leader second.
    return pairs.distinct()


def link(nodes: DataFrame, docs: DataFrame, similarity: float = SIMILARITY, words: int = WORDS, shared: frozenset[int] = frozenset()) -> DataFrame:
    """node, root for every node that has a verified link; ``nodes`` has node, rep (a doc_id), bands."""
    bucket = F.xxhash64(F.col("_b"), F.col("_key"))
    buckets = cut(nodes.select("node", F.posexplode("bands").alias("_b", "_key")).select("node", bucket.alias("bucket")))
    sizes = buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    met = cut(attach(buckets, cut(sizes), "bucket", F.xxhash64("node"), "n"))
    # How crowded a node's buckets are: highest for what is nearest to the middle of a large group.
    crowd = met.groupBy("node").agg(F.sum("n").alias("crowd"))
    met = cut(met.join(crowd, "node"))
    first = F.max(F.struct("crowd", F.xxhash64("node", F.lit(0)), "node"))["node"]
    other = F.min(F.struct(F.xxhash64("node", F.lit(1)), "node"))["node"]
    stats = cut(met.groupBy("bucket").agg(F.count("*").alias("n"), F.array(first, other, F.min("node"), F.max("node")).alias("leaders")))
    pairs = cut(_leader_pairs(met.select("node", "bucket"), stats))

    needed = nodes.join(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node").select(F.struct("rep").alias("id"))
    own = docs.select(F.col("text").alias("text"), F.struct(F.col("doc_id").cast("long").alias("rep")).alias("id"))
    sets = cut(shingle_sets(join_checked(own, cut(needed.distinct()), ["id"], "left_semi").select("text"), words, shared))
    edges = cut(verify(pairs, sets, similarity))
    roots = cut(components(edges))

    # Two leaders try all pairs of up to three nodes; larger buckets may still hold several components.
    member = attach(met.select("node", "bucket"), stats.where("n > 3").select("bucket", "n"), "bucket", F.xxhash64("node"), "n")
    member = cut(member.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    more = cut(search_mixed(member, sets, similarity))
    if more.limit(1).count():
        of = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias("r" + c))
        ends = more.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
        higher = cut(components(ends).withColumnRenamed("root", "_higher"))
        nodes_ = roots.unionByName(higher.select("node", F.col("node").alias("root"))).distinct()
        nodes_ = nodes_.groupBy("node").agg(F.min("root").alias("root"))
        roots = cut(nodes_.join(higher.select(F.col("node").alias("root"), "_higher"), "root", "left").select("node", F.coalesce("_higher", "root").alias("root")))
    return roots


def classes(docs: DataFrame, similarity: float = SIMILARITY, words: int = WORDS) -> DataFrame:
    """doc_id, class_id, class_size, kept: every row with the class of its near-duplicates.

    A class is a connected component of links of at least ``similarity``; its id is the smallest
    doc_id in it, and ``kept`` marks the rows with that id. Rows without words (null and empty texts too)
    have no shingles: each doc_id is its own class. Texts of fewer than five words are one shingle.
    Null ids are larger than any other; repeated rows are copies of one another. Columns other than
    doc_id and text are ignored; an empty table gives an empty result.
    """
    rows, shared = cut(sketch(docs, words)), frozenset()
    while True:
        filled = rows.where(F.size("bands") > 0)
        nodes = cut(filled.groupBy("node").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.count("*").alias("n"), F.min("second").alias("lo"), F.max("second").alias("hi")))
        more = {r["node"] for r in nodes.where("lo <> hi").select("node").collect()}  # by chance some 3 of 10**10 texts
        if not more:
            break
        shared |= more
        rows = cut(sketch(docs, words, shared=shared))
    roots = link(nodes.select("node", "rep", "bands"), docs, similarity=similarity, words=words, shared=shared)
    known = nodes.select("node", "rep", "n").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    known = cut(known)
    totals = known.groupBy("root").agg(F.min("rep").alias("class_id"), F.sum("n").alias("class_size"), F.count("*").alias("_m"))
    of_node = cut(attach(known, totals, "root", F.xxhash64("node"), "_m").select("node", "class_id", "class_size", "n"))
    out = attach(filled.select("doc_id", "node"), of_node, "node", F.xxhash64("doc_id"), "n").select("doc_id", "class_id", "class_size")
    alone = rows.where(F.size("bands") == 0).select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"))
    return out.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def drop_near_copies(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one document of each class, the one with the smallest doc_id; all columns are kept, whatever their names.

    Rows without an id stay, and rows that repeat an id are one document.
    """
    gone = cut(classes(docs, similarity).where("NOT kept AND doc_id IS NOT NULL").select("doc_id").distinct())
    return anti_by_key(docs, F.col("doc_id").cast("long"), gone)
