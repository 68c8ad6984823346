"""Divergence of the sources of a language: exact sums of differences of term shares.

Terms are split by the number of groups (a source of a language) in which they stand. Terms of many groups are
heavy: their shares fill dense tiles (groups by terms) that numpy compares block by block. Terms of
few groups are light: for them every pair starts with the difference of the shares of an absent term, to
which come two sparse corrections. One is of a single group's terms against the other's share of an absent
term, read off the group's histogram of shares; the other is of pairs within a posting list, which has at most
``light`` entries. All shares are whole numbers, so that the parts add up exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxaspark.llm.common import cut, fits, slices

#: Groups of a dense block, terms of a dense tile, postings of a sparse tile.
BLOCK, DENSE, SPARSE = 256, 2048, 100_000
UNIT, PRIOR = 1_000_000_000, 5

_LETTER = np.zeros(256, bool)
_LETTER[0x80:] = True
_LETTER[ord("A") : ord("Z") + 1] = _LETTER[ord("a") : ord("z") + 1] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def terms(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Owner (position of the text) and spelling of every term: runs of ASCII letters and of anything beyond ASCII, only A-Z lower-cased."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    letter = _LETTER[raw]
    opens = letter.copy()
    opens[1:] &= ~letter[:-1]
    borders = offsets[1:-1][offsets[1:-1] < len(raw)]
    opens[borders] = letter[borders]  # a term doesn't run on into the next text
    starts = np.flatnonzero(opens)
    kept = np.cumsum(letter) - 1
    places = np.append(kept[starts], np.count_nonzero(letter)).astype(np.int64)
    spelled = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(_LOWER[raw[letter]]))
    return np.searchsorted(offsets, starts, side="right") - 1, spelled


def term_counts(docs: DataFrame, flush: int = 300_000) -> DataFrame:
    """lang, source, term, n (occurrences), df (documents); a row with a null term for every group, also one without terms.

    Null text, lang and source count as empty. Whole texts are counted, batch by batch; what a task
    has seen is summed before the shuffle.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pd.DataFrame] = []
        size = 0
        for b in slices(batches):
            owner, spelled = terms(b.column("text"))
            coded = spelled.dictionary_encode()
            names = coded.dictionary.to_pandas()
            code = coded.indices.to_numpy().astype(np.int64)
            group = pd.MultiIndex.from_arrays([b.column("lang").to_pandas(), b.column("source").to_pandas()])
            number, kinds = pd.factorize(group)
            both = np.sort(owner * np.int64(max(1, len(names))) + code)
            first = np.flatnonzero(np.diff(both, prepend=-1))
            times = np.diff(np.append(first, len(both)))
            doc, code = np.divmod(both[first], max(1, len(names)))
            key, at = np.unique(number[doc].astype(np.int64) * max(1, len(names)) + code, return_inverse=True)
            n, df = (np.bincount(at, w, len(key)).astype(np.int64) for w in (times, np.ones(len(at))))
            of, code = np.divmod(key, max(1, len(names)))
            lang, source = (np.array([k[i] for k in kinds], object) for i in (0, 1))
            held.append(pd.DataFrame({"lang": lang[of], "source": source[of], "term": names.to_numpy(object)[code], "n": n, "df": df}))
            held.append(pd.DataFrame({"lang": lang, "source": source, "term": None, "n": 0, "df": 0}))
            size += len(key)
            if size > flush:
                yield summed(held)
                held, size = [], 0
        if held:
            yield summed(held)

    def summed(parts: list[pd.DataFrame]) -> pa.RecordBatch:
        every = pd.concat(parts, ignore_index=True).groupby(["lang", "source", "term"], dropna=False, sort=False)[["n", "df"]].sum().reset_index()
        every["term"] = every["term"].astype(object).where(every["term"].notna(), None)
        fields = [("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("df", pa.int64())]
        return pa.RecordBatch.from_pandas(every, pa.schema(fields), preserve_index=False)

    rows = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    counted = rows.mapInArrow(count, "lang string, source string, term string, n long, df long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(UNIT * (count + PRIOR) / (total + PRIOR * kept)), exact however large the counts are."""
    wide = lambda c, d: c.cast(f"decimal({d},0)")
    below = wide(total, 20) + F.lit(PRIOR) * wide(kept, 12)
    return F.lit(1) + F.call_function("div", wide(F.lit(UNIT), 10) * wide(count + F.lit(PRIOR), 20), below)


def _mirrored(lang: np.ndarray | str, g: np.ndarray, o: np.ndarray, value: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"lang": lang, "g": np.concatenate([g, o]), "o": np.concatenate([o, g]), "value": np.concatenate([value, value])})


PAIR = "lang string, g long, o long, value long"


def _dense(postings: DataFrame, groups: DataFrame) -> DataFrame:
    """Sums of |p - q| over heavy terms for all pairs of groups, tile by tile."""
    terms_of = postings.select("lang", "term").distinct().groupBy("lang").agg(F.count("*").alias("_terms"))
    size = groups.groupBy("lang").agg((F.max("g") + 1).alias("_groups"))
    per = terms_of.join(size, "lang")
    rows = postings.join(F.broadcast(per) if fits(per, 100_000) else per, "lang")
    tile = F.pmod(F.xxhash64("term"), F.ceil(F.col("_terms") / DENSE))
    sizes = rows.withColumn("tile", tile).groupBy("lang", "tile").agg(F.count_distinct("term").alias("terms"))
    blocks = F.ceil(F.col("_groups") / BLOCK)
    own = F.floor(F.col("g") / BLOCK)
    rows = rows.withColumn("tile", tile).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    rows = rows.select("lang", "term", "tile", "g", "p", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), F.lit(0).cast("long").alias("terms"))
    # Absent terms have the group's share of a count of 0: one row with a null term per group, tile and block pair.
    absent = groups.join(per, "lang").join(sizes, "lang")
    absent = absent.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    absent = absent.select("lang", F.lit(None).cast("string").alias("term"), "tile", "g", F.col("z").alias("p"), "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "terms")

    def compare(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        lang, _, i, j = key
        there = pdf["term"].notna()
        zero, posts = pdf[~there], pdf[there]
        code, names = pd.factorize(posts["term"])
        rest = int(zero["terms"].iloc[0]) - len(names)  # terms of the tile in neither block

        def matrix(block: int) -> tuple[np.ndarray, np.ndarray]:
            z = zero[zero["own"] == block].drop_duplicates("g").sort_values("g")
            ids, absent = z["g"].to_numpy(), z["p"].to_numpy(np.int64)
            m = np.repeat(z["p"].to_numpy(np.int64)[:, None], len(names), 1)
            mine = (posts["own"] == block).to_numpy()
            m[np.searchsorted(ids, posts["g"].to_numpy()[mine]), code[mine]] = posts["p"].to_numpy(np.int64)[mine]
            return ids, np.concatenate([m, absent[:, None]], 1)

        a, left = matrix(i)
        b, right = (a, left) if i == j else matrix(j)
        g, o, value = [], [], []
        for k, row in enumerate(left):
            start = k + 1 if i == j else 0
            g.append(np.full(len(b) - start, a[k]))
            o.append(b[start:])
            apart = np.abs(right[start:] - row)
            value.append(apart[:, :-1].sum(1) + rest * apart[:, -1])
        if not g:
            return pd.DataFrame({"lang": [], "g": [], "o": [], "value": []})
        return _mirrored(lang, np.concatenate(g), np.concatenate(o), np.concatenate(value))

    return rows.unionByName(absent).groupBy("lang", "tile", "i", "j").applyInPandas(compare, PAIR)


def _posting_pairs(postings: DataFrame, count: int) -> DataFrame:
    """Corrections of pairs within the posting lists of light terms, summed per tile: |p-q| - |p-z'| - |z-q| + |z-z'|."""

    def correct(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        code = pd.factorize(pdf["term"])[0]
        order = np.lexsort((pdf["g"].to_numpy(), code))
        code = code[order]
        g, p, z = (pdf[c].to_numpy(np.int64)[order] for c in ("g", "p", "z"))
        sums = pd.Series(np.zeros(0, np.int64), index=pd.MultiIndex.from_arrays([[], []]))
        for step in range(1, len(code)):  # the entry so many places on in the same list; at most ``light`` - 1 steps
            same = np.flatnonzero(code[step:] == code[:-step])
            if not len(same):
                break
            a, b = same, same + step
            value = np.abs(p[a] - p[b]) - np.abs(p[a] - z[b]) - np.abs(z[a] - p[b]) + np.abs(z[a] - z[b])
            sums = pd.concat([sums, pd.Series(value, index=pd.MultiIndex.from_arrays([g[a], g[b]]))]).groupby(level=[0, 1]).sum()
        return _mirrored(key[0], sums.index.get_level_values(0).to_numpy(np.int64), sums.index.get_level_values(1).to_numpy(np.int64), sums.to_numpy(np.int64))

    tile = F.pmod(F.xxhash64("term"), F.lit(count)).alias("tile")
    return postings.select("lang", "term", "g", "p", "z", tile).groupBy("lang", "tile").applyInPandas(correct, PAIR)


def _against_absent(postings: DataFrame, groups: DataFrame, light_terms: DataFrame) -> DataFrame:
    """For every pair the light terms as if absent in both, and the terms of each against the other's share of an absent one."""
    shares = postings.groupBy("lang", "g", "p").agg(F.count("*").alias("n"))
    histogram = shares.groupBy("lang", "g").agg(F.sort_array(F.collect_list(F.struct("p", "n"))).alias("shares"))
    others = groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("g", "z"))).alias("others"))
    rows = groups.select("lang", "g", "z").join(histogram, ["lang", "g"], "left").join(others, "lang").join(light_terms, "lang", "left").withColumn("light", F.coalesce("light", F.lit(0)))

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for r in pdf.itertuples(index=False):
                o, z = (np.array([x[c] for x in r.others], np.int64) for c in ("g", "z"))
                p, n = (np.array([x[c] for x in (r.shares if r.shares is not None else ())], np.int64) for c in ("p", "n"))
                absent = np.abs(r.z - z)
                at = np.searchsorted(p, z)
                below, weight = np.append(0, np.cumsum(n)), np.append(0, np.cumsum(n * p))
                to = (z * below[at] - weight[at]) + (weight[-1] - weight[at]) - z * (below[-1] - below[at])
                own = to - below[-1] * absent
                other = o != r.g
                # Both sides meet in the sum: this row is the own part for (g, o) and, mirrored, the other's for (o, g).
                yield _mirrored(r.lang, np.full(other.sum(), r.g), o[other], own[other])
                yield pd.DataFrame({"lang": r.lang, "g": r.g, "o": o[other], "value": r.light * absent[other]})

    return rows.mapInPandas(compare, PAIR)


def audit(docs: DataFrame, least_docs: int = 30, top: int = 50, light: int = 8) -> DataFrame:
    """lang, source, part, item, value, rank: distance of each source from the others of its language, and its most over-used terms.

    ``docs`` has text, lang and source; nulls count as empty, other columns are ignored. A term is kept for a
    language if it stands in at least ``least_docs`` rows of it; repeated rows count each. A group or language
    of N kept occurrences gives a term of count c the share 1 + floor(10**9 * (c + 5) / (N + 5 V)).
    Part ``pair`` has every other source of the language with the sum of differences over its V kept terms
    (0 without any), part ``term`` the first ``top`` terms that the group uses more than its language does.
    Ties go by the item's UTF-8 bytes. An empty table gives an empty result. Terms that stand in more than
    ``light`` groups are compared in dense tiles, the others by their postings; the result doesn't depend on it.
    """
    counts = cut(term_counts(docs))
    groups = counts.where(F.col("term").isNull()).select("lang", "source")
    own = Window.partitionBy("lang", "term")
    kept = counts.where(F.col("term").isNotNull()).withColumns({"ln": F.sum("n").over(own), "ldf": F.sum("df").over(own), "m": F.count("*").over(own)})
    kept = cut(kept.where(F.col("ldf") >= least_docs).select("lang", "source", "term", "n", "ln", "m"))
    vocabulary = kept.groupBy("lang", "term").agg(F.first("ln").alias("ln"), F.first("m").alias("m"))
    langs = vocabulary.groupBy("lang").agg(F.count("*").alias("v"), F.sum("ln").alias("lang_total"), F.count(F.when(F.col("m") <= light, 1)).alias("light"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").withColumn("total", F.coalesce("total", F.lit(0)))
    groups = groups.withColumn("g", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1)
    groups = cut(groups.withColumn("z", F.when(F.col("v") > 0, share(F.lit(0), F.col("total"), F.col("v"))).otherwise(0)))
    small = F.broadcast(groups) if fits(groups, 200_000) else groups
    posted = kept.join(small.select("lang", "source", "g", "z", "total", "v", "lang_total"), ["lang", "source"])
    posted = cut(posted.select("lang", "source", "term", "g", "z", "m", share(F.col("n"), F.col("total"), F.col("v")).alias("p"), share(F.col("ln"), F.col("lang_total"), F.col("v")).alias("q")))

    thin = posted.where(F.col("m") <= light)
    tiles = max(1, -(-thin.count() // SPARSE))
    parts = _dense(posted.where(F.col("m") > light), groups).unionByName(_posting_pairs(thin, tiles)).unionByName(_against_absent(thin, groups, langs.select("lang", "light")))
    sums = parts.groupBy("lang", "g", "o").agg(F.sum("value").alias("value"))
    name = lambda g, c: small.select("lang", F.col("g").alias(g), F.col("source").alias(c))
    pairs = sums.join(name("g", "source"), ["lang", "g"]).join(name("o", "item"), ["lang", "o"]).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    over = posted.where(F.col("p") > F.col("q")).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    ranked = pairs.withColumn("rank", rank).unionByName(over.withColumn("rank", rank).where(F.col("rank") <= top))
    return ranked.select("lang", "source", "part", "item", "value", "rank")


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS i, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
w AS (
  SELECT i, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS ln FROM w GROUP BY ALL HAVING count(DISTINCT i) >= 30),
l AS (SELECT lang, count(*) AS v, sum(ln) AS lt FROM k GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY ALL),
t AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (
  SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (t.total + 5 * l.v)::HUGEINT AS p,
    1 + (1000000000::HUGEINT * (k.ln + 5)) // (l.lt + 5 * l.v)::HUGEINT AS q
  FROM t JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term),
e AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(e.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN e ON e.lang = a.lang AND e.source = a.source AND e.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM r QUALIFY part = 'pair' OR rank <= 50
"""
