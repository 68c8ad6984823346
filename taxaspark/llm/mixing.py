"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target of words. A document's expected copies follow its length: those of more words than
is usual in their source are preferred by ``tilt``, with the source's expected words still at the
target and no document above ``max_copies``. The whole part is allocated for certain; the rest, which differs
from document to document, is its inclusion probability in Pareto order sampling: documents are
ranked by the odds of a keyed uniform number divided by the odds of their inclusion, and the lowest
ranks are taken until the source's remaining words are reached (the document at the boundary is taken if that brings
the total nearer). The ranks are cut in two steps, so that a source of any size is never sorted in
one task: ranges of the rank are summed, and only the range that holds the boundary is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxaspark.llm.common import SPACE, cut, join_checked

BUCKETS = 1024
WEIGHTS = (5, 2, 1)
KEY = "mix-1"
#: How much length counts: a document's expected copies are up to this share above or below its source's.
TILT = 1.0
#: Grades of length; whole numbers, so that sums don't depend on their order.
GRADES = 1000


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source and size (number of words; 0 for null texts) of every row."""
    size = F.regexp_count("text", F.lit(f"[^{SPACE}]+"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.coalesce(size, F.lit(0)).cast("long").alias("size"))


def uniform(doc_id: Column, key: str = KEY) -> Column:
    """A number in (0, 1) that depends on the key and the id alone (52 bits of an MD5)."""
    digest = F.md5(F.concat(F.lit(key + ":"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") + 0.5) / float(1 << 52)


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = 3) -> DataFrame:
    """source, source_size, target: all words shared by weight, none above max_copies times its size.

    Sources are ordered by code point, null last, and weigh ``weights``, repeated. A source is held
    at its maximum if its maximum per weight is below the level that the others then get; sources
    are tried in the order of that ratio, so one pass of running sums finds the level.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("w", w).withColumn("cap", F.col("source_size") * max_copies)
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), F.col("source").cast("binary"))
    everything = Window.partitionBy()
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumns(
        {
            "left_words": F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)),
            "left_weight": F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0)),
        }
    )
    free = F.col("cap") * F.col("left_weight") > F.col("left_words") * F.col("w")
    level = F.min(F.when(free, F.struct(F.col("cap") / F.col("w"), F.col("left_words"), F.col("left_weight")))).over(everything)
    per = per.withColumn("level", level)
    share = F.col("level.left_words").cast("double") * F.col("w") / F.col("level.left_weight")
    return per.select("source", "source_size", F.coalesce(F.least(F.col("cap").cast("double"), share), F.col("cap").cast("double")).alias("target"))


def grade(size: Column, usual: Column) -> Column:
    """Grade of a length from 0 to ``GRADES``: half of them at the usual one."""
    return F.floor(size * GRADES / F.greatest(size + usual, F.lit(1)))


def goals(sized: DataFrame, weights: tuple[int, ...], max_copies: int, tilt: float) -> DataFrame:
    """_s (key of the source), source_size, target, _usual, _each, _slope, _middle and _need (words left to sample).

    All sums are over (source, size, number of documents), which is counted once.
    """
    lengths = cut(sized.groupBy("_s", "source", "size").agg(F.count("*").alias("n")))
    per = lengths.groupBy("_s").agg(F.floor(F.sum(F.col("size") * F.col("n")) / F.greatest(F.sum("n"), F.lit(1))).alias("_usual"))
    target = targets(lengths.select("source", (F.col("size") * F.col("n")).alias("size")), weights, max_copies)
    target = target.withColumn("_s", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))).drop("source")
    goal = target.join(per, "_s").withColumn("_each", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    # Up to the tilt, but so that the longest document stays below max_copies.
    slope = F.when(F.col("_each") > 0, F.least(F.lit(float(tilt)), (F.lit(float(max_copies)) - F.col("_each")) / F.col("_each"))).otherwise(0.0)
    goal = goal.withColumn("_slope", F.greatest(slope, F.lit(0.0)))
    rows = lengths.join(goal, "_s")
    weighed = rows.groupBy("_s").agg(F.sum(F.col("size") * F.col("n") * grade(F.col("size"), F.col("_usual"))).alias("_w"))
    goal = goal.join(weighed, "_s").withColumn("_middle", F.when(F.col("source_size") > 0, F.col("_w").cast("double") / F.col("source_size")).otherwise(0.0)).drop("_w")
    whole = lengths.join(goal, "_s").groupBy("_s").agg(F.sum(F.floor(expected_copies()) * F.col("size") * F.col("n")).alias("_certain"))
    return goal.join(whole, "_s").withColumn("_need", F.col("target") - F.col("_certain")).drop("_certain")


def expected_copies() -> Column:
    """Expected copies of a document, of its size and its source's goal."""
    return F.col("_each") * (1.0 + F.col("_slope") * ((grade(F.col("size"), F.col("_usual")) - F.col("_middle")) / float(GRADES)))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = 3, key: str = KEY, buckets: int = BUCKETS, tilt: float = TILT) -> DataFrame:
    """doc_id, source, size, source_size, target, expected, copies, taken for every row of ``docs``.

    Null texts have size 0 and are taken never; null sources are one source; rows that repeat an id
    share its random number and are ranked by size, so reruns agree. Columns other than doc_id,
    source and text are ignored. An empty table gives an empty result.
    """
    sized = cut(sizes(docs).withColumn("_s", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))))
    goal = cut(goals(sized, weights, max_copies, tilt))
    rows = join_checked(sized, goal, ["_s"], "inner", 500_000).withColumn("expected", expected_copies())
    rows = rows.withColumn("_whole", F.floor("expected").cast("long")).withColumn("_part", F.col("expected") - F.col("_whole"))
    u = uniform(F.col("doc_id"), key)
    # Odds of u over the odds of inclusion; v is the same order on (0, 1).
    rank = (u / (1 - u)) / (F.col("_part") / (1 - F.col("_part")))
    rows = rows.withColumn("_q", F.when((F.col("_part") > 0) & (F.col("size") > 0), rank))
    rows = rows.withColumn("_b", F.floor(F.col("_q") / (1 + F.col("_q")) * buckets).cast("int"))

    sums = rows.where("_q IS NOT NULL").groupBy("_s", "_b").agg(F.sum("size").alias("_words"), F.first("_need").alias("_need"))
    sums = sums.withColumn("_upto", F.sum("_words").over(Window.partitionBy("_s").orderBy("_b")))
    edge = sums.where("_upto > _need").groupBy("_s").agg(F.min(F.struct("_b", F.expr("_upto - _words").alias("base"))).alias("e"))
    edge = cut(edge.select("_s", F.col("e._b").alias("_edge"), F.col("e.base").alias("_base")))
    rows = join_checked(rows, edge, ["_s"], "left", 500_000)
    at_edge = F.coalesce(F.col("_b") == F.col("_edge"), F.lit(False))
    # A source without an edge is taken whole once more.
    clear = rows.where(~at_edge).withColumn("_more", F.when(F.col("_q").isNotNull() & (F.col("_edge").isNull() | (F.col("_b") < F.col("_edge"))), 1).otherwise(0))
    within = Window.partitionBy("_s", "_b").orderBy("_q", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    near = rows.where(at_edge).withColumn("_upto", F.col("_base") + F.sum("size").over(within))
    near = near.withColumn("_more", F.when(F.col("_upto") - F.col("size") / 2 <= F.col("_need"), 1).otherwise(0)).drop("_upto")
    out = clear.unionByName(near).withColumn("copies", F.col("_whole") + F.col("_more"))
    return out.select("doc_id", "source", "size", "source_size", "target", "expected", "copies", (F.col("copies") * F.col("size")).alias("taken"))


ORACLE_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), per AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT *, ((row_number() OVER (ORDER BY source IS NULL, source)) - 1) % 3 AS r FROM per
), weighed AS (
  SELECT source, source_size, CASE r WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, 3 * source_size AS cap FROM ranked
), running AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS lw,
            (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap::DOUBLE / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS lv
  FROM weighed
), level AS (
  SELECT lw, lv FROM running WHERE cap * lv > lw * w ORDER BY cap::DOUBLE / w, lw, lv LIMIT 1
), goal AS (
  SELECT source, source_size, coalesce(least(cap::DOUBLE, (SELECT lw FROM level)::DOUBLE * w / (SELECT lv FROM level)), cap::DOUBLE) AS target FROM weighed
), usual AS (
  SELECT source, floor(sum(size) / greatest(count(*), 1)) AS m FROM sized GROUP BY source
), slope AS (
  SELECT g.*, m, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS each_, CASE WHEN target > 0 THEN greatest(least(1.0::DOUBLE, (3.0::DOUBLE - target / source_size) / (target / source_size)), 0.0) ELSE 0.0 END AS slope
  FROM goal g JOIN usual u ON g.source IS NOT DISTINCT FROM u.source
), graded AS (
  SELECT s.doc_id, s.size, floor(s.size * 1000 / greatest(s.size + l.m, 1)) AS grade, l.* FROM sized s JOIN slope l ON s.source IS NOT DISTINCT FROM l.source
), rows_ AS (
  SELECT *, CASE WHEN source_size > 0 THEN sum(size * grade::BIGINT) OVER (PARTITION BY source)::DOUBLE / source_size ELSE 0.0 END AS middle,
         (('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u FROM graded
), odds AS (
  SELECT *, each_ * (1.0::DOUBLE + slope * ((grade::DOUBLE - middle) / 1000.0::DOUBLE)) AS e FROM rows_
), parts AS (
  SELECT *, floor(e)::BIGINT AS whole, CASE WHEN e - floor(e) > 0 AND size > 0 THEN (u / (1 - u)) / ((e - floor(e)) / (1 - (e - floor(e)))) END AS q FROM odds
), cut_ AS (
  SELECT *, sum(CASE WHEN q IS NULL THEN 0 ELSE size END) OVER (PARTITION BY source ORDER BY q NULLS LAST, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
         sum(whole * size) OVER (PARTITION BY source) AS certain FROM parts
), taken_ AS (
  SELECT *, whole + CASE WHEN q IS NOT NULL AND upto - size / 2.0 <= target - certain THEN 1 ELSE 0 END AS copies FROM cut_
)
SELECT doc_id, source, size, source_size, target, e AS expected, copies::BIGINT AS copies, (copies * size)::BIGINT AS taken FROM taken_
"""
