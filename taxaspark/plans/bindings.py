"""Projections of the driver's tables onto the engine's data model, in Spark and in SQL.

The tables hold no sequences, so each operator runs on a deterministic stand-in: nucleotides from
prose, lineages and trees from region, nation and supplier, samples from ship years, stages from
nested predicates over events, quality profiles from line prices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from taxaspark.functions import dna
from taxaspark.operators import tree


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("sample"), F.col("text").alias("seq"))


def seqs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, sample (source), seq from the documents' letters; made once per row, whatever reads it."""
    return dna.from_prose(_documents(spark, sf_dir))


def tiles(spark: SparkSession, sf_dir: str, length: int, whole: bool = False, quality: bool = False) -> DataFrame:
    """doc_id, sample, tile (from 0), seq: every sequence as consecutive reads of ``length`` bases; the last may be shorter, with ``whole`` it then goes. ``quality`` adds qual, from the letters."""
    return dna.tiles(_documents(spark, sf_dir), length, whole, prose=True, quality=("ACGT", "I?5+") if quality else None)


DNA = "upper(translate(lower(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g')), 'abcdefghijklmnopqrstuvwxyz', 'acgtacgtacgtacgtacgtacgtac'))"
SEQS_SQL = f"seqs AS (SELECT doc_id, source AS sample, {DNA} AS seq FROM documents)"
REVCOMP = "translate(reverse({0}), 'ACGTRYKMBDHVNSW', 'TGCAYRMKVHDBNSW')"


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """s_suppkey, region, nation, supplier names."""
    s, n, r = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    return s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey).join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select("s_suppkey", "r_regionkey", "r_name", "n_nationkey", "n_name", "s_name")


SUPPLIERS_SQL = "sup AS (SELECT s_suppkey, r_regionkey, r_name, n_nationkey, n_name, s_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"


def supplier_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sample: ship year, s_suppkey, n lines, parts: distinct parts, quantity)."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_quantity", F.year("l_shipdate").cast("string").alias("sample"))
    per = li.groupBy("sample", F.col("l_suppkey").alias("s_suppkey"), "l_partkey").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("q"))
    return per.groupBy("sample", "s_suppkey").agg(F.sum("n").alias("n"), F.count("*").alias("parts"), F.sum("q").alias("quantity"))


COUNTS_SQL = "cnt AS (SELECT year(l_shipdate)::VARCHAR AS sample, l_suppkey AS s_suppkey, count(*)::BIGINT AS n, count(DISTINCT l_partkey)::BIGINT AS parts FROM lineitem GROUP BY 1, 2)"


def strain_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sample, s_suppkey, k: part key modulo 4, n lines, parts: distinct parts)."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("s_suppkey"), "l_partkey", F.year("l_shipdate").cast("string").alias("sample"))
    per = li.groupBy("sample", "s_suppkey", "l_partkey").agg(F.count("*").alias("n"))
    return per.groupBy("sample", "s_suppkey", (F.col("l_partkey") % 4).cast("int").alias("k")).agg(F.sum("n").alias("n"), F.count("*").alias("parts"))


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree report of each ship year in depth-first order: root, regions, nations, suppliers, and strains below these.

    Strains are a supplier's lines by part; the first of them has the suppliers' rank, the others one below. Every
    seventh supplier stands a level too deep: below the supplier before it, or, as a nation's first, below a
    missing level. Nations have seven direct reads and an unclassified row comes first.
    """
    leaves = strain_counts(spark, sf_dir).join(suppliers(spark, sf_dir), "s_suppkey").select("sample", F.col("r_regionkey").alias("r"), "r_name", F.col("n_nationkey").alias("na"), "n_name", F.col("s_suppkey").alias("s"), "s_name", "k", "n", "parts")
    taxa = leaves.groupBy("sample", "r", "r_name", "na", "n_name", "s", "s_name").agg(F.sum("n").alias("n"), F.sum("parts").alias("parts"), F.coalesce(F.sum(F.when(F.col("k") == 3, F.col("n"))), F.lit(0)).alias("own"))
    nations = taxa.groupBy("sample", "r", "r_name", "na", "n_name").agg(F.sum("n").alias("n"), F.sum("parts").alias("parts"))
    up = nations.withColumn("level", F.explode(F.array(*[F.lit(i) for i in range(3)])))
    at = lambda k, c: F.when(F.col("level") >= k, F.col(c))
    name = F.when(F.col("level") == 0, "root").when(F.col("level") == 1, F.col("r_name")).otherwise(F.col("n_name"))
    up = up.groupBy("sample", "level", at(1, "r").alias("r"), at(2, "na").alias("na"), name.alias("name")).agg(F.sum("n").alias("lines"), F.sum("parts").alias("parts"), (F.count("*") * 7).alias("extra"))
    nothing = F.lit(None).cast("long")
    up = up.select("sample", "level", F.col("r").cast("long").alias("r"), F.col("na").cast("long").alias("na"), nothing.alias("s"), nothing.alias("k"), "name", (F.col("lines") + F.col("extra")).alias("clade"), F.when(F.col("level") == 2, 7).otherwise(0).cast("long").alias("own"), "parts")
    mid = taxa.select("sample", F.lit(3).alias("level"), F.col("r").cast("long").alias("r"), F.col("na").cast("long").alias("na"), "s", nothing.alias("k"), F.col("s_name").alias("name"), F.col("n").alias("clade"), "own", "parts")
    low = leaves.where("k < 3").select("sample", F.lit(4).alias("level"), F.col("r").cast("long").alias("r"), F.col("na").cast("long").alias("na"), "s", F.col("k").cast("long").alias("k"), F.concat("s_name", F.lit(" strain "), "k").alias("name"), F.col("n").alias("clade"), F.col("n").alias("own"), "parts")
    none = taxa.groupBy("sample").agg(F.count("*").alias("n")).select("sample", F.lit(-1).alias("level"), nothing.alias("r"), nothing.alias("na"), nothing.alias("s"), nothing.alias("k"), F.lit("unclassified").alias("name"), F.col("n").alias("clade"), F.col("n").alias("own"), F.lit(0).cast("long").alias("parts"))
    rows = none.unionByName(up).unionByName(mid).unionByName(low)
    order = Window.partitionBy("sample").orderBy(F.col("level") >= 0, *[F.asc_nulls_first(c) for c in ("r", "na", "s", "k")])
    deeper = F.when(F.col("s") % 7 == 3, 1).otherwise(0)
    level = F.col("level")
    return rows.select(
        "sample", (F.row_number().over(order) - 1).cast("long").alias("idx"), F.when(level < 0, 0).otherwise(level + deeper).cast("int").alias("depth"),
        F.when(level < 0, "U").when(level == 4, F.when(F.col("k") == 0, "S").otherwise("S1")).otherwise(F.element_at(F.array(*[F.lit(x) for x in "RPGS"]), F.greatest(level, F.lit(0)).cast("int") % 4 + 1)).alias("rank"),
        F.when(level < 0, "0").when(level == 0, "1").when(level == 1, F.concat(F.lit("r"), "r")).when(level == 2, F.concat(F.lit("n"), "na")).when(level == 3, F.concat(F.lit("s"), "s")).otherwise(F.concat_ws(".", F.concat(F.lit("t"), "s"), "k")).alias("taxid"),
        "name", F.col("clade").alias("clade_reads"), F.col("own").alias("direct_reads"), (F.col("parts") * 2).alias("total_minimizers"), F.col("parts").alias("distinct_minimizers"),
    )


REPORT_SQL = f"""{SUPPLIERS_SQL}, strain AS (SELECT year(l_shipdate)::VARCHAR AS sample, l_suppkey AS s_suppkey, (l_partkey % 4)::INT AS k, count(*)::BIGINT AS n, count(DISTINCT l_partkey)::BIGINT AS parts FROM lineitem GROUP BY 1, 2, 3),
leaf AS (SELECT * FROM strain JOIN sup USING (s_suppkey)), taxon AS (
  SELECT sample, r_regionkey, r_name, n_nationkey, n_name, s_suppkey, s_name, sum(n)::BIGINT AS n, sum(parts)::BIGINT AS parts, coalesce(sum(n) FILTER (k = 3), 0)::BIGINT AS own FROM leaf GROUP BY ALL
), flat AS (
  SELECT sample, -1 AS level, NULL::INT AS r, NULL::INT AS na, NULL::BIGINT AS s, NULL::INT AS k, 'unclassified' AS name, count(*)::BIGINT AS clade, count(*)::BIGINT AS own, 0::BIGINT AS parts FROM taxon GROUP BY sample
  UNION ALL SELECT sample, 0, NULL, NULL, NULL, NULL, 'root', (sum(n) + 7 * count(DISTINCT n_nationkey))::BIGINT, 0, sum(parts)::BIGINT FROM taxon GROUP BY sample
  UNION ALL SELECT sample, 1, r_regionkey, NULL, NULL, NULL, r_name, (sum(n) + 7 * count(DISTINCT n_nationkey))::BIGINT, 0, sum(parts)::BIGINT FROM taxon GROUP BY sample, r_regionkey, r_name
  UNION ALL SELECT sample, 2, r_regionkey, n_nationkey, NULL, NULL, n_name, sum(n)::BIGINT + 7, 7, sum(parts)::BIGINT FROM taxon GROUP BY sample, r_regionkey, n_nationkey, n_name
  UNION ALL SELECT sample, 3, r_regionkey, n_nationkey, s_suppkey, NULL, s_name, n, own, parts FROM taxon
  UNION ALL SELECT sample, 4, r_regionkey, n_nationkey, s_suppkey, k, s_name || ' strain ' || k, n, n, parts FROM leaf WHERE k < 3
), rep AS (
  SELECT sample, row_number() OVER (PARTITION BY sample ORDER BY level >= 0, r NULLS FIRST, na NULLS FIRST, s NULLS FIRST, k NULLS FIRST) - 1 AS idx,
    (CASE WHEN level < 0 THEN 0 ELSE level + CASE WHEN s % 7 = 3 THEN 1 ELSE 0 END END)::INT AS depth,
    CASE level WHEN -1 THEN 'U' WHEN 0 THEN 'R' WHEN 1 THEN 'P' WHEN 2 THEN 'G' WHEN 3 THEN 'S' ELSE CASE k WHEN 0 THEN 'S' ELSE 'S1' END END AS rank,
    CASE level WHEN -1 THEN '0' WHEN 0 THEN '1' WHEN 1 THEN 'r' || r WHEN 2 THEN 'n' || na WHEN 3 THEN 's' || s ELSE 't' || s || '.' || k END AS taxid, name, clade AS clade_reads,
    own AS direct_reads, parts * 2 AS total_minimizers, parts AS distinct_minimizers FROM flat
), ends AS (
  SELECT c.*, coalesce((SELECT min(e.idx) FROM rep e WHERE e.sample = c.sample AND e.idx > c.idx AND e.depth <= c.depth), (SELECT max(e.idx) + 1 FROM rep e WHERE e.sample = c.sample)) AS end_idx FROM rep c
), links AS (
  SELECT c.*, (SELECT max(p.idx) FROM ends p WHERE p.sample = c.sample AND p.idx < c.idx AND p.depth = c.depth - 1 AND p.end_idx > c.idx) AS parent_idx FROM ends c
)"""


def linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree.link(report(spark, sf_dir))


def lineages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """s_suppkey and lineage string of each supplier."""
    return suppliers(spark, sf_dir).select("s_suppkey", F.concat_ws(";", F.concat(F.lit("k__"), "r_name"), F.concat(F.lit("p__"), "n_name"), F.concat(F.lit("s__"), "s_name")).alias("lineage"))


LINEAGES_SQL = f"{SUPPLIERS_SQL}, lin AS (SELECT s_suppkey, 'k__' || r_name || ';p__' || n_name || ';s__' || s_name AS lineage FROM sup)"


def profile_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality profile bins: sample = return flag, mate from the line number, bin from the quantity."""
    li = table(spark, sf_dir, "lineitem")
    rows = li.select(F.col("l_returnflag").alias("sample"), (F.col("l_linenumber") % 2 + 1).cast("int").alias("mate"), ((F.col("l_quantity") - 1) / 5).cast("int").alias("b"), F.round(F.lit(40) - F.col("l_discount") * 100 - F.col("l_quantity") / 4, 2).alias("q"))
    per = rows.groupBy("sample", "mate", "b").agg(F.round(F.avg("q"), 4).alias("q1"))
    return per.select("sample", "mate", (F.col("b") * 5 + 1).alias("bin_start"), (F.col("b") * 5 + 5).alias("bin_end"), "q1")


BINS_SQL = """bins AS (SELECT sample, mate, (b * 5 + 1)::INT AS bin_start, (b * 5 + 5)::INT AS bin_end, q1 FROM (
  SELECT l_returnflag AS sample, (l_linenumber % 2 + 1)::INT AS mate, floor((l_quantity - 1) / 5)::INT AS b, round(avg(round(40 - l_discount * 100 - l_quantity / 4, 2)), 4) AS q1 FROM lineitem GROUP BY 1, 2, 3))
, pos AS (SELECT sample, mate, q1, unnest(generate_series(bin_start, bin_end))::INT AS pos FROM bins)
, prof AS (SELECT mate, pos, round(median(q1), 4) AS q1 FROM pos GROUP BY mate, pos HAVING count(*) >= (SELECT count(DISTINCT sample) FROM bins b WHERE b.mate = pos.mate))
"""


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    from taxaspark.operators import truncation

    return truncation.median_profile(profile_bins(spark, sf_dir)).withColumn("q1", F.round("q1", 4))
