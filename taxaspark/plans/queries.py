"""The engine's queries over the driver's tables with their SQL equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaspark.functions import counts as fn
from taxaspark.functions import dna, lineage
from taxaspark.operators import profiling, reads, stats, tables, taxonomy, tree, truncation
from taxaspark.plans import bindings as b

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    """Register a query under its function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# ---- thresholds and statistics


@query("""SELECT year(l_shipdate)::VARCHAR AS sample, count(*)::BIGINT AS classified,
  greatest(10, floor(0.002 * count(*) + 0.5))::BIGINT AS threshold FROM lineitem GROUP BY 1""")
def depth_scaled_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = b.table(spark, sf_dir, "lineitem").groupBy(F.year("l_shipdate").cast("string").alias("sample")).agg(F.count("*").alias("classified"))
    return per.withColumn("threshold", fn.depth_threshold(F.col("classified"), 0.002))


@query("""WITH m AS (SELECT lang, floor((floor(avg(n_chars) / 10) + floor(avg(n_chars) / 12)) / 2)::BIGINT AS mean_len FROM documents GROUP BY lang)
  SELECT lang, mean_len, (SELECT k FROM (VALUES (50), (75), (100), (150), (200), (250), (300)) t(k) ORDER BY (mean_len - k) * (mean_len - k), k LIMIT 1) AS read_length FROM m""")
def nearest_bracken_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = b.table(spark, sf_dir, "documents").groupBy("lang").agg(F.avg("n_chars").alias("a"))
    m = m.select("lang", fn.mean_of_mates(F.floor(F.col("a") / 10), F.floor(F.col("a") / 12)).alias("mean_len"))
    return m.withColumn("read_length", fn.nearest_read_length(F.col("mean_len")))


def _pct(p: int, order: str = "n_chars") -> str:
    return f"list_sort(list({order}))[least(floor({p / 100} * count(*))::BIGINT, count(*) - 1) + 1]"


@query(f"""SELECT lang, count(*)::BIGINT AS n, min(n_chars) AS min, {_pct(25)} AS q1, {_pct(50)} AS median, {_pct(75)} AS q3, {_pct(95)} AS p95, {_pct(99)} AS p99,
  max(n_chars) AS max, round(avg(n_chars), 2) AS mean, round(coalesce(stddev_samp(n_chars), 0.0), 2) AS stdev FROM documents GROUP BY lang""")
def length_summary_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.length_summary(b.table(spark, sf_dir, "documents"), ["lang"], "n_chars")


@query("SELECT lang, n_chars, count(*)::BIGINT AS n FROM documents GROUP BY lang, n_chars")
def length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.histogram(b.table(spark, sf_dir, "documents"), ["lang"], "n_chars")


@query("""WITH e AS (SELECT min(n_chars) AS lo, greatest(1, (max(n_chars) - min(n_chars)) // 60) AS w FROM documents)
  SELECT (lo + ((n_chars - lo) // w) * w)::BIGINT AS bin_start, w::INT AS bin_width, count(*)::BIGINT AS n FROM documents, e GROUP BY 1, 2""")
def length_plot_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.plot_bins(b.table(spark, sf_dir, "documents"), "n_chars")


@query(f"""WITH s AS (SELECT lang, {_pct(25)} AS q1, {_pct(95)} AS p95 FROM documents GROUP BY lang)
  SELECT doc_id, d.lang, n_chars, q1 - 50 AS min_len, p95 + 50 AS max_len FROM documents d JOIN s ON d.lang = s.lang WHERE n_chars BETWEEN q1 - 50 AND p95 + 50""")
def length_window_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = b.table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    s = stats.percentiles(docs, ["lang"], "n_chars", {"q1": 25, "p95": 95})
    low, high = stats.window_columns(F.col("q1"), F.col("p95"), F.lit(None).cast("int"), 50)
    rows = docs.join(s, "lang").withColumns({"min_len": low, "max_len": high})
    return stats.keep_lengths(rows, F.col("n_chars"), F.col("min_len"), F.col("max_len")).drop("q1", "p95")


@query("""WITH c AS (SELECT source, n_chars, count(*) AS n FROM documents GROUP BY 1, 2), r AS (
  SELECT *, sum(n) OVER (PARTITION BY source ORDER BY n_chars DESC) AS reach, sum(n) OVER (PARTITION BY source) AS total FROM c)
  SELECT source, max(CASE WHEN reach >= total * 0.95 THEN n_chars END) AS cap FROM r GROUP BY source""")
def read_coverage_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = b.table(spark, sf_dir, "documents").select("source", "n_chars", F.lit(1).alias("n"))
    return stats.coverage_cap(docs, ["source"], "n_chars", "n", 95)


# ---- truncation


@query(f"WITH {b.BINS_SQL} SELECT mate, pos, q1 FROM prof")
def bin_expand_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.profile(spark, sf_dir)


@query("WITH " + b.BINS_SQL.split(", pos AS")[0] + ", caps AS (SELECT DISTINCT sample, mate, (10 + mate * 13)::INT AS cap FROM bins) SELECT b.sample, b.mate, bin_start, least(bin_end, cap)::INT AS bin_end, q1 FROM bins b JOIN caps c ON b.sample = c.sample AND b.mate = c.mate WHERE bin_start <= cap")
def bins_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    bins = b.profile_bins(spark, sf_dir)
    caps = bins.select("sample", "mate", (F.lit(10) + F.col("mate") * 13).alias("cap")).distinct()
    return truncation.cap_bins(bins, caps)


FIRST = "cuts AS (SELECT mate, coalesce(min(CASE WHEN q1 < 29.8 THEN pos END) - 1, max(pos))::INT AS cut, max(pos) AS last_pos FROM prof GROUP BY mate)"


@query(f"WITH {b.BINS_SQL}, {FIRST} SELECT mate, cut, last_pos FROM cuts")
def trunc_first_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.first_drop(b.profile(spark, sf_dir), 29.8)


@query(f"""WITH {b.BINS_SQL}, {FIRST}, tails AS (SELECT p.mate, pos, min(q1) OVER (PARTITION BY p.mate ORDER BY pos) AS run FROM prof p JOIN cuts c ON p.mate = c.mate WHERE pos > cut),
  k AS (SELECT mate, row_number() OVER (ORDER BY run DESC, mate, pos) AS k FROM tails)
  SELECT mate, (cut + (SELECT count(*) FROM k WHERE k.mate = cuts.mate AND k <= 9))::INT AS cut FROM cuts""")
def trunc_raise_alloc(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = b.profile(spark, sf_dir)
    return truncation.raise_cuts(p, truncation.first_drop(p, 29.8), 9)


@query(f"""WITH {b.BINS_SQL}, t AS (SELECT unnest(generate_series(20, 29))::INT AS threshold), c AS (SELECT threshold, mate, coalesce(min(CASE WHEN q1 < threshold THEN pos END) - 1, max(pos)) AS cut FROM prof, t GROUP BY threshold, mate),
  w AS (SELECT threshold, max(CASE WHEN mate = 1 THEN cut END)::INT AS cut1, max(CASE WHEN mate = 2 THEN cut END)::INT AS cut2 FROM c GROUP BY threshold)
  SELECT threshold, cut1, cut2 FROM w WHERE cut1 + cut2 >= 60 ORDER BY threshold DESC LIMIT 1""")
def trunc_relax_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.relax_threshold(b.profile(spark, sf_dir), 30, 20, 60)


# ---- lineages


@query(f"WITH {b.LINEAGES_SQL} SELECT s_suppkey, lineage FROM lin WHERE (lineage LIKE 'k\\_\\_ASIA;%' ESCAPE '\\' OR lineage LIKE 'k\\_\\_EUROPE;%' ESCAPE '\\') AND NOT (lineage LIKE '%;p\\_\\_' || (SELECT min(n_name) FROM sup WHERE r_name = 'ASIA') || ';%' ESCAPE '\\')")
def taxon_keep_discard(spark: SparkSession, sf_dir: str) -> DataFrame:
    drop = b.table(spark, sf_dir, "nation").join(F.broadcast(b.table(spark, sf_dir, "region").where("r_name = 'ASIA'")), F.col("n_regionkey") == F.col("r_regionkey")).agg(F.min("n_name")).first()[0]
    return taxonomy.keep_discard(b.lineages(spark, sf_dir), F.col("lineage"), ["k__ASIA", "k__EUROPE"], f"p__{drop}")


@query(f"""WITH {b.SUPPLIERS_SQL} SELECT s_suppkey, 'g__' || n_name || ';s__' || CASE WHEN s_suppkey % 3 = 0 THEN n_name || ' ' || lower(s_name)
  WHEN s_suppkey % 3 = 1 THEN s_name ELSE n_name || ' x' || lower(s_name) END AS lineage FROM sup""")
def lineage_binomial_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.suppliers(spark, sf_dir)
    m = F.col("s_suppkey") % 3
    species = F.when(m == 0, F.lower("s_name")).when(m == 1, F.col("s_name")).otherwise(F.concat(F.col("n_name"), F.lit(" x"), F.lower("s_name")))
    # A lower-case epithet gets its genus; a capitalised one and one that has it stay.
    given = F.array(F.concat(F.lit("g__"), "n_name"), F.concat(F.lit("s__"), species))
    return rows.select("s_suppkey", F.array_join(lineage.full_binomial(given), ";").alias("lineage"))


@query("""SELECT p_partkey, concat_ws(';', CASE WHEN p_size % 2 = 0 THEN 'k__' || p_type END, CASE WHEN p_size % 3 > 0 THEN 'g__' || p_brand END,
  CASE WHEN p_size % 3 > 0 THEN 's__' || p_brand || ' ' || lower(p_type) END) AS lineage FROM part""")
def lineage_build_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, g = F.when(F.col("p_size") % 2 == 0, F.col("p_type")), F.when(F.col("p_size") % 3 > 0, F.col("p_brand"))
    return b.table(spark, sf_dir, "part").select("p_partkey", lineage.bare_lineage([k, g, F.lower("p_type")], ["k__", "g__", "s__"], 1, 2).alias("lineage"))


@query("""SELECT p_partkey, p_type AS d, p_name AS g, CASE WHEN p_size % 2 = 0 THEN p_brand END AS s,
  concat_ws(';', 'd__' || p_type, 'g__' || p_name, CASE WHEN p_size % 2 = 0 THEN 's__' || p_brand END) AS lineage FROM part""")
def sintax_column_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = F.concat(F.lit("d:"), F.col("p_type"), F.lit(',g:"g__'), F.col("p_name"), F.lit('",junk'), F.when(F.col("p_size") % 2 == 0, F.concat(F.lit(",s: "), "p_brand")).otherwise(F.lit(",s:")))
    ranks = lineage.parse_assignments(accepted, ["d__", "g__", "s__"])
    rows = b.table(spark, sf_dir, "part").select("p_partkey", ranks.alias("m"))
    get = lambda x: F.try_element_at("m", F.lit(x)).alias(x)
    return rows.select("p_partkey", get("d"), get("g"), get("s"), lineage.build_lineage(F.col("m"), ["d", "g", "s"], ["d__", "g__", "s__"]).alias("lineage"))


@query("""SELECT p_partkey, 'tax=d:' || p_type || ',p:' || p_name || ',c:' || p_brand AS ranked, '>' || p_brand || ';' || p_type AS rooted FROM part""")
def header_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    header = F.concat(F.col("p_type"), F.lit("; "), F.col("p_name"), F.lit(";;"), F.col("p_brand"), F.lit(";"))
    root = F.concat(F.lit(">acc"), F.col("p_partkey").cast("string"), F.lit(" Root;"), F.col("p_brand"), F.lit(" [id: 12]"), F.lit(";"), F.col("p_type"), F.lit(" [id: 7]"))
    return b.table(spark, sf_dir, "part").select("p_partkey", lineage.convert_ranked_header(header, ["d", "p", "c", "o", "f", "g"]).alias("ranked"), lineage.convert_root_header(root).alias("rooted"))


@query("SELECT item_id, replace(lower(text), ' ', '_') AS slug, substr(sha256(text || '|' || reverse(text)), 1, 12) AS hash FROM benchmark")
def slug_and_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = b.table(spark, sf_dir, "benchmark")
    return t.select("item_id", lineage.slug(F.col("text")).alias("slug"), lineage.primer_hash(F.col("text"), F.reverse("text")).alias("hash"))


@query("SELECT p_partkey, split_part(split_part(p_name, ' ', 1), '|', 1) || '_' || p_partkey AS rrna, p_brand || '_' || p_partkey AS spacer FROM part")
def extractor_header_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey").cast("string")
    rrna = F.concat(F.lit(">"), F.element_at(F.split("p_name", " "), 1), F.lit("_"), key, F.lit("|SSU Bacterial | x "), "p_type")
    spacer = F.concat(F.lit(">"), F.col("p_brand"), F.lit("_"), key, F.lit(" first|F|ITS2 "), "p_type")
    return b.table(spark, sf_dir, "part").select("p_partkey", lineage.rrna_header_id(rrna).alias("rrna"), lineage.spacer_header_id(spacer).alias("spacer"))


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS no FROM orders")
def sequential_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.numbered_in_order(b.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"]).select("o_orderkey", "no")


@query("""SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN 'QC | raw reads | ' || s_name || '_R1' WHEN 1 THEN 'Primer trim 3'' | ' || s_name WHEN 2 THEN 'Kraken2 | ' || s_name WHEN 3 THEN 'Adapter trim | ' || s_name ELSE s_name END AS sample FROM supplier""")
def report_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey") % 5
    name = F.when(k == 0, F.concat("s_name", F.lit("_R1_raw"))).when(k == 1, F.concat("s_name", F.lit("_after3p_R2"))).when(k == 2, F.concat(F.lit("02.classification | "), "s_name", F.lit("_report"))).when(k == 3, F.concat(F.lit("01.preprocessing | "), "s_name")).otherwise(F.col("s_name"))
    return b.table(spark, sf_dir, "supplier").select("s_suppkey", lineage.rename_sample(name, lineage.RENAMES).alias("sample"))


@query("""WITH c AS (SELECT l_returnflag AS sample, (l_linenumber % 2 + 1)::INT AS mate, max(l_quantity)::INT AS longest, CASE WHEN min(l_suppkey) % 2 = 0 THEN max(l_suppkey)::INT END AS cap FROM lineitem GROUP BY 1, 2), o AS (
  SELECT *, coalesce(cap, longest) AS least, row_number() OVER (PARTITION BY mate ORDER BY coalesce(cap, longest), sample) AS place FROM c) SELECT mate, sample, least AS cap, longest FROM o WHERE place = 1""")
def ceiling_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = b.table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("sample"), (F.col("l_linenumber") % 2 + 1).cast("int").alias("mate"))
    return truncation.ceilings(li.agg(F.max("l_quantity").cast("int").alias("longest"), F.when(F.min("l_suppkey") % 2 == 0, F.max("l_suppkey").cast("int")).alias("cap")))


@query(f"""WITH {b.BINS_SQL}, t AS (SELECT 29.5::DOUBLE - i AS threshold FROM (SELECT unnest(generate_series(1, 10)) AS i)), c AS (SELECT threshold, mate, coalesce(min(CASE WHEN q1 < threshold THEN pos END) - 1, max(pos)) AS cut FROM prof, t GROUP BY threshold, mate),
  w AS (SELECT threshold, max(CASE WHEN mate = 1 THEN cut END)::INT AS cut1, max(CASE WHEN mate = 2 THEN cut END)::INT AS cut2 FROM c GROUP BY threshold)
  SELECT threshold, cut1, cut2 FROM w WHERE cut1 + cut2 >= 60 ORDER BY threshold DESC LIMIT 1""")
def trunc_relax_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thresholds with fractions: the last one tried lies below the floor of 20."""
    return truncation.relax_threshold(b.profile(spark, sf_dir), 29.5, 20, 60)


# ---- trees


@query(f"WITH {b.REPORT_SQL} SELECT sample, idx, parent_idx FROM links")
def tree_parent_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.linked(spark, sf_dir).select("sample", "idx", "parent_idx")


@query(f"WITH {b.REPORT_SQL} SELECT sample, idx, depth, end_idx::BIGINT AS end_idx FROM links")
def tree_subtree_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.linked(spark, sf_dir).select("sample", "idx", "depth", "end_idx")


# Floors at which all four reasons occur in the test trees, and whole nations lose all their taxa.
FLOORS = {"min_distinct": 92, "min_reads": 94, "protect": 0.0112}
VERDICT_SQL = b.REPORT_SQL + """, tot AS (SELECT sample, clade_reads AS classified FROM rep WHERE taxid = '1'), ver AS (
  SELECT r.*, classified, r.clade_reads::DOUBLE / classified AS share,
    CASE WHEN (distinct_minimizers >= 92 AND r.clade_reads >= 94) OR r.clade_reads::DOUBLE / classified > 0.0112 THEN 'keep' ELSE 'prune' END AS decision,
    CASE WHEN distinct_minimizers >= 92 AND r.clade_reads >= 94 THEN 'passed both floors'
         WHEN r.clade_reads::DOUBLE / classified > 0.0112 THEN 'protected: ' || round((r.clade_reads::DOUBLE / classified * 100)::DECIMAL(30, 12), 2)::DECIMAL(20, 2)::VARCHAR || '% of classified reads'
         WHEN distinct_minimizers < 92 THEN 'distinct minimizers ' || distinct_minimizers || ' < 92' ELSE 'clade reads ' || r.clade_reads || ' < 94' END AS reason
  FROM links r JOIN tot t ON r.sample = t.sample WHERE rank = 'S'), mark AS (
  SELECT l.*, EXISTS (SELECT 1 FROM ver v WHERE v.sample = l.sample AND v.idx <= l.idx AND l.idx < v.end_idx AND v.decision = 'prune') AS in_drop,
    EXISTS (SELECT 1 FROM ver v WHERE v.sample = l.sample AND v.idx = l.idx AND v.decision = 'prune') AND NOT EXISTS (SELECT 1 FROM ver v WHERE v.sample = l.sample AND v.idx < l.idx AND l.idx < v.end_idx AND v.decision = 'prune') AS topmost FROM links l), cred AS (
  SELECT sample, parent_idx, sum(clade_reads)::BIGINT AS credit, count(*)::BIGINT AS n_pruned FROM mark WHERE topmost GROUP BY 1, 2)"""


def _marked(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = b.linked(spark, sf_dir)
    return tree.mark(rows, "S", **FLOORS), tree.verdicts(rows, "S", **FLOORS)


@query(f"""WITH {VERDICT_SQL} SELECT sample, taxid, name, rank, clade_reads, direct_reads, total_minimizers, distinct_minimizers, round((total_minimizers::DOUBLE / distinct_minimizers)::DECIMAL(30, 12), 3)::DECIMAL(20, 3)::VARCHAR AS duplicity,
  round((distinct_minimizers::DOUBLE / clade_reads)::DECIMAL(30, 12), 3)::DECIMAL(20, 3)::VARCHAR AS minimizers_per_read, round((share * 100)::DECIMAL(30, 12), 4)::DECIMAL(20, 4)::VARCHAR AS pct_of_classified, decision, reason FROM ver""")
def evidence_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    from taxaspark.sources.sinks import evidence_rows

    return evidence_rows(tree.verdicts(b.report(spark, sf_dir), "S", **FLOORS), with_sample=True)


@query(f"WITH {VERDICT_SQL} SELECT sample, idx, taxid, clade_reads, row_number() OVER (PARTITION BY sample ORDER BY clade_reads DESC, idx)::INT AS place, decision FROM ver")
def evidence_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree.in_evidence_order(tree.verdicts(b.report(spark, sf_dir), "S", **FLOORS)).select("sample", "idx", "taxid", "clade_reads", "place", "decision")


@query(f"WITH {VERDICT_SQL} SELECT sample, parent_idx, credit, n_pruned FROM cred")
def gate_credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree.credits(_marked(spark, sf_dir)[0])


@query(f"""WITH {VERDICT_SQL} SELECT c.sample, c.parent_idx, p.name, c.credit, p.direct_reads FROM cred c JOIN mark p ON c.sample = p.sample AND c.parent_idx = p.idx
  WHERE NOT EXISTS (SELECT 1 FROM mark m WHERE m.sample = c.sample AND m.idx >= p.idx AND m.idx < p.end_idx AND m.rank = 'S' AND NOT m.in_drop)""")
def gate_dead_credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked, _ = _marked(spark, sf_dir)
    return tree.dead_credits(marked, tree.credits(marked))


@query(f"""WITH {VERDICT_SQL} SELECT m.sample, m.idx, m.depth, m.rank, m.taxid, m.name, m.clade_reads, (m.direct_reads + coalesce(c.credit, 0))::BIGINT AS direct_reads FROM mark m
  LEFT JOIN cred c ON c.sample = m.sample AND c.parent_idx = m.idx WHERE NOT m.in_drop""")
def gated_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked, _ = _marked(spark, sf_dir)
    return tree.gated(marked, tree.credits(marked)).select("sample", "idx", "depth", "rank", "taxid", "name", "clade_reads", "direct_reads")


@query(f"""WITH {VERDICT_SQL}, m AS (SELECT sample, count(*) FILTER (in_drop) AS rows_dropped, coalesce(sum(clade_reads) FILTER (topmost), 0)::BIGINT AS reads_pruned FROM mark GROUP BY sample), v AS (
  SELECT sample, count(*) FILTER (decision = 'keep') AS kept, count(*) FILTER (decision = 'prune') AS pruned, sum(clade_reads) AS reads, max(classified) AS classified, coalesce(string_agg(name, '|' ORDER BY name) FILTER (reason LIKE 'protected%'), '') AS protected FROM ver GROUP BY sample)
  SELECT v.sample, kept, pruned, rows_dropped, reads_pruned, round(100.0::DOUBLE * reads_pruned / reads, 6) AS pct_of_rank, round(100.0::DOUBLE * reads_pruned / classified, 6) AS pct_of_all, protected FROM v JOIN m ON v.sample = m.sample""")
def gate_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tree.gate_summary(*_marked(spark, sf_dir))
    return rows.withColumns({"pct_of_rank": F.round("pct_of_rank", 6), "pct_of_all": F.round("pct_of_all", 6), "protected": F.array_join("protected", "|")})


@query(f"WITH {b.REPORT_SQL} SELECT a.sample, a.idx, sum(d.direct_reads)::BIGINT AS reads, sum(CASE WHEN d.rank = 'S' THEN d.total_minimizers ELSE 0 END)::BIGINT AS minimizers FROM links a JOIN rep d ON a.sample = d.sample AND d.idx >= a.idx AND d.idx < a.end_idx GROUP BY 1, 2")
def clade_cumulative_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.linked(spark, sf_dir).withColumn("own", F.when(F.col("rank") == "S", F.col("total_minimizers")).otherwise(0))
    return tree.clade_sums(rows, {"reads": "direct_reads", "minimizers": "own"})


@query(f"""WITH {b.SUPPLIERS_SQL}, x AS (SELECT DISTINCT n_name, r_name, l_partkey FROM lineitem JOIN sup ON l_suppkey = s_suppkey)
  SELECT name, count(DISTINCT l_partkey)::BIGINT AS distinct_parts FROM (SELECT 'n:' || n_name AS name, l_partkey FROM x UNION ALL SELECT 'r:' || r_name, l_partkey FROM x) GROUP BY name""")
def clade_distinct_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = b.table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("s_suppkey"), "l_partkey")
    rows = li.join(b.suppliers(spark, sf_dir), "s_suppkey").select(F.array(F.concat(F.lit("r:"), "r_name"), F.concat(F.lit("n:"), "n_name")).alias("path"), "l_partkey")
    return profiling.distinct_below(rows, [], "path", "l_partkey").where(F.size("node") > 0).select(F.element_at("node", -1).alias("name"), F.col("n").alias("distinct_parts"))


@query()
def clade_distinct_hll(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of each supplier, merged up the tree; tested against the exact counts."""
    li = b.table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.hll_sketch_agg("l_partkey", 14).alias("h"))
    rows = li.join(b.suppliers(spark, sf_dir), "s_suppkey")
    up = rows.select(F.explode(F.array(F.concat(F.lit("n:"), "n_name"), F.concat(F.lit("r:"), "r_name"))).alias("name"), "h")
    return up.groupBy("name").agg(F.hll_sketch_estimate(F.hll_union_agg("h")).alias("distinct_parts"))


@query(f"WITH {b.REPORT_SQL}, f AS (SELECT sample, min(idx) AS idx FROM rep WHERE contains(name, '000000007') GROUP BY sample) SELECT r.sample, r.taxid, r.idx FROM rep r JOIN f ON r.sample = f.sample AND r.idx = f.idx")
def taxid_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree.first_named(b.report(spark, sf_dir), "000000007")


@query(f"""WITH {b.REPORT_SQL}, f AS (SELECT l.* FROM links l WHERE name = (SELECT min(n_name) FROM nation)), ids AS (
  SELECT r.sample, r.taxid FROM rep r JOIN f ON r.sample = f.sample AND r.idx >= f.idx AND r.idx < f.end_idx)
  SELECT l_orderkey, l_linenumber, year(l_shipdate)::VARCHAR AS sample, 's' || l_suppkey AS taxid FROM lineitem JOIN ids ON ids.sample = year(l_shipdate)::VARCHAR AND ids.taxid = 's' || l_suppkey""")
def extract_taxon_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = b.table(spark, sf_dir, "nation").agg(F.min("n_name")).first()[0]
    rows = b.linked(spark, sf_dir)
    taxa = tree.with_descendants(rows, tree.first_named(rows, name))
    li = b.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.year("l_shipdate").cast("string").alias("sample"), F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("taxid"), F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("read_id"))
    return taxonomy.extract_reads(li, taxa, li.select("sample", "read_id", "taxid")).drop("read_id")


@query(f"""WITH {b.REPORT_SQL}, tx AS (SELECT * FROM links WHERE rank = 'S' AND clade_reads >= 15), up AS (
  SELECT t.sample, t.idx, t.taxid, t.name, t.clade_reads AS own, a.idx AS anc, a.direct_reads AS pool FROM tx t JOIN links a ON a.sample = t.sample AND a.idx < t.idx AND t.idx < a.end_idx WHERE a.direct_reads > 0),
  s AS (SELECT sample, anc, sum(own)::DOUBLE AS total FROM up GROUP BY 1, 2)
  SELECT t.sample, t.taxid, t.name, t.clade_reads AS own, round(coalesce((SELECT sum(pool * own::DOUBLE / total) FROM up JOIN s ON up.sample = s.sample AND up.anc = s.anc WHERE up.sample = t.sample AND up.idx = t.idx), 0), 6) AS added FROM tx t""")
def bracken_redistribute(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.linked(spark, sf_dir)
    out = taxonomy.reestimate(rows, "S", rows.select("sample").distinct().withColumn("threshold", F.lit(15)))
    return out.select("sample", "taxid", "name", "own", F.round("added", 6).alias("added"))


# ---- tables


@query(f"WITH {b.LINEAGES_SQL}, {b.COUNTS_SQL} SELECT sample, s_suppkey::VARCHAR AS taxid, sum(n)::DOUBLE AS n, replace(lineage, ';', '; ') AS lineage FROM cnt JOIN lin USING (s_suppkey) GROUP BY sample, s_suppkey, lineage")
def otu_table_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = b.supplier_counts(spark, sf_dir).select("sample", F.col("s_suppkey").cast("string").alias("taxid"), "n")
    taxa = b.lineages(spark, sf_dir).select(F.col("s_suppkey").cast("string").alias("taxid"), F.split("lineage", ";").alias("lineage"))
    return tables.otu_table(counts, taxa)


@query(f"WITH {b.SUPPLIERS_SQL} SELECT n_name, " + ", ".join(f"count(*) FILTER (year(l_shipdate) = {y})::BIGINT AS y{y}" for y in range(1992, 1999)) + " FROM lineitem JOIN sup ON l_suppkey = s_suppkey GROUP BY n_name")
def otu_table_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.supplier_counts(spark, sf_dir).join(b.suppliers(spark, sf_dir), "s_suppkey").select("n_name", F.concat(F.lit("y"), "sample").alias("sample"), "n")
    return tables.widen(rows, "n_name", "sample", [f"y{y}" for y in range(1992, 1999)])


@query("SELECT year(l_shipdate)::VARCHAR AS sample, count(*)::BIGINT AS total FROM lineitem GROUP BY 1")
def seqtab_rowsums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.totals(b.supplier_counts(spark, sf_dir), "sample")


@query("SELECT l_suppkey AS s_suppkey, count(*)::BIGINT AS total FROM lineitem GROUP BY 1")
def seqtab_colsums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.totals(b.supplier_counts(spark, sf_dir), "s_suppkey")


STAGES = ["raw", "typed", "valued", "kept"]


def _stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = b.table(spark, sf_dir, "events").select(F.concat(F.lit("u"), F.col("user_id") % 50).alias("sample"), "event_type", "value")
    kind = F.when(F.col("event_type").isin("click", "view", "purchase"), F.when(F.col("value") > 10, F.when(F.col("value") > 190, 3).otherwise(2)).otherwise(1)).otherwise(0)
    rows = e.withColumn("stage", F.explode(F.slice(F.array(*[F.lit(s) for s in STAGES]), F.lit(1), kind + 1)))
    return rows.groupBy("sample", "stage").agg(F.count("*").alias("n"))


@query("""WITH e AS (SELECT 'u' || (user_id % 50) AS sample, event_type IN ('click', 'view', 'purchase') AS t, value > 10 AS v, value > 190 AS k FROM events)
  SELECT sample, count(*)::VARCHAR AS raw, coalesce(nullif(count(*) FILTER (t), 0)::VARCHAR, 'NA') AS typed, coalesce(nullif(count(*) FILTER (t AND v), 0)::VARCHAR, 'NA') AS valued, coalesce(nullif(count(*) FILTER (t AND v AND k), 0)::VARCHAR, 'NA') AS kept FROM e GROUP BY sample""")
def read_tracking_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = b.table(spark, sf_dir, "events").select(F.concat(F.lit("u"), F.col("user_id") % 50).alias("sample")).distinct()
    return tables.tracking(samples, _stages(spark, sf_dir), STAGES)


@query("""SELECT 'u' || (user_id % 50) AS sample, count(*)::BIGINT AS raw FROM events GROUP BY 1""")
def read_tracking_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = b.table(spark, sf_dir, "events").select(F.concat(F.lit("u"), F.col("user_id") % 50).alias("sample")).distinct()
    return tables.checked_tracking(samples, _stages(spark, sf_dir), ["raw"])


@query("SELECT coalesce(event_type, 'Total read count') AS sample, count(*)::BIGINT AS n FROM events WHERE event_type IS NOT NULL GROUP BY ROLLUP (event_type)")
def read_count_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read_counts(b.table(spark, sf_dir, "events"), "event_type")


@query("""WITH t AS (SELECT p_brand AS sample, p_type AS taxon, count(*)::BIGINT AS n FROM part GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY n DESC, taxon) AS place FROM t)
  SELECT sample, taxon, n, place::INT AS place FROM r WHERE place <= 10""")
def top10_taxa(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.table(spark, sf_dir, "part").select(F.col("p_brand").alias("sample"), F.col("p_type").alias("taxon"), F.lit(1).cast("long").alias("n"))
    return tables.top_taxa(rows, "sample", "taxon")


@query("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 5)")
def semi_filter_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = b.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    return tables.subset(li, b.table(spark, sf_dir, "part").where("p_size <= 5").select(F.col("p_partkey").alias("l_partkey")), "l_partkey")


@query("SELECT DISTINCT 'R' || o_custkey AS \"Run\" FROM orders WHERE o_orderstatus = 'F' AND o_custkey % 7 > 0")
def manifest_paired_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = b.table(spark, sf_dir, "orders")
    runs = o.select(F.when(F.col("o_custkey") % 7 > 0, F.concat(F.lit("R"), "o_custkey")).otherwise("").alias("Run"), F.when(F.col("o_orderstatus") == "F", F.when(F.col("o_orderkey") % 2 == 0, "paired").otherwise("PAIRED")).otherwise("SINGLE").alias("LibraryLayout"))
    return tables.paired_runs(runs)


@query(f"WITH {b.REPORT_SQL} SELECT sample, max(CASE WHEN rank = 'U' THEN clade_reads END) AS unclassified, max(CASE WHEN rank = 'R' THEN clade_reads END) AS classified FROM rep GROUP BY sample")
def report_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree.unclassified_and_root(b.report(spark, sf_dir)).withColumn("unclassified", F.col("unclassified").cast("long"))


@query(f"""WITH {b.REPORT_SQL} SELECT s.sample, s.taxid, string_agg(CASE a.rank WHEN 'P' THEN 'p__' WHEN 'G' THEN 'g__' ELSE 's__' END || a.name, ';' ORDER BY a.idx) AS lineage FROM links s JOIN links a ON a.sample = s.sample AND a.idx <= s.idx AND s.idx < a.end_idx AND a.rank IN ('P', 'G', 'S')
  WHERE s.taxid LIKE 's%' GROUP BY s.sample, s.taxid, s.idx""")
def taxon_lineages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.lineage_of(b.linked(spark, sf_dir), {"P": "p__", "G": "g__", "S": "s__"}).where("taxid LIKE 's%'")
    return rows.withColumn("lineage", F.array_join("lineage", ";"))


@query("SELECT 1 - (sum(CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END)::BIGINT / count(*)) AS fraction FROM lineitem")
def chimera_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = b.table(spark, sf_dir, "lineitem").select("l_returnflag", F.lit(1).alias("n"))
    return tables.chimera_fraction(li, li.where("l_returnflag <> 'R'"))


@query("SELECT s_suppkey, regexp_replace(regexp_replace(s_name, '^Supplier#0*', 'S'), '9$', '_nine') AS sample FROM supplier")
def sample_renames(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [("^Supplier#0*", "S"), ("9$", "_nine")]
    return b.table(spark, sf_dir, "supplier").select("s_suppkey", lineage.rename_sample(F.col("s_name"), rules).alias("sample"))
