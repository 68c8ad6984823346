"""Queries of the sequence operators, on nucleotides made from the documents' letters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaspark.functions import dna, kmers
from taxaspark.operators import alignment, denoising, mapping, profiling, reads, search, tables, taxonomy
from taxaspark.plans import bindings as b
from taxaspark.plans.queries import query

RC = b.REVCOMP.format
KMERS = "list_transform(generate_series(1, length({0}) - {1} + 1), lambda i: substr({0}, i::BIGINT, {1}))".format


@query(f"WITH {b.SEQS_SQL} SELECT doc_id, md5({RC('seq')}) AS revcomp FROM seqs")
def reverse_complement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.seqs(spark, sf_dir).select("doc_id", F.md5(dna.reverse_complement(F.col("seq"))).alias("revcomp"))


@query(f"WITH {b.SEQS_SQL} SELECT doc_id, md5(seq) AS seq FROM seqs UNION ALL SELECT doc_id, md5({RC('seq')}) FROM seqs WHERE doc_id % 3 = 0")
def paired_union_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = b.seqs(spark, sf_dir).select("doc_id", "seq")
    turned = s.where("doc_id % 3 = 0").withColumn("seq", dna.reverse_complement(F.col("seq")))
    return s.unionByName(turned).withColumn("seq", F.md5("seq"))


@query(f"WITH {b.SEQS_SQL}, k AS (SELECT unnest({KMERS('seq', 8)}) AS kmer FROM seqs WHERE length(seq) >= 8) SELECT kmer, count(*)::BIGINT AS n FROM k GROUP BY kmer")
def kmer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmers.kmer_rows(b.seqs(spark, sf_dir), [], 8).groupBy("kmer").agg(F.count("*").alias("n")).withColumn("kmer", kmers.text(F.col("kmer"), 8))


@query(f"WITH {b.SEQS_SQL}, k AS (SELECT DISTINCT doc_id, unnest({KMERS('seq', 8)}) AS kmer FROM seqs WHERE length(seq) >= 8) SELECT doc_id, count(DISTINCT least(kmer, {RC('kmer')}))::BIGINT AS n FROM k GROUP BY doc_id")
def kmer_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmers.distinct_numbers(b.seqs(spark, sf_dir).where(F.length("seq") >= 8), ["doc_id"], 8, canonical=True)


@query(f"""WITH {b.SEQS_SQL}, p AS (SELECT doc_id, seq, unnest(generate_series(1, length(seq) - 11)) AS i FROM seqs WHERE length(seq) >= 12)
  SELECT doc_id, i::INT AS pos, list_min(list_transform(generate_series(i, i + 5), lambda j: substr(seq, j::BIGINT, 7))) AS minimizer FROM p""")
def minimizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmers.least_rows(b.seqs(spark, sf_dir), ["doc_id"], 12, 7)


@query(f"WITH {b.SEQS_SQL} SELECT sample, md5(seq) AS seq, count(*)::BIGINT AS n FROM seqs GROUP BY sample, seqs.seq")
def dereplicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.dereplicate(b.seqs(spark, sf_dir), ["sample"], "seq").withColumn("seq", F.md5("seq"))


@query(f"""WITH {b.SEQS_SQL}, t AS (SELECT seq, count(*)::BIGINT AS total FROM seqs GROUP BY seq)
  SELECT row_number() OVER (ORDER BY total DESC, seq) AS asv_no, 'ASV_' || row_number() OVER (ORDER BY total DESC, seq) AS asv_id, md5(seq) AS seq, total FROM t""")
def sequence_table_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.sequence_table(reads.dereplicate(b.seqs(spark, sf_dir), ["sample"], "seq")).withColumn("seq", F.md5("seq"))


@query(f"""WITH {b.SEQS_SQL}, s AS (SELECT 'ASV_' || doc_id AS asv_id, doc_id, substr(seq, 11) AS seq FROM seqs WHERE length(seq) > 30)
  SELECT 'ASV_' || min(doc_id) AS representative, string_agg(asv_id, ',' ORDER BY doc_id) AS merged_asvs, count(*)::INT AS n_merged, length(seq)::INT AS extracted_length, md5(seq) AS seq FROM s GROUP BY s.seq""")
def collapse_identical(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = b.seqs(spark, sf_dir).where(F.length("seq") > 30).select(F.concat(F.lit("ASV_"), F.col("doc_id").cast("string")).alias("asv_id"), F.substr("seq", F.lit(11)).alias("seq"))
    return tables.collapse_identical(s).withColumn("seq", F.md5("seq"))


@query(f"""WITH {b.SEQS_SQL}, s AS (SELECT 'ASV_' || doc_id AS asv_id, doc_id, sample, length(seq)::BIGINT AS n, substr(seq, 11) AS seq FROM seqs WHERE length(seq) > 30), r AS (SELECT seq, 'ASV_' || min(doc_id) AS rep FROM s GROUP BY seq)
  SELECT sample, rep AS asv_id, sum(n)::BIGINT AS n FROM s JOIN r ON s.seq = r.seq GROUP BY 1, 2""")
def collapse_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = b.seqs(spark, sf_dir).where(F.length("seq") > 30).select("sample", F.concat(F.lit("ASV_"), F.col("doc_id").cast("string")).alias("asv_id"), F.length("seq").cast("long").alias("n"), F.substr("seq", F.lit(11)).alias("seq"))
    return tables.collapse_counts(s.select("sample", "asv_id", "n"), s.select("asv_id", "seq"))


@query(f"WITH {b.SEQS_SQL}, c AS (SELECT DISTINCT seq, (length(seq) - length(replace(seq, 'G', '')) + length(seq) - length(replace(seq, 'C', '')))::INT AS gc FROM seqs) SELECT doc_id, gc FROM seqs s JOIN c ON s.seq = c.seq")
def classify_unique_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    count = lambda d: d.withColumn("gc", F.length(F.regexp_replace("seq", "[^GC]", "")))
    return taxonomy.classify_unique(b.seqs(spark, sf_dir).select("doc_id", "seq"), "seq", count).select("doc_id", "gc")


@query(f"""WITH {b.SEQS_SQL}, r AS (SELECT {b.DNA} AS seq FROM benchmark), r2 AS (SELECT seq FROM r UNION ALL SELECT {RC('seq')} FROM r), rk AS (SELECT DISTINCT unnest({KMERS('seq', 31)}) AS kmer FROM r2 WHERE length(seq) >= 31),
  dk AS (SELECT DISTINCT doc_id, unnest({KMERS('seq', 31)}) AS kmer FROM seqs WHERE length(seq) >= 31) SELECT doc_id FROM seqs WHERE doc_id NOT IN (SELECT doc_id FROM dk JOIN rk USING (kmer))""")
def contaminant_kmer_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = b.table(spark, sf_dir, "benchmark").select(dna.pseudo_dna(F.col("text")).alias("seq"))
    return reads.remove_contaminants(b.seqs(spark, sf_dir).withColumn("read_id", F.col("doc_id")), refs).select("doc_id")


FWD, REV = "GTRC", "ACYG"


@query(f"""WITH {b.SEQS_SQL}, p AS (SELECT doc_id, regexp_extract(seq, '^(.*?)GT[AG]C(.*)$', 2) AS t FROM seqs WHERE regexp_matches(seq, 'GT[AG]C')) SELECT doc_id, length(t)::INT AS length, md5(t) AS seq FROM p WHERE length(t) >= 50""")
def primer_trim_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = b.seqs(spark, sf_dir).withColumn("_at", reads.find_primer(F.col("seq"), FWD, 0)).where("_at IS NOT NULL")
    s = s.withColumn("seq", F.substr("seq", (F.col("_at") + len(FWD)).cast("int"))).where(F.length("seq") >= 50)
    return s.select("doc_id", F.length("seq").alias("length"), F.md5("seq").alias("seq"))


@query(f"""WITH {b.SEQS_SQL}, p AS (SELECT doc_id, regexp_extract(seq, '^(.*?)GT[AG]C(.*)$', 2) AS t FROM seqs WHERE regexp_matches(seq, 'GT[AG]C')), q AS (
  SELECT doc_id, regexp_extract(t, '^(.*?)C[AG]GT', 1) AS u FROM p WHERE regexp_matches(t, 'C[AG]GT')) SELECT doc_id, length(u)::INT AS length FROM q WHERE length(u) >= 30""")
def in_silico_pcr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.in_silico_pcr(b.seqs(spark, sf_dir), FWD, REV, 0.0).select("doc_id", F.length("seq").alias("length"))


def _tiles_sql(length: int, where: str = "true") -> str:
    return f"cuts AS (SELECT doc_id, sample, seq, unnest(generate_series(0, (length(seq) - 1) // {length})) AS tile FROM seqs WHERE length(seq) > 0), tiles AS (SELECT doc_id, sample, tile::INT AS tile, substr(seq, (tile * {length} + 1)::BIGINT, {length}) AS seq FROM cuts), reads AS (SELECT * FROM tiles WHERE {where})"


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read pairs of 80 bases from both ends of every fragment of 100 bases, with qualities from the letters."""
    s = b.tiles(spark, sf_dir, 100, True, quality=True)
    turned = np.frombuffer(bytes.maketrans(b"ACGT", b"TGCA"), np.uint8)

    def mates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            seq, qual = (dna.flat(x.column(c))[0].reshape(-1, 100) for c in ("seq", "qual"))
            reads_ = (seq[:, :80], qual[:, :80]), (turned[seq[:, :19:-1]], qual[:, :19:-1])
            yield pa.RecordBatch.from_arrays([*(x.column(c) for c in ("doc_id", "tile", "sample")), *(pa.StructArray.from_arrays([dna.fixed(y) for y in r], ["seq", "qual"]) for r in reads_)], ["doc_id", "tile", "sample", "r1", "r2"])

    kinds = {f.name: f.dataType.simpleString() for f in s.schema.fields}
    return s.mapInArrow(mates, f"doc_id {kinds['doc_id']}, tile int, sample {kinds['sample']}, r1 struct<seq: string, qual: string>, r2 struct<seq: string, qual: string>")


@query(f"""WITH {b.SEQS_SQL}, {_tiles_sql(100, "length(seq) = 100")}, p AS (SELECT doc_id, tile, translate(seq, 'ACGT', 'I?5+') AS q FROM reads),
  e AS (SELECT doc_id, tile, list_sum(list_transform(generate_series(1, 60), lambda i: pow(10.0, -(ascii(substr(q, i::BIGINT, 1)) - 33) / 10.0))) AS ee1, list_sum(list_transform(generate_series(51, 100), lambda i: pow(10.0, -(ascii(substr(q, i::BIGINT, 1)) - 33) / 10.0))) AS ee2 FROM p)
  SELECT doc_id, tile, round(ee1, 6) AS ee1, round(ee2, 6) AS ee2 FROM e WHERE ee1 <= 2 AND ee2 <= 5""")
def expected_error_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reads.filter_pairs(_pairs(spark, sf_dir), (60, 50), errors=True)
    return rows.select("doc_id", "tile", F.round("ee1", 6).alias("ee1"), F.round("ee2", 6).alias("ee2"))


@query(f"""WITH {b.SEQS_SQL}, {_tiles_sql(100, "length(seq) = 100")}, p AS (SELECT doc_id, tile, substr(seq, 1, 80) AS a, substr(seq, 21, 80) AS c FROM reads),
  m AS (SELECT doc_id, tile, a, c, list_max(list_filter(generate_series(12, 80), lambda n: right(a, n::BIGINT) = left(c, n::BIGINT))) AS overlap FROM p) SELECT doc_id, tile, overlap::INT AS overlap, a || substr(c, overlap::BIGINT + 1) AS merged FROM m WHERE overlap IS NOT NULL""")
def merge_pairs_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.merge_pairs(_pairs(spark, sf_dir)).select("doc_id", "tile", "overlap", "merged")


def _short(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of short reads: all sequences as reads of 6 bases, so that chimeras occur."""
    return b.tiles(spark, sf_dir, 6, True).groupBy("sample", "seq").agg(F.count("*").alias("n"))


SHORT_SQL = f"{b.SEQS_SQL}, {_tiles_sql(6, 'length(seq) = 6')}, t AS (SELECT sample, seq, count(*)::BIGINT AS n FROM reads GROUP BY 1, 2)"


@query(f"""WITH {SHORT_SQL}, i AS (SELECT unnest([1, 2, 3, 4, 5]) AS i), l AS (SELECT sample, i, left(seq, i) AS part, max(n) AS n FROM t, i GROUP BY 1, 2, 3), r AS (SELECT sample, i, substr(seq, i + 1) AS part, max(n) AS n FROM t, i GROUP BY 1, 2, 3),
  f AS (SELECT DISTINCT c.sample, c.seq FROM (SELECT t.*, i.i FROM t, i) c JOIN l ON l.sample = c.sample AND l.i = c.i AND l.part = left(c.seq, c.i) JOIN r ON r.sample = c.sample AND r.i = c.i AND r.part = substr(c.seq, c.i + 1) WHERE l.n >= 4 * c.n AND r.n >= 4 * c.n),
  v AS (SELECT t.seq, count(*) AS n_samples, count(f.seq) AS n_flagged FROM t LEFT JOIN f ON t.sample = f.sample AND t.seq = f.seq GROUP BY t.seq)
  SELECT seq, n_samples::BIGINT AS n_samples, n_flagged::BIGINT AS n_flagged, n_flagged = n_samples OR (n_flagged > 0 AND n_flagged >= (n_samples - 1) * 0.9) AS is_bimera FROM v""")
def bimera_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A parent is at least four times as abundant as the child, so it is another sequence."""
    return reads.bimeras(_short(spark, sf_dir))


@query(f"""WITH RECURSIVE {SHORT_SQL}, c AS (SELECT a.sample, a.seq, max(struct_pack(n := p.n, s := p.seq)).s AS centre FROM t a JOIN t p ON a.sample = p.sample AND hamming(a.seq, p.seq) = 1 AND p.n >= 3 * a.n GROUP BY 1, 2),
  w AS (SELECT sample, seq, seq AS here FROM t UNION ALL SELECT w.sample, w.seq, c.centre FROM w JOIN c ON c.sample = w.sample AND c.seq = w.here),
  e AS (SELECT sample, seq, here FROM w WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.sample = w.sample AND c.seq = w.here))
  SELECT t.sample, t.seq, n, here AS centre FROM t JOIN e ON t.sample = e.sample AND t.seq = e.seq""")
def denoise_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.denoise(_short(spark, sf_dir), 3.0).select("sample", "seq", "n", "centre")


@query(f"""WITH {b.SEQS_SQL}, {_tiles_sql(50)}, p AS (SELECT sample, translate(seq, 'ACGT', 'I?5+') AS q, unnest(generate_series(1, length(seq))) AS pos FROM reads), v AS (SELECT sample, pos, ascii(substr(q, pos::BIGINT, 1)) - 33 AS v FROM p)
  SELECT sample, pos::INT AS pos, quantile_cont(v, 0.25) AS q1, median(v) AS median, count(*)::BIGINT AS n FROM v GROUP BY 1, 2""")
def base_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sequences as reads of 50 cycles."""
    return reads.base_profile(b.tiles(spark, sf_dir, 50, quality=True).select("sample", "qual"), ["sample"], "qual")


def _refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items as references with a three-rank lineage."""
    t = b.table(spark, sf_dir, "benchmark")
    path = F.array(F.lit("d0"), F.concat(F.lit("g"), (F.col("item_id") % 5).cast("string")), F.concat(F.lit("s"), F.col("item_id").cast("string")))
    return t.select(F.col("item_id").alias("ref_id"), dna.pseudo_dna(F.col("text")).alias("seq"), path.alias("path"), path.alias("lineage"), F.concat(F.lit("g"), (F.col("item_id") % 5).cast("string")).alias("genus"), F.concat(F.lit("s"), F.col("item_id").cast("string")).alias("species"))


@query()
def kmer_lca_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compared with a per-read computation in the tests."""
    queries = b.seqs(spark, sf_dir).select(F.col("doc_id").alias("read_id"), "seq")
    out = taxonomy.classify_reads(queries, taxonomy.kmer_database(_refs(spark, sf_dir), 31, 25), 31, 25, 0.02, 1)
    return out.withColumn("path", F.array_join("path", ";"))


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries: the benchmark's items, those with an odd id as their reverse complement."""
    seq = dna.pseudo_dna(F.col("text"))
    return b.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.when(F.col("item_id") % 2 == 1, dna.reverse_complement(seq)).otherwise(seq).alias("seq"), F.concat(F.lit("g"), (F.col("item_id") % 5).cast("string")).alias("genus"))


ITEMS_SQL = f"r AS (SELECT item_id, {b.DNA} AS seq FROM benchmark), i AS (SELECT item_id, CASE WHEN item_id % 2 = 1 THEN {RC('seq')} ELSE seq END AS seq FROM r)"
WORDS_SQL = f"{ITEMS_SQL}, k AS (SELECT DISTINCT item_id, unnest({KMERS('seq', 8)}) AS kmer FROM r WHERE length(seq) >= 8), q AS (SELECT DISTINCT item_id, unnest({KMERS('seq', 8)}) AS kmer FROM i WHERE length(seq) >= 8)"


@query(f"WITH {WORDS_SQL} SELECT q.item_id AS query_id, k.item_id AS ref_id, count(*)::BIGINT AS shared FROM q JOIN k ON q.kmer = k.kmer GROUP BY 1, 2")
def shared_kmer_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxonomy.shared_kmers(_items(spark, sf_dir), _refs(spark, sf_dir))


@query(f"""WITH {WORDS_SQL}, s AS (SELECT q.item_id, k.item_id AS ref, count(*) AS n FROM q JOIN k USING (kmer) GROUP BY 1, 2), o AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY n DESC, ref) AS place FROM s)
  SELECT item_id AS query_id, ref AS ref_id, n::BIGINT AS shared FROM o WHERE place = 1""")
def nearest_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.nearest(_items(spark, sf_dir), _refs(spark, sf_dir)).drop("strand")


@query(f"""WITH {WORDS_SQL}, m AS (SELECT DISTINCT item_id, unnest({KMERS(RC('seq'), 8)}) AS kmer FROM i WHERE length(seq) >= 8), sp AS (SELECT q.item_id, k.item_id AS ref, count(*) AS n FROM q JOIN k USING (kmer) GROUP BY 1, 2), sm AS (SELECT m.item_id, k.item_id AS ref, count(*) AS n FROM m JOIN k USING (kmer) GROUP BY 1, 2),
  bp AS (SELECT item_id, max(n) AS n FROM sp GROUP BY 1), bm AS (SELECT item_id, max(n) AS n FROM sm GROUP BY 1) SELECT i.item_id AS query_id, md5(CASE WHEN coalesce(bm.n, 0) > coalesce(bp.n, 0) THEN {RC('i.seq')} ELSE i.seq END) AS seq FROM i LEFT JOIN bp ON bp.item_id = i.item_id LEFT JOIN bm ON bm.item_id = i.item_id""")
def better_strand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxonomy.better_strand(_items(spark, sf_dir), _refs(spark, sf_dir)).withColumn("seq", F.md5("seq"))


@query(f"""WITH r AS (SELECT item_id, {b.DNA} AS seq FROM benchmark), k AS (SELECT DISTINCT item_id, unnest({KMERS('seq', 8)}) AS kmer FROM r WHERE length(seq) >= 8),
  q AS (SELECT * FROM k), t AS (SELECT item_id, kmer, unnest(generate_series(1, 20)) AS rnd FROM q),
  o AS (SELECT *, row_number() OVER (PARTITION BY item_id, rnd ORDER BY md5('1:' || item_id || ':' || rnd || ':' || kmer), kmer) AS o FROM t), h AS (
  SELECT o.item_id, rnd, k.item_id AS ref, count(*) AS n FROM o JOIN k ON o.kmer = k.kmer WHERE o <= 32 GROUP BY 1, 2, 3), bst AS (SELECT item_id, rnd, ref, row_number() OVER (PARTITION BY item_id, rnd ORDER BY n DESC, ref) AS place FROM h),
  v AS (SELECT item_id, rank_no, CASE rank_no WHEN 0 THEN 'd0' WHEN 1 THEN 'd0;g' || ref % 5 ELSE 'd0;g' || ref % 5 || ';s' || ref END AS prefix, count(*) AS n FROM bst, (SELECT unnest([0, 1, 2]) AS rank_no) WHERE place = 1 GROUP BY 1, 2, 3),
  w AS (SELECT *, row_number() OVER (PARTITION BY item_id, rank_no ORDER BY n DESC, prefix DESC) AS place FROM v)
  SELECT item_id AS query_id, rank_no::INT AS rank_no, split_part(prefix, ';', (rank_no + 1)::BIGINT) AS taxon, n / 20.0::DOUBLE AS confidence FROM w WHERE place = 1""")
def sintax_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both strands: items that come turned vote as they stand in the references."""
    return taxonomy.bootstrap_vote(_items(spark, sf_dir), _refs(spark, sf_dir), rounds=20, both_strands=True)


@query(f"""WITH {WORDS_SQL}, g AS (SELECT item_id % 5 AS g, count(*) AS m FROM r GROUP BY 1), p AS (SELECT kmer, (count(*) + 0.5::DOUBLE) / ((SELECT count(*) FROM r) + 1) AS p FROM k GROUP BY kmer), h AS (SELECT item_id % 5 AS g, kmer, count(*) AS n FROM k GROUP BY 1, 2),
  base AS (SELECT item_id, sum(ln(p)) AS base, count(*) AS n FROM q JOIN p USING (kmer) GROUP BY 1), met AS (SELECT item_id, h.g, sum(ln((h.n + p) / (m + 1)) - ln(p)) AS gain, count(*) AS hit, any_value(m) AS m FROM q JOIN h USING (kmer) JOIN p USING (kmer) JOIN g ON g.g = h.g GROUP BY 1, 2),
  s AS (SELECT item_id, round(base + gain - (n - hit) * ln(m + 1.0::DOUBLE), 6) AS score, 'g' || g AS genus FROM met JOIN base USING (item_id)), o AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, genus DESC) AS place FROM s)
  SELECT item_id AS query_id, genus, score FROM o WHERE place = 1""")
def rdp_naive_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxonomy.naive_bayes(_items(spark, sf_dir), _refs(spark, sf_dir))


@query()
def rdp_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Draws by a hash that SQL hasn't; the tests try known answers on both strands."""
    refs = _refs(spark, sf_dir).withColumn("lineage", F.slice("lineage", 1, 2))
    return taxonomy.bootstrap_bayes(_items(spark, sf_dir), refs, rounds=20, try_reverse=True)


@query(f"""WITH {ITEMS_SQL}, q AS (SELECT item_id, item_id % 5 AS g, seq FROM i)
  SELECT q.item_id AS query_id, 's' || min(r.item_id) AS species FROM q JOIN r ON r.item_id % 5 = g AND (contains(r.seq, q.seq) OR contains(r.seq, {RC('q.seq')})) WHERE length(q.seq) >= 16 GROUP BY q.item_id HAVING count(DISTINCT r.item_id) = 1""")
def add_species_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxonomy.add_species(_items(spark, sf_dir), _refs(spark, sf_dir))


@query(f"WITH {b.SEQS_SQL}, c AS (SELECT doc_id FROM documents WHERE lang IS NOT NULL) SELECT doc_id, length(seq)::INT AS length FROM seqs WHERE doc_id IN (SELECT doc_id FROM c)")
def classified_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = b.seqs(spark, sf_dir).withColumnRenamed("doc_id", "read_id")
    calls = b.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("read_id"), F.col("lang").alias("taxon"))
    return taxonomy.classified_reads(own, calls).select(F.col("read_id").alias("doc_id"), F.length("seq").alias("length"))


@query(f"WITH {b.SEQS_SQL}, g AS (SELECT seq, count(*) AS n FROM seqs GROUP BY seq) SELECT sum(n)::BIGINT AS extracted, count(*) AS groups, count(*) FILTER (n > 1) AS collapsed_groups, sum(n - 1)::BIGINT AS dropped FROM g")
def collapse_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.collapse_counters(b.seqs(spark, sf_dir))


@query(f"WITH {b.SEQS_SQL} SELECT sample, md5(seq) AS seq, length(seq)::BIGINT AS n FROM seqs WHERE doc_id % 3 > 0")
def relabel_by_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = b.seqs(spark, sf_dir).withColumn("asv_id", F.concat(F.lit("ASV_"), F.col("doc_id").cast("string")))
    counts = s.select("sample", "asv_id", F.length("seq").cast("long").alias("n"))
    return tables.by_sequence(counts, s.where("doc_id % 3 > 0")).withColumn("seq", F.md5("seq"))


@query()
def primer_gapped_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forward primer with a fifth of its bases wrong, gaps included, cut off at the end or whole, in all sequences as reads of 100 bases; the tests compare with a plain programme."""
    rows = b.tiles(spark, sf_dir, 100).withColumn("at", alignment.primer_span(F.col("seq"), FWD, 0.2, 3)).where("at IS NOT NULL")
    return rows.select("doc_id", "tile", "at.start", "at.stop", "at.errors")


@query()
def merge_pairs_gapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mates merged by alignment with up to one mismatch or gap; the tests compare with a plain programme."""
    return alignment.merge_pairs_aligned(_pairs(spark, sf_dir), max_mismatch=1, trim_overhang=True).select("doc_id", "tile", "overlap", "errors", "merged")


@query()
def denoise_error_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sequences as reads of 6 bases, rates learned from all of them in one round; the tests compare with a plain implementation."""
    rows = b.tiles(spark, sf_dir, 6, True, quality=True).select("sample", "seq", "qual")
    return denoising.denoise_reads(rows, rounds=1)


CALLS_SQL = f"""{b.SUPPLIERS_SQL}, line AS (SELECT year(l_shipdate)::VARCHAR AS sample, 'r' || r_regionkey AS r, 'n' || n_nationkey AS n, 's' || s_suppkey AS s, l_partkey, CASE WHEN l_linenumber = 7 THEN 0 WHEN l_partkey % 3 = 0 THEN 2 ELSE 3 END AS level FROM lineitem JOIN sup ON l_suppkey = s_suppkey)"""


def _calls(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Lines as reads of their ship year, called by supplier or nation, and their parts as minimizers."""
    taxa = b.suppliers(spark, sf_dir).select("s_suppkey", F.array(*[F.concat(F.lit(x), F.col(c).cast("string")) for x, c in (("r", "r_regionkey"), ("n", "n_nationkey"), ("s", "s_suppkey"))]).alias("path"))
    lines = b.table(spark, sf_dir, "lineitem").join(taxa, F.col("l_suppkey") == F.col("s_suppkey")).withColumn("sample", F.year("l_shipdate").cast("string"))
    level = F.when(F.col("l_linenumber") == 7, 0).when(F.col("l_partkey") % 3 == 0, 2).otherwise(3)
    return lines.select("sample", F.col("l_orderkey").alias("read_id"), F.slice("path", F.lit(1), level).alias("path")), lines.select("sample", "path", F.col("l_partkey").alias("minimizer"))


@query(f"""WITH {CALLS_SQL}, node AS (
  SELECT sample, 0 AS depth, NULL AS r, NULL AS n, NULL AS s, count(*) FILTER (level > 0) AS clade, 0 AS direct, count(*) AS m, count(DISTINCT l_partkey) AS d FROM line GROUP BY sample
  UNION ALL SELECT sample, 1, r, NULL, NULL, count(*) FILTER (level >= 1), 0, count(*), count(DISTINCT l_partkey) FROM line GROUP BY sample, r
  UNION ALL SELECT sample, 2, r, n, NULL, count(*) FILTER (level >= 2), count(*) FILTER (level = 2), count(*), count(DISTINCT l_partkey) FROM line GROUP BY sample, r, n
  UNION ALL SELECT sample, 3, r, n, s, count(*) FILTER (level >= 3), count(*) FILTER (level = 3), count(*), count(DISTINCT l_partkey) FROM line GROUP BY sample, r, n, s),
  placed AS (SELECT node.*, a.clade AS rc, c.clade AS nc FROM node LEFT JOIN node a ON a.sample = node.sample AND a.depth = 1 AND a.r = node.r LEFT JOIN node c ON c.sample = node.sample AND c.depth = 2 AND c.n = node.n WHERE node.clade > 0),
  every AS (SELECT sample, depth, rc, r, nc, n, clade AS sc, s, clade, direct, m, d FROM placed UNION ALL SELECT sample, -1, NULL, NULL, NULL, NULL, NULL, NULL, count(*), count(*), 0, 0 FROM line WHERE level = 0 GROUP BY sample)
  SELECT sample, row_number() OVER (PARTITION BY sample ORDER BY depth >= 0, rc DESC NULLS FIRST, r NULLS FIRST, nc DESC NULLS FIRST, n NULLS FIRST, CASE WHEN depth = 3 THEN sc END DESC NULLS FIRST, s NULLS FIRST) - 1 AS idx, greatest(depth, 0)::INT AS depth, clade::BIGINT AS clade_reads, direct::BIGINT AS direct_reads, m::BIGINT AS total_minimizers, d::BIGINT AS distinct_minimizers,
    CASE depth WHEN -1 THEN 'U' WHEN 0 THEN 'R' WHEN 1 THEN 'P' WHEN 2 THEN 'G' ELSE 'S' END AS rank, CASE depth WHEN -1 THEN '0' WHEN 0 THEN '1' ELSE coalesce(s, n, r) END AS taxid FROM every""")
def report_from_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.report(*_calls(spark, sf_dir), ranks=("P", "G", "S"), exact=True).drop("pct", "name")


@query()
def report_of_own_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents classified by the benchmark's k-mers, and the report of these calls with sketches; the tests compare sketches with exact counts."""
    queries = b.seqs(spark, sf_dir).select("sample", F.col("doc_id").alias("read_id"), "seq")
    database = taxonomy.kmer_database(_refs(spark, sf_dir), 31, 25)
    calls = taxonomy.classify_reads(queries, database, 31, 25, 0.02, 1).join(queries.select("read_id", "sample"), "read_id")
    return profiling.report(calls, profiling.minimizer_hits(queries, database, 31, 25), ranks=("D", "G", "S"))


@query()
def kmer_read_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All reads of 50 bases of the benchmark's items; the tests compare with calling every window."""
    refs = _refs(spark, sf_dir)
    return profiling.kmer_distribution(refs, taxonomy.kmer_database(refs, 21, 17), 50, 21, 17, 3)


@query()
def reads_mapped_gapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sequences as reads of 100 bases, mapped to the benchmark's items with gaps; the tests compare with planted places and plain edit distances."""
    rows = b.tiles(spark, sf_dir, 100).select(F.struct("doc_id", "tile").alias("read_id"), "seq")
    out = mapping.map_reads(rows, _refs(spark, sf_dir).select("ref_id", "seq"), min_identity=0.9)
    return out.select("read_id.doc_id", "read_id.tile", "ref_id", "strand", "start", "edits", "identity")
