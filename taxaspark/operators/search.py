"""Exact search for the reference that shares most k-mers with a set of them, by bounds instead of all pairs.

The k-mers of a set are read rarest first. A reference that isn't in the postings of the first p of n
k-mers shares at most n - p of them, so once some reference is known to share B, only the rarest
n - B + 1 postings can name one that does as well; the others, among them the k-mers that nearly every
reference has, are never expanded. What the postings name often enough is counted exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaspark.functions import dna, kmers
from taxaspark.operators.joins import settle


def postings(index: DataFrame, block: int) -> DataFrame:
    """(kmer, parts, part, ref_ids): the references of each k-mer in blocks of about ``block``; ``index`` has (ref_id, kmer)."""
    parts = index.groupBy("kmer").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    dealt = index.join(parts, "kmer").withColumn("part", F.pmod(F.xxhash64("ref_id"), F.col("parts")).cast("int"))
    return dealt.groupBy("kmer", "parts", "part").agg(F.collect_list("ref_id").alias("ref_ids"))


def _named(sets: DataFrame, lists: DataFrame, lead: Column) -> DataFrame:
    """(g, s, ref_id, met): how many of a set's first ``lead`` k-mers each reference has."""
    words = sets.select("g", "s", F.explode(F.slice("words", F.lit(1), lead)).alias("w"))
    dealt = words.select("g", "s", F.col("w.kmer").alias("kmer"), F.explode(F.sequence(F.lit(0), F.col("w.parts") - 1)).alias("part"))
    met = dealt.join(lists, ["kmer", "part"]).select("g", "s", F.explode("ref_ids").alias("ref_id"))
    return met.groupBy("g", "s", "ref_id").agg(F.count("*").alias("met"))


def best_shared(sets: DataFrame, refs: DataFrame, k: int, block: int = 4096, few: int = 20_000_000) -> DataFrame:
    """(g, s, ref_id, shared): of every group the set and the reference that share most k-mers.

    ``sets`` has g (the group, of any type), s (number of the set in its group) and words (distinct k-mer
    codes), unique by (g, s); ``refs`` has ref_id, unique, and seq. Of equal pairs that of the smallest s comes
    first, then that of the smallest ref_id. Groups that share no k-mer with any reference, and
    those whose g is null, have no row.

    A first pass reads an eighth of each set's postings and counts the best reference they name exactly;
    the best count of the group is the bound of the second. A set that is too small to reach it is done. Where all
    postings of all sets together name at most ``few`` references, bounds cost more than they save
    and all are counted; the rows are the same.
    """
    index = kmers.kmer_rows(refs, ["ref_id"], k, distinct=True)
    lists = settle(postings(index, block))
    known = lists.groupBy("kmer").agg(F.sum(F.size("ref_ids")).alias("n"), F.first("parts").alias("parts"))
    words = sets.where("g IS NOT NULL").select("g", "s", F.explode("words").alias("kmer")).join(known, "kmer")
    rare = F.transform(F.sort_array(F.collect_list(F.struct("n", "kmer", "parts"))), lambda w: F.struct(w["kmer"].alias("kmer"), w["parts"].alias("parts")))
    own = settle(words.groupBy("g", "s").agg(rare.alias("words"), F.sum("n").alias("named")).withColumn("n", F.size("words")))

    def best(scored: DataFrame) -> DataFrame:
        least = scored.groupBy("g").agg(F.min(F.struct((-F.col("shared")).alias("less"), "s", "ref_id")).alias("b"))
        return least.select("g", "b.s", "b.ref_id", (-F.col("b.less")).cast("long").alias("shared"))

    if (own.agg(F.sum("named")).first()[0] or 0) <= few:
        # Small as the sets are, what they name isn't: all cores share it.
        dealt = own.repartition(own.sparkSession.sparkContext.defaultParallelism)
        return best(_named(dealt, lists, F.col("n")).withColumnRenamed("met", "shared"))
    whole = settle(index.groupBy("ref_id").agg(F.collect_list("kmer").alias("ks")))

    def counted(candidates: DataFrame) -> DataFrame:
        both = candidates.join(whole, "ref_id").join(own.select("g", "s", "words"), ["g", "s"])
        return both.select("g", "s", "ref_id", F.size(F.array_intersect(F.transform("words", lambda w: w["kmer"]), "ks")).alias("shared"))

    eighth = F.ceil(F.col("n") / 8).cast("int")
    first = _named(own, lists, F.least("n", F.greatest(F.lit(8), eighth))).groupBy("g", "s").agg(F.max_by("ref_id", F.struct("met", "ref_id")).alias("ref_id"))
    bound = counted(first).groupBy("g").agg(F.max("shared").alias("bound"))
    # An eighth more than needed is read, so that fewer references have to be counted.
    lead = F.least("n", F.col("n") - F.col("bound") + 1 + eighth)
    able = settle(own.join(bound, "g").where("n >= bound").withColumn("lead", lead))
    named = _named(able, lists, F.col("lead")).join(able.select("g", "s", (F.col("bound") - F.col("n") + F.col("lead")).alias("least")), ["g", "s"])
    return best(counted(named.where("met >= least").select("g", "s", "ref_id")))


def kmer_sets(queries: DataFrame, k: int, s: int = 0) -> DataFrame:
    """The distinct k-mers of each of ``queries`` (query_id, seq) as a set of its own."""
    own = kmers.kmer_rows(queries, ["query_id"], k, distinct=True)
    return own.groupBy(F.col("query_id").alias("g")).agg(F.collect_set("kmer").alias("words")).select("g", F.lit(s).alias("s"), "words")


def nearest(queries: DataFrame, refs: DataFrame, k: int = 8, both_strands: bool = False, few: int = 20_000_000) -> DataFrame:
    """(query_id, strand, ref_id, shared): the reference that shares most distinct k-mers with a query.

    Strand 1 is the reverse complement, tried with ``both_strands``; of equal ones the given strand, then the
    smallest ref_id. Queries that share nothing (also null, empty and too short ones) have no row.
    """
    sets = kmer_sets(queries, k)
    if both_strands:
        sets = sets.unionByName(kmer_sets(queries.withColumn("seq", dna.reverse_complement(F.col("seq"))), k, 1))
    return best_shared(sets, refs, k, few=few).select(F.col("g").alias("query_id"), F.col("s").alias("strand"), "ref_id", "shared")
