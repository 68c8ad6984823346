"""Taxonomy: token filters, k-mer classifiers, abundance re-estimation, read extraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaspark.functions import dna, kmers
from taxaspark.functions.lineage import segments
from taxaspark.operators import search
from taxaspark.operators.joins import if_small, settle


def token_list(value: str | list[str] | None) -> list[str]:
    """Configured tokens: nothing, one or several."""
    return [] if value is None else [value] if isinstance(value, str) else list(value)


def keep_discard(df: DataFrame, lineage: Column, keep: str | list[str] | None = None, discard: str | list[str] | None = None, on_empty: str = "warn") -> DataFrame:
    """Keep rows with one of the ``keep`` tokens as a whole lineage segment, then drop those with a ``discard`` token.

    ``on_empty='error'`` raises if a non-empty table loses all rows; that is the one case in which
    something is computed at once.
    """
    keep, discard = token_list(keep), token_list(discard)
    has = lambda tokens: F.arrays_overlap(segments(lineage), F.array(*[F.lit(t) for t in tokens]))
    out = df
    if keep:
        out = out.where(has(keep))
    if discard:
        out = out.where(~has(discard))
    if on_empty == "error" and (keep or discard) and out.isEmpty() and not df.isEmpty():
        raise ValueError("the taxon filter leaves no row")
    return out


def lca(paths: Column) -> Column:
    """Longest common prefix of an array of paths (arrays from the root)."""
    first = F.element_at(paths, 1)
    same = F.transform(first, lambda x, i: F.forall(paths, lambda p: F.coalesce(F.get(p, i) == x, F.lit(False))))
    stop = F.array_position(same, False)
    return F.when(stop > 0, F.slice(first, F.lit(1), (stop - 1).cast("int"))).otherwise(first)


def kmer_database(refs: DataFrame, k: int, l: int) -> DataFrame:
    """(minimizer, path): each canonical minimizer with the common path of all references that have it.

    ``refs`` has seq and path (array of taxa from the root). The common prefix of many paths is that
    of the smallest and the largest, so a minimizer of very many references needs two of them only.
    """
    each = kmers.minimizer_rows(refs, ["path"], k, l, distinct=True)
    return each.groupBy("minimizer").agg(lca(F.array(F.min("path"), F.max("path"))).alias("path"))


def classify_reads(reads: DataFrame, database: DataFrame, k: int, l: int, confidence: float = 0.15, min_groups: int = 3) -> DataFrame:
    """(read_id, n_kmers, n_hits, taxon, path): root-to-leaf path with the most k-mers, moved up until confident.

    The call is the path with the highest number of k-mers on it; of equal ones the common part. It
    moves up until its clade holds ``confidence`` of the read's k-mers, and needs ``min_groups``
    runs of k-mers with one minimizer. Reads without a call have an empty path and null taxon.
    """
    database = if_small(database)
    each = kmers.minimizer_rows(reads, ["read_id"], k, l, among=kmers.code_filter(database, "minimizer"))
    # Only k-mers of the database go on, so what is shuffled is the hits; they are made once for both groupings.
    taxa = each.join(database, "minimizer").groupBy("read_id", "path").agg(F.count("*").alias("n"), F.sum("first").alias("groups"))
    taxa = settle(taxa)
    hits = taxa.groupBy("read_id").agg(F.sum("n").alias("n_hits"), F.sum("groups").alias("n_groups"))
    totals = reads.select("read_id", (F.length("seq") - (k - 1)).cast("long").alias("n_kmers")).where("n_kmers > 0").groupBy("read_id").agg(F.sum("n_kmers").alias("n_kmers"))
    totals = totals.join(hits, "read_id", "left").fillna(0, ["n_hits", "n_groups"])
    lists = taxa.groupBy("read_id").agg(F.collect_list(F.struct("path", "n")).alias("found"))
    on_path = lambda p: F.aggregate(F.filter("found", lambda f: F.slice(p, F.lit(1), F.size(f["path"])) == f["path"]), F.lit(0).cast("long"), lambda a, f: a + f["n"])
    scored = F.transform("found", lambda f: F.struct(on_path(f["path"]).alias("score"), f["path"].alias("path")))
    rows = totals.join(lists, "read_id", "left").withColumn("_scored", scored)
    top = F.array_max(F.transform("_scored", lambda s: s["score"]))
    rows = rows.withColumn("_top", top).withColumn("_call", lca(F.transform(F.filter("_scored", lambda s: s["score"] == F.col("_top")), lambda s: s["path"])))
    clade = lambda p: F.aggregate(F.filter("found", lambda f: F.slice(f["path"], F.lit(1), F.size(p)) == p), F.lit(0).cast("long"), lambda a, f: a + f["n"])
    ups = F.transform(F.sequence(F.size("_call"), F.lit(1), F.lit(-1)), lambda i: F.slice("_call", F.lit(1), i))
    sure = F.get(F.filter(ups, lambda p: clade(p) >= F.col("n_kmers") * F.lit(confidence)), F.lit(0))
    path = F.when((F.size("_call") > 0) & (F.col("n_groups") >= min_groups), sure)
    path = F.coalesce(path, F.array().cast("array<string>"))
    return rows.withColumn("path", path).select("read_id", "n_kmers", "n_hits", F.get("path", F.size("path") - 1).alias("taxon"), "path")


def classified_reads(reads: DataFrame, calls: DataFrame) -> DataFrame:
    """Reads whose call (read_id, taxon) names a taxon."""
    return reads.join(calls.where("taxon IS NOT NULL").select("read_id").distinct(), "read_id", "left_semi")


def better_strand(queries: DataFrame, refs: DataFrame, k: int = 8) -> DataFrame:
    """(query_id, seq) with the strand that shares more distinct k-mers with a single reference; the given one if both share as many."""
    best = search.nearest(queries, refs, k, both_strands=True).select("query_id", "strand")
    return queries.join(best, "query_id", "left").select("query_id", F.when(F.col("strand") == 1, dna.reverse_complement(F.col("seq"))).otherwise(F.col("seq")).alias("seq"))


def shared_kmers(queries: DataFrame, refs: DataFrame, k: int = 8) -> DataFrame:
    """(query_id, ref_id, shared): distinct k-mers that queries and references share, by inverted index."""
    own = kmers.kmer_rows(queries, ["query_id"], k, distinct=True)
    index = kmers.kmer_rows(refs, ["ref_id"], k, distinct=True)
    return own.join(index, "kmer").groupBy("query_id", "ref_id").agg(F.count("*").alias("shared"))


def bootstrap_vote(queries: DataFrame, refs: DataFrame, k: int = 8, rounds: int = 100, words: int = 32, seed: int = 1, both_strands: bool = False) -> DataFrame:
    """(query_id, rank_no, taxon, confidence): SINTAX-like vote; ``refs`` has ref_id, seq, lineage (array).

    In each round ``words`` k-mers of the query, chosen by a hash of seed, query, round and k-mer,
    pick the reference that has most of them (ties to the smaller id), found by bounds. The confidence of a rank is
    the share of rounds that agree with the most frequent pick's prefix up to it. The same result
    comes out under any partitioning. With ``both_strands`` the better strand of a query votes.
    """
    queries = better_strand(queries, refs, k) if both_strands else queries
    own = kmers.kmer_rows(queries, ["query_id"], k, distinct=True).withColumn("m", kmers.text(F.col("kmer"), k))
    per = own.groupBy("query_id").agg(F.collect_list(F.struct("m", "kmer")).alias("ks"))
    per = per.withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(rounds))))
    key = lambda m: F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("query_id").cast("string"), F.col("round").cast("string"), m))
    drawn = F.transform(F.slice(F.array_sort(F.transform("ks", lambda w: F.struct(key(w["m"]).alias("h"), w["kmer"].alias("kmer")))), 1, words), lambda w: w["kmer"])
    sets = per.select(F.struct("query_id", "round").alias("g"), F.lit(0).alias("s"), drawn.alias("words"))
    best = search.best_shared(sets, refs, k).select("g.query_id", "g.round", "ref_id")
    named = best.join(refs.select("ref_id", "lineage"), "ref_id")
    each = named.select("query_id", F.posexplode(F.transform("lineage", lambda x, i: F.slice("lineage", F.lit(1), i + 1))).alias("rank_no", "prefix"))
    votes = each.groupBy("query_id", "rank_no", "prefix").agg(F.count("*").alias("n"))
    top = votes.groupBy("query_id", "rank_no").agg(F.max_by(F.struct("prefix", "n"), F.struct("n", F.array_join("prefix", ";"))).alias("b"))
    return top.select("query_id", "rank_no", F.element_at("b.prefix", -1).alias("taxon"), (F.col("b.n") / rounds).alias("confidence"))


def cut_by_confidence(votes: DataFrame, least: float = 0.8) -> DataFrame:
    """(query_id, lineage): the ranks before the first one below ``least``."""
    low = F.min(F.when(F.col("confidence") < least, F.col("rank_no")))
    first = votes.groupBy("query_id").agg(low.alias("_low"), F.sort_array(F.collect_list(F.struct("rank_no", "taxon"))).alias("_t"))
    return first.select("query_id", F.transform(F.filter("_t", lambda t: F.col("_low").isNull() | (t["rank_no"] < F.col("_low"))), lambda t: t["taxon"]).alias("lineage"))


def word_model(refs: DataFrame, k: int = 8) -> DataFrame:
    """(genus, kmer, prior, size, logp) of the naive Bayes classifier: (m + P) / (M + 1) with P = (n + 0.5) / (N + 1)."""
    words = kmers.kmer_rows(refs, ["ref_id", "genus"], k, distinct=True)
    n_all = refs.agg(F.count("*").alias("_all"))
    prior = words.groupBy("kmer").agg(F.count("*").alias("_n")).join(F.broadcast(n_all)).select("kmer", ((F.col("_n") + 0.5) / (F.col("_all") + 1)).alias("prior"))  # one row
    size = refs.groupBy("genus").agg(F.count("*").alias("_m"))
    own = words.groupBy("genus", "kmer").agg(F.count("*").alias("_k"))
    return own.join(prior, "kmer").join(size, "genus").select("genus", "kmer", "prior", F.col("_m").alias("size"), F.log((F.col("_k") + F.col("prior")) / (F.col("_m") + 1)).alias("logp"))


def _best_genus(words: DataFrame, model: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, genus, score): best genus by the sum of its words' log probabilities; ``words`` has kmer and times.

    A word that a genus lacks has probability prior / (size + 1); those sums are formed from the
    total of log priors, so only shared words are joined. Words that no reference has say nothing.
    """
    prior = model.groupBy("kmer").agg(F.first("prior").alias("prior"))
    base = words.join(prior, "kmer").groupBy(*keys).agg(F.sum(F.col("times") * F.log("prior")).alias("_base"), F.sum("times").alias("_n"))
    met = words.join(model, "kmer").groupBy(*keys, "genus").agg(F.sum(F.col("times") * (F.col("logp") - F.log("prior"))).alias("_gain"), F.first("size").alias("size"), F.sum("times").alias("_hit"))
    score = F.col("_base") + F.col("_gain") - (F.col("_n") - F.col("_hit")) * F.log(F.col("size") + 1.0)
    scored = met.join(base, keys).withColumn("score", score)
    return scored.groupBy(*keys).agg(F.max(F.struct(F.round("score", 6).alias("score"), "genus")).alias("b")).select(*keys, "b.genus", "b.score")


def naive_bayes(queries: DataFrame, refs: DataFrame, k: int = 8) -> DataFrame:
    """(query_id, genus, score): best genus by the sum of its words' log probabilities."""
    return _best_genus(kmers.kmer_rows(queries, ["query_id"], k, distinct=True).withColumn("times", F.lit(1)), word_model(refs, k), ["query_id"])


def bootstrap_bayes(queries: DataFrame, refs: DataFrame, k: int = 8, rounds: int = 100, seed: int = 1, try_reverse: bool = False) -> DataFrame:
    """(query_id, rank_no, taxon, confidence): naive Bayes with bootstraps; ``refs`` has ref_id, seq, genus, lineage (array down to the genus).

    The best genus by all words of a query names its ranks. In each round an eighth of the words, drawn with
    replacement by a hash, picks a genus; the confidence of a rank is the share of rounds whose genus agrees down to
    it. With ``try_reverse`` the better strand is taken. Cut the ranks by ``cut_by_confidence``.
    """
    queries = better_strand(queries, refs, k) if try_reverse else queries
    model = settle(word_model(refs, k))
    own = settle(kmers.kmer_rows(queries, ["query_id"], k, distinct=True))
    named = refs.groupBy("genus").agg(F.min("lineage").alias("lineage"))
    best = _best_genus(own.withColumn("times", F.lit(1)), model, ["query_id"])
    lists = own.groupBy("query_id").agg(F.sort_array(F.collect_list("kmer")).alias("ks"))
    drawn = lists.withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(rounds))))
    pick = lambda j: F.element_at("ks", (F.pmod(F.xxhash64(F.lit(seed), "query_id", "round", j), F.size("ks")) + 1).cast("int"))
    drawn = drawn.select("query_id", "round", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.floor(F.size("ks") / 8).cast("int"))), pick)).alias("kmer"))
    drawn = drawn.groupBy("query_id", "round", "kmer").agg(F.count("*").alias("times"))
    voted = _best_genus(drawn, model, ["query_id", "round"]).select("query_id", "round", F.col("genus").alias("pick"))
    lineage = best.select("query_id", "genus").join(named, "genus").select("query_id", "lineage")
    votes = voted.join(named.select(F.col("genus").alias("pick"), F.col("lineage").alias("other")), "pick").join(lineage, "query_id")
    each = votes.select("query_id", F.posexplode("lineage").alias("rank_no", "taxon"), "lineage", "other")
    agree = F.slice("lineage", F.lit(1), F.col("rank_no") + 1) == F.slice("other", F.lit(1), F.col("rank_no") + 1)
    return each.groupBy("query_id", "rank_no", "taxon").agg((F.count_if(agree) / F.lit(float(rounds))).alias("confidence"))


def add_species(queries: DataFrame, refs: DataFrame, both_strands: bool = True) -> DataFrame:
    """(query_id, species): exact match of the whole query in references of its genus, if only one species fits.

    Queries and references meet on a shared end of the query, then containment is tested.
    """
    q = queries.select("query_id", "genus", F.explode(F.array("seq", dna.reverse_complement(F.col("seq"))) if both_strands else F.array("seq")).alias("seq"))
    lead = 16
    q = q.withColumn("_key", F.substring("seq", 1, lead))
    r = refs.select("genus", "species", F.col("seq").alias("_ref"), F.explode(F.array_distinct(dna.kmers(F.col("seq"), lead))).alias("_key"))
    met = q.join(r, ["genus", "_key"]).where(F.col("_ref").contains(F.col("seq")))
    return met.groupBy("query_id").agg(F.min("species").alias("species"), F.max("species").alias("_x")).where("species = _x").drop("_x")


def classify_unique(rows: DataFrame, seq: str, classify) -> DataFrame:
    """Classify each distinct sequence once and give the result to every row with it."""
    return rows.join(classify(rows.select(seq).distinct()), seq, "left")


def reestimate(linked: DataFrame, rank: str, threshold: DataFrame, kmer_share: DataFrame | None = None) -> DataFrame:
    """(sample, taxid, name, own, added, estimate): reads above ``rank`` shared out to the taxa at it.

    ``linked`` is a linked tree; ``threshold`` has (sample, threshold). Taxa with fewer clade reads are
    discarded, and reads of an ancestor go to the taxa left below it in proportion to their own
    reads, weighted by ``kmer_share`` (ancestor taxid, taxid, share) if it is given. Reads of an
    ancestor with nothing left below it are lost.
    """
    taxa = linked.where(F.col("rank") == rank).join(threshold, "sample").where("clade_reads >= threshold")
    up = taxa.select("sample", "idx", "taxid", "name", F.col("clade_reads").alias("own"), F.explode("ancestors").alias("anc"))
    direct = linked.select("sample", F.col("idx").cast("long").alias("anc"), F.col("direct_reads").alias("pool"), F.col("taxid").alias("anc_taxid"))
    pairs = up.join(direct, ["sample", "anc"]).where("pool > 0")
    weight = F.col("own").cast("double")
    if kmer_share is not None:
        pairs = pairs.join(kmer_share, ["anc_taxid", "taxid"], "left")
        weight = weight * F.coalesce("share", F.lit(0.0))
    pairs = pairs.withColumn("_w", weight)
    sums = pairs.groupBy("sample", "anc").agg(F.sum("_w").alias("_sum"))
    shared = pairs.join(sums, ["sample", "anc"]).where("_sum > 0").groupBy("sample", "idx").agg(F.sum(F.col("pool") * F.col("_w") / F.col("_sum")).alias("added"))
    out = taxa.join(shared, ["sample", "idx"], "left").withColumn("added", F.coalesce("added", F.lit(0.0)))
    return out.select("sample", "taxid", "name", F.col("clade_reads").alias("own"), "added", (F.col("clade_reads") + F.col("added")).alias("estimate"))


def extract_reads(reads: DataFrame, taxa: DataFrame, assigned: DataFrame) -> DataFrame:
    """Reads whose assigned taxid is among ``taxa``; all columns are kept."""
    ids = assigned.join(if_small(taxa.select("sample", "taxid").distinct()), ["sample", "taxid"], "left_semi")
    return reads.join(ids.select("sample", "read_id"), ["sample", "read_id"], "left_semi")
