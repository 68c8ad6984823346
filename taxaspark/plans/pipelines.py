"""Amplicon and shotgun runs as lazy plans; stages that are switched off never enter the plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxaspark.functions import counts as fn
from taxaspark.functions import dna
from taxaspark.operators import alignment, denoising, mapping, profiling, reads, stats, tables, taxonomy, tree, truncation
from taxaspark.operators.joins import settle
from taxaspark.sources import config as cf


def decide_truncation(bins: DataFrame, lengths: DataFrame | None, config: dict, length: int | None, marker: str = "16S") -> dict:
    """Truncation record from quality and length profiles of all samples."""
    t = config["amplicon"]["trunc_len"]
    caps = None
    if lengths is not None:
        caps = stats.coverage_cap(lengths, ["sample", "mate"], "length", "n", t["min_read_coverage_pct"])
    profile = truncation.median_profile(truncation.cap_bins(bins, caps))
    return truncation.pick(profile, t["q_threshold"], t["q_floor"], length, config["amplicon"]["min_overlap"], t["resolve_policy"], marker)


def amplicon(pairs: DataFrame, refs: DataFrame, settings: dict, work: str, forward: str, reverse: str, trunc: tuple[int, int] = (0, 0), contaminants: DataFrame | None = None, window: tuple[int, int] | None = None, probe: dict | None = None) -> dict[str, DataFrame]:
    """Stages of an amplicon run on pairs (sample, pair_id, r1, r2) and references (ref_id, seq, lineage).

    Returns every stage's table. The stages that later ones and the tracking both use are written
    to ``work``, a folder that all executors share, and read from there.
    """

    def kept(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{work}/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{work}/{name}")

    c = cf.merge(cf.DEFAULTS, settings)
    cf.validate(c)
    a = c["amplicon"]
    out = {"raw": pairs}
    if contaminants is not None:
        out["clean"] = reads.remove_contaminant_pairs(pairs, contaminants, need="both")
    out["trimmed"] = kept("trimmed", reads.trim_primers(out.get("clean", pairs), forward, reverse, a["cutadapt"]["max_error_rate"], a["cutadapt"]["min_length"], a.get("orientation", "fixed")))
    d = a["dada2"]
    marker = a.get("marker", "16S")
    least_length = truncation.min_length(marker, d["min_len"], d.get("min_len_stat"), probe)
    out["filtered"] = kept("filtered", reads.filter_pairs(out["trimmed"], (0, 0) if marker == "ITS" else trunc, tuple(d["max_ee"]), d["trunc_q"], least_length, d["max_len"]))
    out["merged"] = kept("merged", reads.merge_pairs(out["filtered"], d["min_overlap"], d["max_mismatch"]))
    counts = reads.dereplicate(out["merged"], ["sample"], "merged").withColumnRenamed("merged", "seq")
    centred = reads.denoise(counts)
    out["denoised"] = kept("denoised", centred.groupBy("sample", F.col("centre").alias("seq")).agg(F.sum("n").alias("n")))
    return _from_denoised(out, kept, refs, a, window)


def _from_denoised(out: dict[str, DataFrame], kept, refs: DataFrame, a: dict, window: tuple[int, int] | None) -> dict[str, DataFrame]:
    """The stages after denoising: chimeras, lengths, sequence table, taxonomy, counts and tracking."""
    d, pairs = a["dada2"], out["raw"]
    chimeras = reads.bimeras(out["denoised"], d["min_fold"]).where("is_bimera").select("seq")
    out["counts"] = out["denoised"].join(chimeras, "seq", "left_anti")
    if window is not None:
        out["counts"] = stats.keep_lengths(out["counts"], F.length("seq"), *window)
    out["counts"] = kept("counts", out["counts"])
    out["asv"] = kept("asv", reads.sequence_table(out["counts"]))
    queries = out["asv"].select(F.col("asv_id").alias("query_id"), "seq")
    t = a["taxonomy"]
    if t["method"] == "rdp":  # refs also have genus
        votes, least = taxonomy.bootstrap_bayes(queries, refs, try_reverse=t.get("try_rc", False)), t["min_boot"] / 100
    else:
        votes, least = taxonomy.bootstrap_vote(queries, refs, both_strands=True), t["sintax_cutoff"]
    lineage = taxonomy.cut_by_confidence(votes, least)
    if t["method"] == "rdp" and "species" in refs.columns:  # exact matches within the genus that was called
        genus = lineage.select("query_id", F.element_at("lineage", -1).alias("genus")).where("genus IS NOT NULL")
        species = taxonomy.add_species(queries.join(genus, "query_id"), refs, t.get("try_rc", False))
        lineage = lineage.join(species, "query_id", "left").select("query_id", F.array_compact(F.concat("lineage", F.array("species"))).alias("lineage"))
    named = out["asv"].join(lineage.withColumnRenamed("query_id", "asv_id"), "asv_id", "left").withColumn("lineage", F.coalesce(F.array_join("lineage", ";"), F.lit("")))
    f = a["taxonomy"]["filter"]
    out["taxonomy"] = taxonomy.keep_discard(named, F.col("lineage"), f["keep"], f["discard"], "error") if f["enabled"] else named
    out["table"] = out["counts"].join(out["taxonomy"].select("seq", "asv_id", "lineage"), "seq").select("sample", "asv_id", "n", "lineage")
    stage = lambda name, rows: tables.totals(rows, "sample").select("sample", F.lit(name).alias("stage"), F.col("total").alias("n"))
    number = lambda name: out[name].groupBy("sample").agg(F.count("*").alias("n")).select("sample", F.lit(name).alias("stage"), "n")
    names = [x for x in ("raw", "trimmed", "filtered", "merged") if x in out]
    steps = [number(x) for x in names] + [stage("denoised", out["denoised"]), stage("non_chimeric", out["counts"]), stage("table", out["table"])]
    longest = steps[0]
    for s in steps[1:]:
        longest = longest.unionByName(s)
    out["tracking"] = tables.tracking(pairs.select("sample").distinct(), longest, [*names, "denoised", "non_chimeric", "table"])
    return out


def amplicon_probe(refs: DataFrame, forward: str, reverse: str, mode: str = "pcr", error_rate: float = 0.2, min_len: int = 50) -> dict:
    """Length statistics of the references' amplicons, one small record: between the primers (``pcr``) or of whole references (``direct``).

    Without any amplicon it is an error. Primers match with gaps, the reverse one on the references' own strand.
    """
    found = refs.where(F.length("seq") > 0)
    if mode == "pcr":
        found = found.withColumn("_f", alignment.primer_span(F.col("seq"), forward, error_rate)).where("_f IS NOT NULL").withColumn("seq", F.substr("seq", F.col("_f.stop") + 1))
        found = found.withColumn("_r", alignment.primer_span(F.col("seq"), dna.reverse_complement_text(reverse), error_rate)).where("_r IS NOT NULL").withColumn("seq", F.substr("seq", F.lit(1), F.col("_r.start") - 1))
        found = found.where(F.length("seq") >= min_len)
    elif mode != "direct":
        raise ValueError("the probe's mode is pcr or direct")
    record = stats.length_summary(found.select(F.lit(1).alias("all"), F.length("seq").alias("length")), ["all"], "length").drop("all").first()
    if record is None:
        raise ValueError("no reference has an amplicon")
    return record.asDict()


def read_profiles(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Quality profile (sample, mate, bin_start, bin_end, q1), a bin for each position, and lengths (sample, mate, length, n) of read pairs."""
    mates = pairs.select("sample", F.explode(F.array(*[F.struct(F.lit(i).alias("mate"), F.col(f"r{i}.qual").alias("qual")) for i in (1, 2)])).alias("m")).select("sample", "m.*")
    bins = reads.base_profile(mates, ["sample", "mate"], "qual").select("sample", "mate", F.col("pos").alias("bin_start"), F.col("pos").alias("bin_end"), "q1")
    return bins, mates.groupBy("sample", "mate", F.length("qual").alias("length")).agg(F.count("*").alias("n"))


def amplicon_run(pairs: DataFrame, refs: DataFrame, settings: dict, work: str, forward: str, reverse: str, contaminants: DataFrame | None = None, omega: float = 1e-40, pool: bool | str = False) -> tuple[dict[str, DataFrame], dict]:
    """The whole amplicon run from pairs (sample, pair_id, r1, r2) to the table: stages, and the record of what it decided.

    The probe measures the references' amplicons; it gives the expected length and the length window. Truncation is decided from
    the trimmed reads' own quality and length profiles. Both mates are denoised by error models of their own, and the
    sequences that explain them are merged. What the configuration fixes isn't probed.
    """

    def kept(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{work}/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{work}/{name}")

    c = cf.merge(cf.DEFAULTS, settings)
    cf.validate(c)
    a = c["amplicon"]
    d, cut, marker = a["dada2"], a["cutadapt"], a.get("marker", "16S")
    out = {"raw": pairs}
    if contaminants is not None:
        out["clean"] = reads.remove_contaminant_pairs(pairs, contaminants, need="both")
    first = out.get("clean", pairs)
    trimmed = alignment.trim_primers_gapped(first, forward, reverse, cut["max_error_rate"], cut["min_length"])
    if a.get("orientation", "fixed") == "mixed":
        turned = alignment.trim_primers_gapped(first, reverse, forward, cut["max_error_rate"], cut["min_length"])
        trimmed = trimmed.unionByName(turned.withColumns({"r1": F.col("r2"), "r2": F.col("r1")}))
    out["trimmed"] = kept("trimmed", trimmed)
    f = a["length_filter"]
    window_mode = f.get("mode", "auto")
    probed = a["expected_length"] == "auto" or window_mode == "auto" and f.get("range") is None
    probe = amplicon_probe(refs, forward, reverse, a.get("probe_mode", "direct" if marker in ("ITS", "gyrB") else "pcr"), cut["max_error_rate"], cut["min_length"]) if probed else None
    length = truncation.expected_length(a["expected_length"], probe, a["probe_length_stat"])
    record = decide_truncation(*read_profiles(out["trimmed"]), c, length, marker)
    record |= {"probe": probe, "window": None}
    trunc = (record["r1"], record["r2"])
    least = truncation.min_length(marker, d["min_len"], d.get("min_len_stat"), probe)
    out["filtered"] = kept("filtered", reads.filter_pairs(out["trimmed"], trunc, tuple(d["max_ee"]), d["trunc_q"], least, d["max_len"]))
    # Pairs of equal mates are one row from here on.
    equal = kept("equal", out["filtered"].groupBy("sample", F.col("r1.seq").alias("s1"), F.col("r2.seq").alias("s2")).agg(F.count("*").alias("n")))
    for i in (1, 2):
        own = denoising.denoise_reads(out["filtered"].select("sample", f"r{i}.seq", f"r{i}.qual"), None, omega, pool, omega)
        equal = equal.join(own.where("centre IS NOT NULL").select("sample", F.col("seq").alias(f"s{i}"), F.col("centre").alias(f"c{i}")), ["sample", f"s{i}"])
    met = kept("explained", equal.groupBy("sample", "c1", "c2").agg(F.sum("n").alias("n")))
    sure = lambda x: F.struct(F.col(x).alias("seq"), F.repeat(F.lit("I"), F.length(x)).alias("qual"))
    kinds = met.select("c1", "c2").distinct().withColumns({"r1": sure("c1"), "r2": sure("c2")})
    merged = alignment.merge_pairs_aligned(kinds, d["min_overlap"], d["max_mismatch"], d.get("trim_overhang", False)).select("c1", "c2", "merged")
    out["denoised"] = kept("denoised", met.join(merged, ["c1", "c2"]).groupBy("sample", F.col("merged").alias("seq")).agg(F.sum("n").alias("n")))
    window = None
    if window_mode != "off":
        window = stats.resolve_window(window_mode, f.get("range"), probe, f["window_margin"], length)
    record["window"] = window
    return _from_denoised(out, kept, refs, a, window), record


def shotgun_run(pairs: DataFrame, refs: DataFrame, settings: dict, work: str, k: int = 35, l: int = 31, ranks: tuple[str, ...] = profiling.RANKS, min_length: int = 100, **screens: DataFrame) -> dict[str, DataFrame]:
    """The whole shotgun run from pairs (sample, pair_id, r1, r2) and references (seq, path) to the table.

    Reads are cleaned (``screens``: contaminants, host), both mates of a pair classified together, calls become reports with
    sketches of minimizers, and these go through gate, re-estimation and filters as reports from files do. Minimizers have at
    most 31 bases.
    """
    c = cf.merge(cf.DEFAULTS, settings)
    out = clean_shotgun_reads(pairs, settings, work, min_length=min_length, **screens)
    both = out["clean"].select("sample", F.struct("sample", "pair_id").alias("read_id"), F.concat("r1.seq", F.lit("N"), "r2.seq").alias("seq"))
    s = c["shotgun"]["kraken"]
    database = settle(taxonomy.kmer_database(refs, k, l))
    calls = settle(taxonomy.classify_reads(both, database, k, l, s["confidence"], s["hit_groups"]).select(F.col("read_id.sample").alias("sample"), F.col("read_id.pair_id").alias("read_id"), "path", F.coalesce("taxon", F.lit("0")).alias("taxid")))
    rows = settle(profiling.report(calls, profiling.minimizer_hits(both, database, k, l), ranks=ranks))
    named = out["clean"].withColumnRenamed("pair_id", "read_id")
    return out | {"calls": calls} | shotgun(rows, settings, named, calls)


def clean_shotgun_reads(pairs: DataFrame, settings: dict, work: str, contaminants: DataFrame | None = None, host: DataFrame | None = None, min_length: int = 100) -> dict[str, DataFrame]:
    """Stages before classification, on pairs (sample, pair_id, r1, r2): spike-in, host, adapters and quality.

    A stage without references doesn't exist. ``decontamination.host_min_id`` is the identity at which a
    mate counts as host; with k-mers of 31 that is the share of a read's k-mers that such a read keeps. With
    ``decontamination.method: alignment`` pairs go whose mates map concordantly at that identity, gaps included.
    """

    def kept(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{work}/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{work}/{name}")

    out, now = {"raw": pairs}, pairs
    if contaminants is not None:
        now = out["no_spike"] = kept("no_spike", reads.remove_contaminant_pairs(now, contaminants, need="either", distance=1))
    if host is not None:
        identity = settings.get("decontamination", {}).get("host_min_id", 0.95)
        if settings.get("decontamination", {}).get("method") == "alignment":
            rest = mapping.screen_pairs(now.withColumn("pair_id", F.struct("sample", "pair_id")), host, "concordant", min_identity=identity)
            now = rest.withColumn("pair_id", F.col("pair_id.pair_id"))
        else:
            now = reads.remove_contaminant_pairs(now, host, need="either", min_share=identity**31)
        now = out["no_host"] = kept("no_host", now)
    now = reads.trim_readthrough(now)
    now = out["trimmed"] = kept("trimmed", now.withColumns({r: reads.quality_trim(F.col(r)) for r in ("r1", "r2")}))
    out["clean"] = now.where((F.length("r1.seq") >= min_length) & (F.length("r2.seq") >= min_length))
    steps = None
    for name, rows in out.items():
        per = rows.groupBy("sample").agg(F.count("*").alias("n")).select("sample", F.lit(name).alias("stage"), "n")
        steps = per if steps is None else steps.unionByName(per)
    out["tracking"] = tables.tracking(pairs.select("sample").distinct(), steps, [n for n in out])
    return out


def shotgun(report: DataFrame, settings: dict, reads_: DataFrame | None = None, calls: DataFrame | None = None) -> dict[str, DataFrame]:
    """Stages of a shotgun run from tree reports; ``calls`` (sample, read_id, taxid) serve read extraction."""
    c = cf.merge(cf.DEFAULTS, settings)
    cf.validate(c)
    s = c["shotgun"]
    linked = tree.link(report)
    rank = s["bracken"]["tax_lev"]
    e = s["kmer_evidence"]
    out = {"report": report}
    out["evidence"] = tree.verdicts(report, rank, e["min_distinct"], e["min_reads"], e["protect_frac"])
    used = linked
    if e["enabled"]:
        marked = tree.mark(linked, rank, e["min_distinct"], e["min_reads"], e["protect_frac"])
        credit = tree.credits(marked)
        used = tree.gated(marked, credit)
        out |= {"gated": used, "dead_credit": tree.dead_credits(marked, credit, rank)}
    b = s["bracken"]
    if b["threshold"] == "auto":
        floor = tree.total_classified(report).select("sample", fn.depth_threshold(F.col("classified"), b["threshold_alpha"], b["threshold_min"]).alias("threshold"))
    else:
        floor = report.select("sample").distinct().withColumn("threshold", F.lit(b["threshold"]))
    out["abundance"] = taxonomy.reestimate(used, rank, floor)
    named = tables.lineage_of(used, {"K": "k__", "P": "p__", "C": "c__", "O": "o__", "F": "f__", "G": "g__", "S": "s__"})
    otu = out["abundance"].join(named, ["sample", "taxid"]).withColumn("lineage", F.array_join("lineage", "; "))
    f = s["taxonomy_filter"]
    out["otu"] = taxonomy.keep_discard(otu, F.col("lineage"), f["keep"], f["discard"]) if f["enabled"] else otu
    if s["extract_taxa"] and reads_ is not None and calls is not None:
        for name in s["extract_taxa"]:
            # Taxa are those of the whole report; the gate changes abundances, not what a read was called.
            taxa = tree.with_descendants(linked, tree.first_named(linked, name))
            out[f"reads:{name}"] = taxonomy.extract_reads(reads_, taxa, calls)
    return out
