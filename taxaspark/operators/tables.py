"""Count tables in long form, and their wide forms at the sinks: OTU and sequence tables, tracking, collapse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxaspark.functions.counts import or_na
from taxaspark.functions.lineage import numeric_suffix
from taxaspark.operators.joins import settle


def totals(counts: DataFrame, by: str, n: str = "n") -> DataFrame:
    return counts.groupBy(by).agg(F.sum(n).alias("total"))


def read_counts(reads: DataFrame, sample: str) -> DataFrame:
    """Reads of each sample, and a row named ``Total read count`` with the sum."""
    rolled = reads.where(F.col(sample).isNotNull()).rollup(sample).agg(F.count("*").alias("n"))
    return rolled.select(F.coalesce(F.col(sample).cast("string"), F.lit("Total read count")).alias("sample"), "n")


def widen(counts: DataFrame, rows: str, columns: str, names: list, n: str = "n", missing: Column | None = None) -> DataFrame:
    """Long to wide with the listed columns in order; missing cells are 0 unless told otherwise."""
    wide = counts.groupBy(rows).pivot(columns, names).agg(F.sum(n))
    fill = F.lit(0) if missing is None else missing
    return wide.select(rows, *[F.coalesce(F.col(f"`{c}`"), fill).alias(str(c)) for c in names])


def lengthen(wide: DataFrame, rows: str, name: str = "sample", n: str = "n") -> DataFrame:
    """Wide to long; zero cells are left out."""
    cells = [c for c in wide.columns if c != rows]
    return wide.unpivot([rows], cells, name, n).where(F.col(n) != 0)


def tracking(samples: DataFrame, stages: DataFrame, names: list[str]) -> DataFrame:
    """sample and a text column for each stage; samples without a count have ``NA``, not 0."""
    wide = stages.groupBy("sample").pivot("stage", names).agg(F.sum("n"))
    rows = samples.select("sample").join(wide, "sample", "left")
    return rows.select("sample", *[or_na(F.col(f"`{s}`")).alias(s) for s in names])


def checked_tracking(samples: DataFrame, stages: DataFrame, names: list[str]) -> DataFrame:
    """The same with whole numbers; a sample without one of the stages is an error."""
    wide = stages.groupBy("sample").pivot("stage", names).agg(F.sum("n"))
    rows = samples.select("sample").join(wide, "sample", "left")
    must = lambda s: F.when(F.col(f"`{s}`").isNull(), F.raise_error(F.concat(F.lit(f"no {s} count for "), "sample")).cast("long")).otherwise(F.col(f"`{s}`"))
    return rows.select("sample", *[must(s).alias(s) for s in names])


def collapse_identical(extracted: DataFrame) -> DataFrame:
    """(representative, merged_asvs, n_merged, extracted_length, seq) of each distinct sequence.

    The representative is the member with the smallest number; members are listed by number.
    """
    rows = extracted.select("asv_id", "seq", numeric_suffix(F.col("asv_id")).alias("no"))
    groups = rows.groupBy("seq").agg(F.sort_array(F.collect_list(F.struct("no", "asv_id"))).alias("m"))
    names = F.transform("m", lambda x: x["asv_id"])
    return groups.select(F.element_at(names, 1).alias("representative"), F.array_join(names, ",").alias("merged_asvs"), F.size("m").alias("n_merged"), F.length("seq").alias("extracted_length"), "seq")


def collapse_counts(counts: DataFrame, extracted: DataFrame) -> DataFrame:
    """Counts summed by representative; sequences that weren't extracted go."""
    rows = extracted.select("asv_id", "seq", numeric_suffix(F.col("asv_id")).alias("no"))
    head = rows.groupBy("seq").agg(F.min(F.struct("no", "asv_id"))["asv_id"].alias("representative"))
    of = rows.join(head, "seq").select("asv_id", "representative")
    return counts.join(of, "asv_id").groupBy("sample", F.col("representative").alias("asv_id")).agg(F.sum("n").alias("n"))


def collapse_counters(extracted: DataFrame) -> DataFrame:
    """One row: extracted sequences, distinct ones, groups of several, and sequences that collapsing drops."""
    groups = extracted.groupBy("seq").agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("extracted"), F.count("*").alias("groups"), F.count_if(F.col("n") > 1).alias("collapsed_groups"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("dropped"))


def by_sequence(counts: DataFrame, named: DataFrame) -> DataFrame:
    """Counts (sample, asv_id, n) keyed by the sequence of each name (asv_id, seq); names without one go."""
    return counts.join(named.select("asv_id", "seq"), "asv_id").select("sample", "seq", "n")


def by_name(counts: DataFrame, named: DataFrame) -> DataFrame:
    """Counts (sample, seq, n) keyed by the name of each sequence."""
    return counts.join(named.select("asv_id", "seq"), "seq").select("sample", "asv_id", "n")


def numbered_in_order(rows: DataFrame, order: list[str], name: str = "no") -> DataFrame:
    """``rows`` numbered from 1 in the given order, without one task that sees all of them.

    Rows are dealt by ranges of the order; each is numbered within its range, and the counts of the ranges before are added.
    """
    ranged = settle(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()))
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_base", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    within = Window.partitionBy("_part").orderBy(*order)
    out = ranged.withColumn("_k", F.row_number().over(within)).join(F.broadcast(before), "_part")  # as many rows as partitions
    return out.withColumn(name, (F.col("_base") + F.col("_k")).cast("long")).drop("_part", "_base", "_k")


def subset(counts: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Counts of the listed ids only."""
    return counts.join(ids.select(key).distinct(), key, "left_semi")


def otu_table(counts: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """(sample, taxid, n, lineage) in long form; counts are doubles, as the table writes them."""
    summed = counts.groupBy("sample", "taxid").agg(F.sum("n").cast("double").alias("n"))
    return summed.join(taxonomy.select("taxid", F.array_join("lineage", "; ").alias("lineage")), "taxid")


def lineage_of(linked: DataFrame, prefixes: dict[str, str]) -> DataFrame:
    """(sample, taxid, lineage) of every row: the named ranks among its ancestors and itself, as an array."""
    own = F.create_map(*[F.lit(x) for kv in prefixes.items() for x in kv])
    names = linked.select("sample", F.col("idx").cast("long").alias("a"), "rank", "name")
    each = linked.select("sample", "taxid", "idx", F.posexplode(F.concat("ancestors", F.array(F.col("idx").cast("long")))).alias("k", "a"))
    named = each.join(names, ["sample", "a"]).withColumn("p", F.try_element_at(own, F.col("rank"))).where("p IS NOT NULL")
    lists = named.groupBy("sample", "taxid", "idx").agg(F.sort_array(F.collect_list(F.struct("k", F.concat("p", "name").alias("v")))).alias("s"))
    return lists.select("sample", "taxid", F.transform("s", lambda x: x["v"]).alias("lineage"))


def top_taxa(counts: DataFrame, by: str, taxon: str, k: int = 10, n: str = "n") -> DataFrame:
    """The k most frequent taxa of each group; ties by name."""
    summed = counts.groupBy(by, taxon).agg(F.sum(n).alias("n"))
    w = Window.partitionBy(by).orderBy(F.desc("n"), taxon)
    return summed.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def chimera_fraction(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: the share of reads that the second table lost."""
    a, b = before.agg(F.sum("n").alias("a")), after.agg(F.sum("n").alias("b"))
    return a.join(F.broadcast(b)).select((1 - F.coalesce("b", F.lit(0)) / F.col("a")).alias("fraction"))


def paired_runs(runs: DataFrame, accessions: DataFrame | None = None) -> DataFrame:
    """Distinct run names with a paired layout, sorted; optionally only those listed."""
    rows = runs.where((F.col("Run") != "") & (F.upper(F.trim("LibraryLayout")) == "PAIRED")).select("Run").distinct()
    if accessions is not None:
        rows = rows.join(accessions.select("Run"), "Run", "left_semi")
    return rows.orderBy("Run")
