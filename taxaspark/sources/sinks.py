"""Rows and files that the engine writes: evidence and gated reports, wide tables, FASTA, JSON records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxaspark.functions.counts import ratio_text
from taxaspark.operators.tables import widen


def evidence_rows(verdicts: DataFrame, with_sample: bool = False) -> DataFrame:
    """The 12 columns of the evidence table as text and numbers, as they are written."""
    rows = verdicts.select(
        *(["sample"] if with_sample else []), "taxid", "name", "rank", "clade_reads", "direct_reads", "total_minimizers", "distinct_minimizers",
        ratio_text(F.col("total_minimizers"), F.col("distinct_minimizers")).alias("duplicity"), ratio_text(F.col("distinct_minimizers"), F.col("clade_reads")).alias("minimizers_per_read"),
        F.format_string("%.4f", F.col("share") * 100).alias("pct_of_classified"), "decision", "reason",
    )
    return rows


# Columns of the manifest of samples.
MANIFEST = ["sample", "source", "bioproject", "r1", "r2"]


def manifest_lines(samples: DataFrame, source: str, folder: str, bioproject: str = "", naming: str = "_R1", ending: str = "fastq.gz") -> DataFrame:
    """(sample, value) lines of the manifest of samples, with the header first (an empty sample)."""
    second = {"_R1": "_R2", "_1": "_2"}[naming]
    name = lambda mate: F.concat(F.lit(f"{folder}/"), "sample", F.lit(f"{mate}.{ending}"))
    body = samples.select("sample", F.concat_ws("\t", "sample", F.lit(source), F.lit(bioproject), name(naming), name(second)).alias("value"))
    return samples.sparkSession.createDataFrame([("", "\t".join(MANIFEST))], "sample string, value string").unionByName(body)


def report_lines(gated: DataFrame) -> DataFrame:
    """Report text: 8 tab-separated columns, names indented by two spaces a level, in report order."""
    name = F.concat(F.repeat(F.lit("  "), F.col("depth")), "name")
    line = F.concat_ws("\t", F.coalesce(F.col("pct"), F.lit("0.00")), F.col("clade_reads").cast("string"), F.col("direct_reads").cast("string"), F.col("total_minimizers").cast("string"), F.col("distinct_minimizers").cast("string"), "rank", "taxid", name)
    return gated.select("sample", "idx", line.alias("value"))


def write_lines(lines: DataFrame, path: str, order: list[str], compression: str = "none") -> None:
    """Write a ``value`` column as text in order: range-sorted part files that concatenate in order."""
    lines.orderBy(*order).select("value").write.mode("overwrite").option("compression", compression).text(path)


def quoted(value: Column) -> Column:
    return F.concat(F.lit('"'), value.cast("string"), F.lit('"'))


def matrix_lines(counts: DataFrame, rows: str, columns: str, names: list[str], n: str = "n") -> DataFrame:
    """Tab-separated matrix with an empty first header cell and quoted strings: (no, value).

    ``names`` gives the columns; it is the list of samples, which the run's configuration holds.
    """
    wide = widen(counts, rows, columns, names, n)
    head = "\t".join(["", *[f'"{c}"' for c in names]])
    body = wide.select(F.lit(1).alias("no"), F.col(rows).alias("key"), F.concat_ws("\t", quoted(F.col(rows)), *[F.col(f"`{c}`").cast("string") for c in names]).alias("value"))
    return counts.sparkSession.createDataFrame([(0, "", head)], "no int, key string, value string").unionByName(body.withColumn("key", F.col("key").cast("string")))


def otu_lines(otu: DataFrame, names: list[str]) -> DataFrame:
    """OTU table text: a comment, a header, a row for each taxon with doubles and its lineage last."""
    wide = otu.groupBy("taxid", "lineage").pivot("sample", names).agg(F.sum("n"))
    cells = [F.coalesce(F.col(f"`{c}`"), F.lit(0.0)).cast("string") for c in names]
    body = wide.select(F.lit(2).alias("no"), F.col("taxid").alias("key"), F.concat_ws("\t", "taxid", *cells, F.regexp_replace("lineage", "; ", ";")).alias("value"))
    head = [(0, "", "# Constructed from biom file"), (1, "", "\t".join(["#OTU ID", *names, "taxonomy"]))]
    return otu.sparkSession.createDataFrame(head, "no int, key string, value string").unionByName(body)


def fasta_lines(seqs: DataFrame, identifier: str, seq: str, order: str) -> DataFrame:
    """One record a row, header and sequence on a line each."""
    return seqs.select(F.col(order).alias("no"), F.concat(F.lit(">"), identifier, F.lit("\n"), seq).alias("value"))


def fastq_lines(reads: DataFrame) -> DataFrame:
    """One read a row in four lines, from (sample, ordinal, read_id, seq, qual)."""
    return reads.select("sample", "ordinal", F.concat(F.lit("@"), "read_id", F.lit("\n"), "seq", F.lit("\n+\n"), "qual").alias("value"))


def json_record(df: DataFrame) -> DataFrame:
    """Rows as JSON text, for decision records."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def length_counts(histogram: DataFrame, value: str) -> DataFrame:
    """One row with the histogram as a map in rising order; a histogram of lengths is small by nature."""
    each = F.array_sort(F.collect_list(F.struct(F.col(value).alias("k"), F.col("n").alias("v"))))
    return histogram.groupBy(value).agg(F.sum("n").alias("n")).agg(F.map_from_entries(each).alias("length_counts"))


def metrics(df: DataFrame, name: str, **columns: Column):
    """Observe counts while a table is written: returns the table and the observation to read after."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return df.observe(seen, *[c.alias(k) for k, c in columns.items()]), seen

