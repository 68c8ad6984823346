"""Readers of the text formats that a profiling run meets; each returns typed rows."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from taxaspark.functions.lineage import convert_ranked_header
from taxaspark.sources.lines import numbered, running_count, sample_of

FASTQ_EXTENSIONS = ["fastq.gz", "fastq", "fq.gz", "fq"]
FORBIDDEN = set("*#@%^/! ?&:;|<>")


def _fail(message: str, *columns) -> F:
    return F.raise_error(F.concat(F.lit(message), *columns))


def discover_samples(names: list[str], amplicon: bool = False) -> dict[str, tuple[str, str]]:
    """Sample name to its two file names, from a listing.

    ``{sample}_R1.ext`` is looked for first, ``{sample}_1.ext`` only if there is none and only for
    shotgun runs. All first mates must have one extension and clean sample names.
    """
    found = {}
    for mark in ("_R1", "_1"):
        for n in sorted(names):
            m = re.fullmatch(rf"(.+){mark}\.({'|'.join(map(re.escape, FASTQ_EXTENSIONS))})", n)
            if m:
                found[m[1]] = (n, n[: -len(m[2]) - 2] + "2." + m[2], m[2])
        if found or amplicon:
            break
    if len({v[2] for v in found.values()}) > 1:
        raise ValueError("reads have different extensions")
    if bad := [s for s in found if FORBIDDEN & set(s)]:
        raise ValueError(f"sample names have forbidden characters: {bad}")
    return {s: v[:2] for s, v in sorted(found.items())}


def resolve_fastq(spark: SparkSession, folder: str, sample: str, read: int, naming: str = "_R1") -> str:
    """Path of a sample's reads: the compressed file if it exists, else the plain one, else the name the compressed one would have.

    ``naming`` is how first mates are marked, ``_R1`` or ``_1``.
    """
    mate = naming if read == 1 else {"_R1": "_R2", "_1": "_2"}[naming]
    packed, plain = (f"{folder.rstrip('/')}/{sample}{mate}.fastq{end}" for end in (".gz", ""))
    path = lambda p: spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
    exists = lambda p: path(p).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path(p))
    return packed if exists(packed) or not exists(plain) else plain


def _nothing_missing(spark: SparkSession, path: str | list[str], rows: DataFrame, what: str) -> DataFrame:
    """``rows`` if every file of ``path`` gave some; a file without is an error."""
    whole = lambda f: re.sub(r"^(\w+):/+", r"\1:/", f)  # noqa: E731  file:/a and file:///a are one path
    files = {whole(f) for f in spark.read.text(path).inputFiles()}
    empty = files - {whole(r["file"]) for r in rows.select("file").distinct().collect()}  # one name a file
    if empty:
        raise ValueError(f"no {what} in {sorted(empty)}")
    return rows


def fastq(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """sample, file, ordinal, read_id, seq, qual; compressed files too. A broken record is an error."""
    rows = numbered(spark, path).withColumn("ordinal", F.floor(F.col("line_no") / 4))
    at = lambda k: F.max(F.when(F.col("line_no") % 4 == k, F.col("value")))
    reads = rows.groupBy("file", "ordinal").agg(at(0).alias("head"), at(1).alias("seq"), at(2).alias("plus"), at(3).alias("qual"))
    good = F.col("head").startswith("@") & F.col("plus").startswith("+") & (F.length("seq") == F.length("qual"))
    head = F.when(F.coalesce(good, F.lit(False)), F.col("head")).otherwise(_fail("broken FASTQ record in ", F.col("file")))
    return reads.select(sample_of(F.col("file"), r"(_R?[12])?\.[A-Za-z0-9.]+$").alias("sample"), "file", "ordinal", F.regexp_extract(head, r"^@(\S+)", 1).alias("read_id"), "seq", "qual")


def fasta(spark: SparkSession, path: str | list[str], keep_empty: bool = True) -> DataFrame:
    """file, record (from 1), ref_id (first token), header, seq; bodies of several lines are joined."""
    head = F.col("value").startswith(">")
    rows = running_count(numbered(spark, path), head, "record").where("record > 0")
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.when(~head, F.struct("line_no", F.regexp_replace("value", r"\s", "").alias("s"))))), lambda x: x["s"]), "")
    out = rows.groupBy("file", "record").agg(F.max(F.when(head, F.substr("value", F.lit(2)))).alias("header"), body.alias("seq"))
    out = out.select("file", "record", F.regexp_extract("header", r"^(\S*)", 1).alias("ref_id"), "header", "seq")
    return out if keep_empty else out.where(F.length("seq") > 0)


def ranked_fasta(spark: SparkSession, path: str | list[str], letters: list[str]) -> DataFrame:
    """(no, value): lines of a FASTA file whose headers are ``>1;tax=d:...``, numbered by record; the other lines as they are."""
    head = F.col("value").startswith(">")
    rows = running_count(numbered(spark, path), head, "record")
    new = F.concat(F.lit(">"), F.col("record").cast("string"), F.lit(";"), convert_ranked_header(F.substr("value", F.lit(2)), letters))
    return rows.select("file", F.col("line_no").alias("no"), F.when(head, new).otherwise(F.col("value")).alias("value"))


def tree_report(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Tree rows of 8-column reports: blank lines are skipped, any other number of columns and an empty file are errors."""
    rows = _nothing_missing(spark, path, numbered(spark, path).where(F.trim("value") != ""), "report line").withColumn("f", F.split("value", "\t"))
    f = F.when(F.size("f") == 8, F.col("f")).otherwise(_fail("a report line hasn't 8 columns: ", F.col("value")))
    rows = rows.withColumn("f", f)
    name = F.get("f", F.lit(7))
    order = Window.partitionBy("file").orderBy("line_no")
    number = lambda k: F.get("f", F.lit(k)).cast("long")
    return rows.select(
        sample_of(F.col("file")).alias("sample"), (F.row_number().over(order) - 1).cast("long").alias("idx"), F.floor((F.length(name) - F.length(F.ltrim(name))) / 2).cast("int").alias("depth"),
        F.get("f", F.lit(0)).alias("pct"), number(1).alias("clade_reads"), number(2).alias("direct_reads"), number(3).alias("total_minimizers"), number(4).alias("distinct_minimizers"),
        F.trim(F.get("f", F.lit(5))).alias("rank"), F.trim(F.get("f", F.lit(6))).alias("taxid"), F.trim(name).alias("name"),
    )


def short_report(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Reports of 6 or 8 columns read from the right: sample, idx, clade_reads, direct_reads, rank, taxid, name, depth."""
    rows = numbered(spark, path).where(F.trim("value") != "").withColumn("f", F.split("value", "\t"))
    name = F.element_at("f", -1)
    return rows.select(sample_of(F.col("file")).alias("sample"), F.col("line_no").alias("idx"), F.floor((F.length(name) - F.length(F.ltrim(name))) / 2).cast("int").alias("depth"), F.get("f", F.lit(1)).cast("long").alias("clade_reads"), F.get("f", F.lit(2)).cast("long").alias("direct_reads"), F.trim(F.element_at("f", -3)).alias("rank"), F.trim(F.element_at("f", -2)).alias("taxid"), F.trim(name).alias("name"))


def _module(spark: SparkSession, path: str | list[str], title: str) -> DataFrame:
    """Lines of one module of quality reports, without comments, split at tabs."""
    rows = numbered(spark, path)
    label = F.last(F.when(F.col("value").startswith(">>"), F.col("value")), ignorenulls=True).over(Window.partitionBy("file").orderBy("line_no"))
    rows = rows.withColumn("_module", label).where(F.col("_module").startswith(">>" + title) & ~F.col("value").startswith(">>") & ~F.col("value").startswith("#"))
    return rows.withColumn("f", F.split("value", "\t"))


def quality_bins(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """sample, mate, bin_start, bin_end, q1: lower quartile of the quality in each bin of positions."""
    rows = _nothing_missing(spark, path, _module(spark, path, "Per base sequence quality").where(F.size("f") >= 4), "quality bin")
    ends = F.split(F.get("f", F.lit(0)), "-")
    return rows.select(sample_of(F.col("file"), r"(_R?[12])?(_fastqc_data)?\.[A-Za-z0-9.]+$").alias("sample"), _mate(), F.get(ends, F.lit(0)).cast("int").alias("bin_start"), F.element_at(ends, -1).cast("int").alias("bin_end"), F.get("f", F.lit(3)).cast("double").alias("q1"))


def length_bins(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """sample, mate, length, n: a bin of lengths counts at its lowest length."""
    rows = _module(spark, path, "Sequence Length Distribution").where(F.size("f") >= 2)
    return rows.select(sample_of(F.col("file"), r"(_R?[12])?(_fastqc_data)?\.[A-Za-z0-9.]+$").alias("sample"), _mate(), F.get(F.split(F.get("f", F.lit(0)), "-"), F.lit(0)).cast("int").alias("length"), F.get("f", F.lit(1)).cast("double").alias("n"))


def _mate():
    return F.coalesce(F.nullif(F.regexp_extract("file", r"_R?([12])[._]", 1), F.lit("")).cast("int"), F.lit(1)).alias("mate")


def trim_summary(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """sample, raw, passed (pairs) and mean lengths of trimming summaries in JSON."""
    schema = "summary struct<before_filtering: struct<total_reads: long>, after_filtering: struct<read1_mean_length: long, read2_mean_length: long>>, filtering_result struct<passed_filter_reads: long>"
    rows = spark.read.schema(schema).option("multiLine", True).json(path)
    half = lambda c: F.expr(f"{c} div 2")
    return rows.select(sample_of(F.col("_metadata.file_path")).alias("sample"), half("summary.before_filtering.total_reads").alias("raw"), half("filtering_result.passed_filter_reads").alias("passed"), F.col("summary.after_filtering.read1_mean_length").alias("mean1"), F.col("summary.after_filtering.read2_mean_length").alias("mean2"))


def match_stats(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """sample, total, matched (pairs) of k-mer filter statistics."""
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    token = lambda name: F.max(F.when(F.col("value").startswith("#" + name), F.expr("cast(split(value, '[\\t ]+')[1] as long) div 2")))
    return rows.groupBy("file").agg(token("Total").alias("total"), token("Matched").alias("matched")).select(sample_of(F.col("file")).alias("sample"), "total", "matched")


def surviving_pairs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """sample, n of host-removal statistics; 0 if the line is missing."""
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    n = F.max(F.when(F.col("value").startswith("surviving_pairs\t"), F.regexp_extract("value", r"\t(\d+)", 1).cast("long")))
    return rows.groupBy("file").agg(F.coalesce(n, F.lit(0)).alias("n")).select(sample_of(F.col("file")).alias("sample"), "n")


def count_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """sample, n of ``sample : n`` lines; totals and other lines are skipped."""
    rows = spark.read.text(path).where(F.col("value").contains(" : ") & ~F.col("value").startswith("Total"))
    return rows.select(F.trim(F.regexp_extract("value", r"^(.*?) : ", 1)).alias("sample"), F.trim(F.regexp_extract("value", r"^.*? : (.*)$", 1)).cast("long").alias("n"))


def matrix(spark: SparkSession, path: str, row: str = "sample", column: str = "asv_id", n: str = "n") -> DataFrame:
    """Long form of a tab-separated matrix with an empty or missing first header cell and quoted strings."""
    rows = numbered(spark, path).where("value <> ''").withColumn("f", F.transform(F.split("value", "\t"), lambda x: F.regexp_replace(x, '^"|"$', "")))
    head = rows.where("line_no = 0").select("file", F.col("f").alias("head"))
    body = rows.where("line_no > 0").join(head, "file")
    shift = F.size("f") - F.size("head")
    cells = F.transform(F.slice("f", 2, F.size("f")), lambda x, i: F.struct(F.get("head", i + 1 - shift).alias("c"), x.cast("long").alias("n")))
    return body.select(F.get("f", F.lit(0)).alias(row), F.explode(cells).alias("e")).select(row, F.col("e.c").alias(column), F.col("e.n").alias(n))


def assignments(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """query_id, accepted of classifier tables of exactly 4 tab-separated fields."""
    rows = spark.read.text(path).where("value <> ''").withColumn("f", F.split("value", "\t"))
    f = F.when(F.size("f") == 4, F.col("f")).otherwise(_fail("an assignment line hasn't 4 fields: ", F.col("value")))
    return rows.withColumn("f", f).select(F.get("f", F.lit(0)).alias("query_id"), F.get("f", F.lit(3)).alias("accepted"))


def read_calls(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """sample, status, read_id, taxid of per-read classifications."""
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.split("value", "\t").alias("f")).where(F.size("f") >= 3)
    taxid = F.coalesce(F.nullif(F.regexp_extract(F.get("f", F.lit(2)), r"taxid (\d+)", 1), F.lit("")), F.get("f", F.lit(2)))
    return rows.select(sample_of(F.col("file")).alias("sample"), F.get("f", F.lit(0)).alias("status"), F.get("f", F.lit(1)).alias("read_id"), taxid.alias("taxid"))


def runinfo(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.option("header", True).csv(path)


def decision(spark: SparkSession, path: str) -> dict:
    """A small JSON record as a dictionary."""
    row = spark.read.option("multiLine", True).json(path).first()
    return row.asDict(recursive=True) if row else {}
