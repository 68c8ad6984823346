"""Length statistics: floor-index percentiles, summaries, histograms, windows, coverage caps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PERCENTS = {"q1": 25, "median": 50, "q3": 75, "p95": 95, "p99": 99}


def histogram(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Number of rows for each value: what the other statistics start from, so no list is gathered."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))


def percentiles(df: DataFrame, keys: list[str], value: str, percents: dict[str, int]) -> DataFrame:
    """Floor-index percentiles: the value at index min(floor(p / 100 * n), n - 1) of the sorted values.

    Works on the histogram: the running count of smaller values tells which value holds an index.
    """
    counted = histogram(df, keys, value)
    w = Window.partitionBy(*keys)
    run = counted.withColumns({"_upto": F.sum("n").over(w.orderBy(value)), "_total": F.sum("n").over(w)})
    at = lambda p: F.least(F.floor(F.lit(p / 100) * F.col("_total")), F.col("_total") - 1)
    return run.groupBy(*keys).agg(*[F.min(F.when(F.col("_upto") > at(p), F.col(value))).alias(name) for name, p in percents.items()])


def length_summary(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """n, min, percentiles, max, mean and sample deviation (0 for one value), rounded to 2 digits."""
    plain = df.where(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.count("*").alias("n"), F.min(value).alias("min"), F.max(value).alias("max"), F.round(F.avg(value), 2).alias("mean"), F.round(F.coalesce(F.stddev_samp(value), F.lit(0.0)), 2).alias("stdev")
    )
    return plain.join(percentiles(df, keys, value, PERCENTS), keys)


def coverage_cap(df: DataFrame, keys: list[str], length: str, n: str, percent: float) -> DataFrame:
    """Largest length that at least ``percent`` of the reads reach; null if there are no reads."""
    w = Window.partitionBy(*keys)
    counted = df.groupBy(*keys, length).agg(F.sum(n).alias("_n"))
    run = counted.withColumns({"_reach": F.sum("_n").over(w.orderBy(F.desc(length))), "_all": F.sum("_n").over(w)})
    return run.groupBy(*keys).agg(F.max(F.when((F.col("_all") > 0) & (F.col("_reach") >= F.col("_all") * F.lit(percent / 100)), F.col(length))).alias("cap"))


def resolve_window(mode: str, fixed: tuple[int, int] | None, summary: dict | None, margin: int, expected: int | None) -> tuple[int, int]:
    """Length window by priority: a given range, the probe's quartile and 95th percentile, 15 % around the expected length."""
    if fixed is not None:
        if len(fixed) != 2:
            raise ValueError("a length range has two ends")
        return int(fixed[0]), int(fixed[1])
    if mode == "auto" and summary and summary.get("n"):
        return summary["q1"] - margin, summary["p95"] + margin
    if mode == "auto" and expected:
        return int(0.85 * expected // 1), -int(-1.15 * expected // 1)
    raise ValueError("no length window: give a range, a probe or an expected length")


def window_columns(q1: Column, p95: Column, expected: Column, margin: int) -> tuple[Column, Column]:
    """The same as columns: the probe if it is there, else the expected length."""
    low = F.coalesce(q1 - margin, F.floor(0.85 * expected).cast("int"))
    return low, F.coalesce(p95 + margin, F.ceil(1.15 * expected).cast("int"))


def keep_lengths(df: DataFrame, length: Column, low: Column | int, high: Column | int) -> DataFrame:
    return df.where((length >= low) & (length <= high))


def plot_bins(df: DataFrame, length: str, bins: int = 60) -> DataFrame:
    """Plot data of a length histogram: about ``bins`` bins of equal whole width."""
    ends = df.agg(F.min(length).alias("lo"), F.max(length).alias("hi")).withColumn("w", F.greatest(F.lit(1), F.floor((F.col("hi") - F.col("lo")) / bins)).cast("int"))
    rows = df.join(F.broadcast(ends))  # one row
    return rows.groupBy((F.col("lo") + F.floor((F.col(length) - F.col("lo")) / F.col("w")) * F.col("w")).cast("long").alias("bin_start"), F.col("w").alias("bin_width")).agg(F.count("*").alias("n"))
