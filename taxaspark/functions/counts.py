"""Column functions for thresholds, ratios and rendered numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Read lengths for which k-mer distributions are shipped.
READ_LENGTHS = [50, 75, 100, 150, 200, 250, 300]


def depth_threshold(classified: Column, alpha: float = 5e-05, least: int = 10) -> Column:
    """Read threshold that grows with depth: alpha times the classified reads, rounded half up."""
    scaled = F.floor(F.lit(alpha) * classified + 0.5).cast("long")
    return F.when(classified > 0, F.greatest(F.lit(least).cast("long"), scaled)).otherwise(F.lit(least).cast("long"))


def nearest_read_length(mean: Column, lengths: list[int] = READ_LENGTHS) -> Column:
    """The shipped length nearest to the mean; of two equally near ones the smaller."""
    each = F.array(*[F.struct(F.pow(mean - n, F.lit(2)).alias("d"), F.lit(n).alias("n")) for n in lengths])
    return F.array_min(each)["n"]


def mean_of_mates(first: Column, second: Column) -> Column:
    return F.floor((first + second) / 2).cast("long")


def ratio_text(x: Column, y: Column, digits: int = 3) -> Column:
    """x / y with fixed digits, ``NA`` if y is 0 or missing."""
    return F.when(y > 0, F.format_string(f"%.{digits}f", x.cast("double") / y)).otherwise("NA")


def or_na(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("NA"))


def minimizer_floor(kmers: float, k: int, l: int) -> float:
    """Distinct minimizers that so many k-mers amount to, by the density 2 / (window + 1)."""
    return kmers * 2 / (k - l + 2)
