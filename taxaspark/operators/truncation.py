"""Truncation lengths of read pairs from quality profiles.

Profiles are (sample, mate, bin_start, bin_end, q1). Bins are cut at the coverage cap, expanded to
positions and reduced to the median over the samples; every further step is an aggregate or a
window over at most a few hundred positions of each mate.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def cap_bins(bins: DataFrame, caps: DataFrame | None) -> DataFrame:
    """Drop bins that start beyond their sample's and mate's cap, end the others at it; null caps do nothing."""
    if caps is None:
        return bins
    rows = bins.join(caps, ["sample", "mate"], "left")
    rows = rows.where(F.col("cap").isNull() | (F.col("bin_start") <= F.col("cap")))
    return rows.withColumn("bin_end", F.least("bin_end", F.coalesce("cap", "bin_end"))).drop("cap")


def expand_bins(bins: DataFrame) -> DataFrame:
    """One row for each position of each bin."""
    return bins.withColumn("pos", F.explode(F.sequence("bin_start", "bin_end"))).drop("bin_start", "bin_end")


def median_profile(bins: DataFrame, percent: float = 100) -> DataFrame:
    """(mate, pos, q1): median over the samples at positions that enough samples cover."""
    each = expand_bins(bins)
    need = each.groupBy("mate").agg(F.greatest(F.lit(1), F.ceil(F.countDistinct("sample") * F.lit(percent / 100))).alias("_need"))
    per = each.groupBy("mate", "pos").agg(F.median("q1").alias("q1"), F.countDistinct("sample").alias("_n"))
    return per.join(F.broadcast(need), "mate").where("_n >= _need").select("mate", "pos", "q1")


def first_drop(profile: DataFrame, threshold: float) -> DataFrame:
    """(mate, cut, last_pos): the position before the first one below the threshold, else the last."""
    low = F.min(F.when(F.col("q1") < threshold, F.col("pos")))
    return profile.groupBy("mate").agg(F.coalesce(low - 1, F.max("pos")).alias("cut"), F.max("pos").alias("last_pos"))


def raise_cuts(profile: DataFrame, cuts: DataFrame, deficit: int) -> DataFrame:
    """(mate, cut) after adding ``deficit`` bases beyond the cuts, the better next base first.

    Adding greedily by the better next base is taking positions by falling running minimum of each
    mate's tail, mate 1 first on ties. Fewer bases are added if the tails are shorter.
    """
    tails = profile.join(F.broadcast(cuts.select("mate", "cut")), "mate").where("pos > cut")
    run = F.min("q1").over(Window.partitionBy("mate").orderBy("pos"))
    taken = tails.withColumn("_run", run).withColumn("_k", F.row_number().over(Window.orderBy(F.desc("_run"), "mate", "pos"))).where(F.col("_k") <= deficit)
    added = taken.groupBy("mate").agg(F.count("*").alias("added"))
    return cuts.join(F.broadcast(added), "mate", "left").select("mate", (F.col("cut") + F.coalesce("added", F.lit(0))).cast("int").alias("cut"))


def relax_threshold(profile: DataFrame, threshold: float, floor: float, need: int) -> DataFrame:
    """(threshold, cut1, cut2) of the largest lower threshold whose cuts add up to ``need``; no row if none does.

    Thresholds fall by one, the last being the first at or below the floor.
    """
    steps = max(0, math.ceil(threshold - floor))
    values = F.array(*[F.lit(threshold - k) for k in range(1, steps + 1)]) if steps else F.array().cast("array<int>")
    tried = profile.withColumn("threshold", F.explode(values))
    low = F.min(F.when(F.col("q1") < F.col("threshold"), F.col("pos")))
    cuts = tried.groupBy("threshold", "mate").agg(F.coalesce(low - 1, F.max("pos")).alias("cut"))
    both = cuts.groupBy("threshold").agg(F.max(F.when(F.col("mate") == 1, F.col("cut"))).alias("cut1"), F.max(F.when(F.col("mate") == 2, F.col("cut"))).alias("cut2"))
    good = both.where(F.col("cut1") + F.col("cut2") >= need)
    return good.agg(F.max(F.struct("threshold", "cut1", "cut2")).alias("best")).where("best IS NOT NULL").select("best.*")


def ceilings(caps: DataFrame) -> DataFrame:
    """(mate, sample, cap, longest): of each mate the sample with the least cap (sample, mate, cap, longest); without a cap its longest read counts."""
    cap = F.coalesce("cap", "longest")
    best = caps.groupBy("mate").agg(F.min(F.struct(cap.alias("cap"), "sample", "longest")).alias("b"))
    return best.select("mate", "b.sample", "b.cap", "b.longest")


def min_length(marker: str, configured: int, stat: str | None = None, probe: dict | None = None) -> int:
    """Least read length: the configured one, but for ITS that of the probe if a statistic is named and the probe was made."""
    return int(probe[stat]) if marker == "ITS" and stat and probe else int(configured)


def max_length(configured: float | None) -> float:
    """Greatest read length; none is no limit."""
    return math.inf if configured is None else float(configured)


def expected_length(value: object, probe: dict | None = None, stat: str = "p95") -> int:
    """Amplicon length from the setting: a number, a range (its larger end) or ``auto`` (the probe)."""
    if value is None or isinstance(value, bool):
        raise ValueError("expected_length isn't set")
    if isinstance(value, (list, tuple)):
        if len(value) != 2 or not all(isinstance(x, (int, float)) and x > 0 for x in value) or value[0] > value[1]:
            raise ValueError("expected_length as a range needs two rising positive numbers")
        return int(max(value))
    if value == "auto":
        if not probe or not probe.get(stat):
            raise ValueError("expected_length: auto needs a probe with lengths")
        return int(probe[stat])
    if isinstance(value, (int, float)) and 50 <= value <= 10_000:
        return int(value)
    raise ValueError(f"expected_length {value!r} isn't a length")


def pick(profile: DataFrame, threshold: int = 20, floor: int = 15, length: int | None = None, min_overlap: int = 12, policy: str = "raise_trunc", marker: str = "16S") -> dict:
    """Decide the truncation lengths; the result is a small record for the next steps.

    The positions of two reads are at most some hundreds, so the cuts are read to the driver; the
    profile itself is aggregated by Spark.
    """
    record = {"r1": 0, "r2": 0, "mode": "auto", "amplicon_type": marker, "q_threshold_requested": threshold, "q_threshold_used": threshold, "expected_length": length, "min_overlap": min_overlap, "overlap_slack": None}
    if marker == "ITS":
        return record | {"resolved_via": "its_no_truncation"}
    cuts = first_drop(profile, threshold)
    found = {r["mate"]: r for r in cuts.collect()}
    if set(found) != {1, 2}:
        raise ValueError("no positions left below the coverage cap")
    c1, c2 = found[1]["cut"], found[2]["cut"]
    if length is None:
        return record | {"r1": c1, "r2": c2, "resolved_via": "first_drop"}
    need = length + min_overlap
    slack = c1 + c2 - need
    record |= {"overlap_slack": slack}
    if slack >= 0:
        return record | {"r1": c1, "r2": c2, "resolved_via": "first_drop"}
    if policy == "raise_trunc":
        if found[1]["last_pos"] + found[2]["last_pos"] < need:
            raise ValueError("reads are too short for the amplicon: no headroom")
        up = {r["mate"]: r["cut"] for r in raise_cuts(profile, cuts, -slack).collect()}
        return record | {"r1": up[1], "r2": up[2], "resolved_via": "raise_trunc"}
    if policy == "relax_q":
        best = relax_threshold(profile, threshold, floor, need).first()
        if best is None:
            raise ValueError("no threshold down to the floor leaves the overlap")
        return record | {"r1": best["cut1"], "r2": best["cut2"], "q_threshold_used": best["threshold"], "resolved_via": "relax_q"}
    if policy == "error":
        raise ValueError("cuts leave too little overlap")
    raise ValueError(f"unknown policy {policy!r}")
