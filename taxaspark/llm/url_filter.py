"""URL filter: path rules first, gradient-boosted trees on lexical features for the rest.

The trees are Spark ML's GBTClassifier, trained from labelled URLs. Features are computed by
built-in functions: length, depth, digit ratio, character entropy, parameter counts, label and
hyphen counts of the host, suffix statistics (the smoothed block rate of the host's last one and
last two labels in the labelled URLs) and the same of the host's words.
"""

from __future__ import annotations

import string

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaspark.llm.common import cut, join_checked

# The rules of the contract, as host and path prefix.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

# Name parts that block lists of adult, gambling, pharmacy, advert and spam hosts
# share, name parts of ordinary hosts, and syllables of invented names.
UNWANTED = "ads adult bet bets bonus casino cheap click crypto dating farm free jackpot loan lottery pills pharma poker popunder porn promo sex slots spam track viagra win xxx".split()
ORDINARY = "archive blog books city daily docs forum garden guide history journal library live maps museum music news open paper photo radio review school science sport story travel weather wiki".split()
SYLLABLES = "ar be co da el fi go ha in ka lo mi na or pe ra si ta un ve wi zu".split()
# Host suffixes, equally known to both classes, seen more with blocked hosts, and more with others.
NEUTRAL, CHEAP, ESTABLISHED = "com example.com example.org example.net net de".split(), "xyz top click info biz online".split(), "org edu gov fr eu museum".split()

FEATURES = ["length", "host_length", "path_length", "depth", "digit_ratio", "entropy", "n_params", "n_labels", "n_hyphens", "host_digit_ratio", "suffix1_rate", "suffix2_rate", "word_rate"]
#: Share of labelled URLs that fit the model; the others, by a hash of the URL, measure it.
TRAINING_SHARE = 0.7


def labelled_urls(spark: SparkSession, n: int = 4_000) -> DataFrame:
    """``n`` labelled URLs (url, label: 1 blocked), drawn by a hash of their number; the tables label none.

    Every trait that block lists are known for is more frequent in one class and occurs in both: unwanted words,
    hyphens, digits in the host, cheap suffixes, deep paths, random path parts and many parameters.
    So no single feature tells the classes apart; some URLs can't be told apart by any.
    """
    i = F.col("id")
    draw = lambda k: F.pmod(F.xxhash64(i, F.lit(k)), F.lit(1_000_003)) / 1_000_003.0
    pick = lambda k, values: F.element_at(F.array(*[F.lit(v) for v in values]), (F.floor(draw(k) * len(values)) + 1).cast("int"))
    bad = F.col("label") == 1
    odds = lambda k, blocked, other: draw(k) < F.when(bad, blocked).otherwise(other)
    invented = lambda k: F.concat(*[pick(k + j, SYLLABLES) for j in range(3)])
    word = lambda k: F.when(odds(k, 0.72, 0.04), pick(k + 1, UNWANTED)).when(odds(k + 2, 0.35, 0.6), pick(k + 3, ORDINARY)).otherwise(invented(k + 4))
    host = F.concat(
        F.element_at(F.array(*[F.lit(x) for x in ("www.", "", "m.", "blog.")]), (F.floor(draw(1) * 4) + 1).cast("int")),
        word(10), F.when(odds(2, 0.55, 0.15), "-").otherwise(""), F.when(odds(3, 0.75, 0.6), word(20)).otherwise(""),
        F.when(odds(4, 0.35, 0.07), F.floor(draw(5) * 1000).cast("string")).otherwise(""), F.lit("."),
        F.when(odds(6, 0.4, 0.03), pick(7, CHEAP)).when(odds(8, 0.12, 0.4), pick(9, ESTABLISHED)).otherwise(pick(30, NEUTRAL)),
    )
    depth = F.floor(draw(40) * F.when(bad, 4.6).otherwise(3.8)).cast("int")
    step = lambda j: F.when(odds(50 + 3 * j, 0.35, 0.08), F.substring(F.md5(F.concat(i.cast("string"), F.lit(f":{j}"))), 1, 12)).when(draw(51 + 3 * j) < 0.5, pick(52 + 3 * j, ["en", "de", "fr", "es"])).otherwise(F.floor(draw(52 + 3 * j) * 1000).cast("string"))
    path = F.concat_ws("/", F.slice(F.array(*[step(j) for j in range(5)]), F.lit(1), depth))
    params = F.floor(draw(41) * F.when(bad, 3.4).otherwise(2.6)).cast("int")
    query = F.array_join(F.slice(F.array(*[F.concat(F.lit(f"{name}="), F.floor(draw(70 + j) * 10_000).cast("string")) for j, name in enumerate(("id", "ref", "page", "utm_source"))]), F.lit(1), params), "&")
    tail = F.element_at(F.array(*[F.lit(x) for x in ("", "/", ".html", "#top")]), (F.floor(draw(42) * 4) + 1).cast("int"))
    url = F.concat(F.when(draw(43) < 0.5, "http://").otherwise("https://"), host, F.lit("/"), path, F.when(depth > 0, tail).otherwise(""), F.when(params > 0, F.concat(F.lit("?"), query)).otherwise(""))
    return spark.range(n).withColumn("label", (F.col("id") % 3 == 0).cast("int")).select(url.alias("url"), "label")


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without ``://``."""
    after = F.when(F.locate("://", url) > 0, F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise(F.lit(""))
    raw = F.regexp_extract(after, r"^[^/?#]*", 0)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(raw, string.ascii_uppercase, string.ascii_lowercase), F.lit("")), F.coalesce(path, F.lit(""))


def host_words(host: Column) -> Column:
    """Words of a host before its suffix: its runs of letters in all labels but the last."""
    return F.array_distinct(F.regexp_extract_all(F.regexp_replace(host, r"(?:^|\.)[^.]*$", ""), F.lit(r"\p{L}++"), 0))


def _keys(host: Column) -> Column:
    """Suffixes of one and two labels, and words, of a host, with what they are."""
    suffix = lambda k: F.struct(F.lit(f"s{k}").alias("of"), F.concat(F.lit("."), F.substring_index(host, ".", -k)).alias("key"))
    return F.concat(F.array(suffix(1), suffix(2)), F.transform(host_words(host), lambda w: F.struct(F.lit("w").alias("of"), w.alias("key"))))


class Rates:
    """Block rate of every host suffix and host word in the labelled URLs, smoothed by the overall rate; none is left out.

    They are looked up once for each distinct host, by joins.
    """

    def __init__(self, labelled: DataFrame, weight: float = 5.0) -> None:
        total = labelled.agg(F.avg("label")).first()[0]
        self.default, self.weight = 0.5 if total is None else float(total), weight
        keys = F.transform(_keys(F.col("host")), lambda e: e["key"])
        self.table = cut(labelled.select("label", F.explode(F.array_distinct(keys)).alias("key")).groupBy("key").agg(F.sum("label").alias("bad"), F.count("*").alias("n")))

    def add(self, urls: DataFrame) -> DataFrame:
        """suffix1_rate, suffix2_rate and word_rate (the highest of the host's words); with a ``label`` without the row's own share."""
        own, one = (F.col("label"), 1) if "label" in urls.columns else (F.lit(0.0), 0)
        rate = lambda e: F.when(e.isNotNull(), (e["bad"] - own + self.weight * self.default) / (e["n"] - one + self.weight)).otherwise(self.default)
        each = urls.select("host").distinct().select("host", F.explode(_keys(F.col("host"))).alias("e")).select("host", "e.*")
        met = join_checked(each, self.table, ["key"])
        smoothed = (F.col("bad") + self.weight * self.default) / (F.col("n") + self.weight)
        best = [F.max_by(F.when(F.col("of") == k, F.struct("bad", "n")), F.when(F.col("of") == k, F.struct(smoothed, "n"))).alias(f"_{k}") for k in ("s1", "s2", "w")]
        seen = cut(met.groupBy("host").agg(*best))
        urls = join_checked(urls, seen, ["host"], "left")
        return urls.withColumns({"suffix1_rate": rate(F.col("_s1")), "suffix2_rate": rate(F.col("_s2")), "word_rate": rate(F.col("_w"))}).drop("_s1", "_s2", "_w")


def with_features(urls: DataFrame, rates: Rates) -> DataFrame:
    """Add the feature columns to a table with columns url, host, path, perhaps label."""
    url = F.coalesce("url", F.lit(""))
    n = F.greatest(F.length(url), F.lit(1))
    count = lambda c, pattern: F.length(c) - F.length(F.regexp_replace(c, pattern, ""))
    chars = F.split(url, "")
    entropy = F.aggregate(F.transform(F.array_distinct(chars), lambda c: F.length(url) - F.length(F.replace(url, c, F.lit("")))), F.lit(0.0), lambda a, k: a - F.when(k > 0, k / n * F.log2(k / n)).otherwise(0.0))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return rates.add(urls).withColumns(
        {
            "length": F.length(url).cast("double"),
            "host_length": F.length("host").cast("double"),
            "path_length": F.length("path").cast("double"),
            "depth": count(F.col("path"), "/").cast("double"),
            "digit_ratio": count(url, r"[0-9]") / n,
            "entropy": F.coalesce(entropy, F.lit(0.0)),
            "n_params": F.when(query == "", 0.0).otherwise(count(query, "&") + 1.0),
            "n_labels": (count(F.col("host"), r"\.") + 1).cast("double"),
            "n_hyphens": count(F.col("host"), "-").cast("double"),
            "host_digit_ratio": count(F.col("host"), r"[0-9]") / F.greatest(F.length("host"), F.lit(1)),
        }
    )


class UrlModel:
    """Fitted trees with the statistics that their features need, and how they did on labelled URLs that were held out."""

    def __init__(self, trees: GBTClassificationModel, rates: Rates, accuracy: float | None, n_held_out: int) -> None:
        self.trees, self.rates, self.accuracy, self.n_held_out = trees, rates, accuracy, n_held_out

    def importances(self) -> dict[str, float]:
        return dict(zip(FEATURES, self.trees.featureImportances.toArray().tolist(), strict=True))

    def transform(self, rows: DataFrame) -> DataFrame:
        """``rows`` (url, host, path) with block_probability."""
        scored = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(with_features(rows, self.rates))
        return self.trees.transform(scored).withColumn("block_probability", vector_to_array("probability")[1])


def fit(labelled: DataFrame, max_rows: int = 50_000, trees: int = 16, depth: int = 4, training_share: float = TRAINING_SHARE, measure: bool = False) -> UrlModel:
    """Train on labelled URLs (url, label 0/1); beyond ``max_rows`` a sample by hash is taken.

    ``training_share`` of them fit the trees and the statistics (each row without its own share of these); with
    ``measure`` the others give ``accuracy``.
    """
    rows = labelled.where("url IS NOT NULL AND label IS NOT NULL").select("url", F.col("label").cast("double").alias("label"))
    n = rows.count()
    if n > max_rows:
        rows = rows.where(F.pmod(F.xxhash64("url"), F.lit(1 << 20)) < F.lit(int((1 << 20) * max_rows / n)))
    host, path = parts(F.col("url"))
    rows = cut(rows.withColumns({"host": host, "path": path, "_u": F.pmod(F.xxhash64("url", F.lit(5)), F.lit(1000)) / 1000.0}))
    known = rows.where(F.col("_u") < training_share)
    rates = Rates(known)
    train = cut(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(with_features(known, rates)).select("features", "label").coalesce(1)).cache()
    model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, maxBins=32, featureSubsetStrategy="onethird", subsamplingRate=0.8, seed=17, checkpointInterval=-1).fit(train)
    train.unpersist()
    fitted = UrlModel(model, rates, None, 0)
    if measure:
        seen = fitted.transform(rows.where(F.col("_u") >= training_share).select("url", "host", "path", F.col("label").alias("_y")))
        right = seen.agg(F.avg(((F.col("block_probability") >= 0.5) == (F.col("_y") == 1)).cast("double")), F.count("*")).first()
        fitted.accuracy, fitted.n_held_out = right[0], right[1]
    return fitted


def judge(pages: DataFrame, model: UrlModel, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, block_probability for every row.

    A rule fits its host and all subdomains if the path starts with the rule's; the longest fitting
    rule decides (of equally long ones the first listed). Rows without a fitting rule, null and
    malformed URLs too, get the trees' verdict: block at a probability of at least one half.
    Other columns are ignored; repeated rows repeat; an empty table gives an empty result.
    """
    host, path = parts(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url")).withColumns({"host": host, "path": path})
    ranked = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    fits = [((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p) for _, h, p in ranked]
    rule = F.coalesce(*[F.when(f, F.lit(h + p)) for f, (_, h, p) in zip(fits, ranked, strict=True)], F.lit(None).cast("string"))
    said = F.coalesce(*[F.when(f, F.lit(v)) for f, (v, _, _) in zip(fits, ranked, strict=True)], F.lit(None).cast("string"))
    scored = model.transform(rows.withColumns({"rule": rule, "said": said}))
    return scored.select("page_id", "host", "path", "rule", F.coalesce("said", F.when(F.col("block_probability") >= 0.5, "block").otherwise("allow")).alias("verdict"), "block_probability")
