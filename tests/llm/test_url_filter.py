import re

import pytest
from pyspark.sql import functions as F

from taxaspark.llm import url_filter as U

URLS = [
    None, "", "nonsense", "http://", "HTTP://WWW.Example.NET/EN/x", "https://a.example.net/en/1?q=2#z", "http://example.net/fr/1", "http://net/", "http://net?x", "http://x.example.com/de/9",
    "http://xexample.com/de/9", "https://www.site.org/fr/8", "https://www.site.org/en/8", "https://a.b/c://d", "https://cheap-pills.example.com/en/4", "http://üñ.net/é", "http://a.com/" + "x/" * 3000,
]


def plain(url):
    """Host, path and rule computed one by one."""
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    raw = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(raw) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), raw)
    fit = [(v, h, p) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, key=lambda r: len(r[1] + r[2]), default=None)
    return host, path, best and best[1] + best[2], best and best[0]


@pytest.fixture(scope="module")
def model(spark):
    return U.fit(U.labelled_urls(spark), measure=True)


def test_rules_against_plain_code(spark, model):
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    for r in U.judge(df, model).collect():
        host, path, rule, said = plain(URLS[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == said if said else r["verdict"] in ("allow", "block")
    assert U.judge(df.limit(0), model).count() == 0


def test_trees_learn_from_several_features(spark, model):
    assert model.n_held_out > 1000 and model.accuracy >= 0.85
    importance = model.importances()
    assert abs(sum(importance.values()) - 1) < 1e-6 and max(importance.values()) < 0.6 and sum(v > 0.02 for v in importance.values()) >= 5
    new = ["http://www.free-bonus.xyz/3a5f9c0d1e2b/5?id=1&ref=2&page=3", "https://casino24.info/en/77?id=9&ref=8", "https://museum.org/en/5", "http://blog.citygarden.de/en/", "https://thther.example.org/en/5"]
    rows = spark.createDataFrame(list(enumerate(new)), "page_id long, url string")
    assert [r["verdict"] for r in U.judge(rows, model, rules=[]).orderBy("page_id").collect()] == ["block", "block", "allow", "allow", "allow"]


def test_trees_against_a_plain_walk(spark, model):
    """Features and boosted trees computed one by one from the model's saved nodes."""
    import math

    rows = [r["url"] for r in U.labelled_urls(spark, 60).collect()] + [u for u in URLS if u]
    table = {r["key"]: (r["bad"], r["n"]) for r in model.rates.table.collect()}
    d, w = model.rates.default, model.rates.weight
    rate = lambda key: (table[key][0] + w * d) / (table[key][1] + w) if key in table else d

    def features(url):
        host, path, _, _ = plain(url)
        n = max(1, len(url))
        labels = host.split(".")
        query = re.search(r"\?([^#]*)", url)
        query = query[1] if query else ""
        entropy = -sum(url.count(c) / n * math.log2(url.count(c) / n) for c in set(url))
        digits = lambda t: len(re.findall("[0-9]", t))
        words = [x for x in re.findall(r"[^\W\d_]+", ".".join(labels[:-1]))]
        known = [rate(x) for x in words if x in table]
        return [len(url), len(host), len(path), path.count("/"), digits(url) / n, entropy, query.count("&") + 1 if query else 0, len(labels), host.count("-"), digits(host) / max(1, len(host)), rate("." + labels[-1]), rate("." + ".".join(labels[-2:])), max(known, default=d)]

    def score(x):
        total = 0.0
        for tree, weight in zip(model.trees.trees, model.trees.treeWeights):
            node = tree._call_java("rootNode")
            while node.numDescendants() > 0:
                split = node.split()
                node = node.leftChild() if x[split.featureIndex()] <= split.threshold() else node.rightChild()
            total += weight * node.prediction()
        return 1 / (1 + math.exp(-2 * total))

    out = U.judge(spark.createDataFrame(list(enumerate(rows)), "page_id long, url string"), model, rules=[])
    for r in out.collect():
        assert abs(r["block_probability"] - score(features(rows[r["page_id"]]))) < 1e-9
