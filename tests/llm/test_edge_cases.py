"""Every operator and every stage of the pipeline on nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from taxaspark.llm import decontaminate, exact_dedup, hard_negatives, html_extract, language_crf, mixing, near_dedup, pii, quality_cnn, source_divergence, toxicity, url_filter, warc_bundles

CLASH = ["_id", "_sha", "_k", "_n", "_kept", "_h", "_key", "_text", "_stays", "_s", "_b", "_q", "_salt", "key", "h", "node", "size", "k", "_said", "_Key"]
LONG = " ".join(f"w{i * 7919 % 150_000}" for i in range(150_000))  # 1 MB of varied words
TEXTS = [(1, None), (2, ""), (3, " \n"), (4, "same text of six words here"), (5, "same text of six words here"), (5, "same text of six words here"), (None, "same text of six words here"), (None, None), (-(1 << 62), "another text with some other words"), (6, LONG), (7, "été 日本語 текст")]


def table(spark, rows, clash=CLASH):
    clash = [c for c in clash if c != "_Key"]  # beside _key it can't be selected by name
    full = [(i, t, "en", "src", len(t or ""), *range(len(clash))) for i, t in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` long" for c in clash))


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    """Labels and a benchmark beside which a stage finds what it learns from."""
    home = tmp_path_factory.mktemp("tables")
    labels = [(i, 1, int(i % 4 == 0)) for i in range(400)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{home}/labels.parquet")
    spark.createDataFrame([(1, "What is the capital city of the large country in the north"), (None, "x"), (2, None)], "item_id long, text string").write.parquet(f"{home}/benchmark.parquet")
    return f"file://{home}"


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages(spark, inputs, name, stage):
    docs = table(spark, TEXTS, [c for c in CLASH if c != "_Key"])
    out = stage(spark, docs, inputs)
    rows = out.collect()
    empty = stage(spark, docs.limit(0), inputs)
    assert empty.count() == 0 and empty.columns == out.columns
    if name == "mixing":
        assert len(rows) == len(TEXTS) and {r["size"] for r in rows if r["doc_id"] in (1, 2, 3)} == {0}
        return
    assert out.columns == docs.columns
    assert all(tuple(r)[5:] == tuple(range(len(CLASH) - 1)) for r in rows)  # no column of the user's is touched
    ids = sorted((r["doc_id"] for r in rows), key=str)
    every = sorted((i for i, _ in TEXTS), key=str)
    if name in ("toxicity", "decontamination"):
        assert ids == every
    elif name == "exact_dedup":
        assert ids == sorted([1, 3, 4, -(1 << 62), 6, 7], key=str)
    elif name == "near_dedup":  # rows without an id or without words stay
        assert ids == sorted([1, 2, 3, 4, None, None, -(1 << 62), 6, 7], key=str)


def operators():
    docs = lambda f: lambda spark, rows: f(table(spark, rows))
    pages = lambda f: lambda spark, rows: f(spark, table(spark, rows).select(F.col("doc_id").alias("page_id"), F.concat(F.lit("http://h/"), F.col("doc_id").cast("string")).alias("url"), F.col("text").alias("html"), *[f"`{c}`" for c in CLASH if c != "_Key"]))
    bench = lambda d: d.sparkSession.createDataFrame([(1, "same text of six words here")], "item_id long, text string")
    labels = lambda d: d.sparkSession.createDataFrame([(i, int(i < 5)) for i in range(9)], "doc_id long, toxic int")
    return {
        "html": (pages(lambda s, p: html_extract.extract(p)), 1),
        "url": (pages(lambda s, p: url_filter.judge(p, url_filter.fit(url_filter.labelled_urls(s, 300), trees=2))), 1),
        "toxicity": (docs(lambda d: toxicity.score(d, toxicity.fit(d, labels(d)))), 1),
        "exact": (docs(exact_dedup.deduplicate), 1),
        "near": (docs(near_dedup.classes), 1),
        "warc": (pages(warc_bundles.archive), 1),
        "mixing": (docs(mixing.mix), 1),
        "pii": (docs(pii.replace), 1),
        "language": (docs(lambda d: language_crf.identify(d, language_crf.fit(d))), 1),
        "quality": (docs(lambda d: quality_cnn.score(d, quality_cnn.fit(d, labels(d).selectExpr("doc_id", "toxic AS quality"), steps=5))), 1),
        "divergence": (docs(source_divergence.audit), 0),
        "negatives": (docs(lambda d: hard_negatives.mine(hard_negatives.quantised(d.selectExpr("doc_id AS vec_id", "array(1.0D) AS embedding", "1 AS label", "_k", "_n")))), 0),
        "decontaminate": (docs(lambda d: decontaminate.contaminated(d, bench(d))), 4),
    }


@pytest.mark.parametrize("name", sorted(operators()))
def test_operators(spark, name):
    run, kind = operators()[name]
    rows = run(spark, TEXTS)
    assert rows.count() == (len(TEXTS) if kind == 1 else kind)
    none = run(spark, [])
    assert none.count() == 0 and none.columns == rows.columns
