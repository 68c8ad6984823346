import hashlib
import re

from taxaspark.llm import exact_dedup as E

ROWS = [(5, "a  b"), (3, "a\tb"), (9, "a b "), (4, None), (2, ""), (7, "\n"), (8, " "), (5, "c"), (5, "c"), (None, "a b"), (1, "x " * 100_000), (6, "x\n" * 100_000), (10, "é"), (11, "a\u00a0b")]


def plain(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    out = []
    for i, t in rows:
        g = [x for x in groups[norm(t)] if x is not None]
        keep = min(g) if g else None
        out.append((i, keep, len(groups[norm(t)]), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_every_row_against_plain_code(docs):
    for parts in (1, 3, 20):
        got = [tuple(r[c] for c in ("doc_id", "keep_id", "group_size", "kept", "text_sha256")) for r in E.deduplicate(docs(ROWS).repartition(parts), fan_in=2).collect()]
        assert sorted(got, key=repr) == plain(ROWS)


def test_large_group_and_drop(docs):
    rows = [(i, "same text" if i % 3 else f"own {i}") for i in range(9000)]
    out = E.deduplicate(docs(rows).repartition(7))
    assert out.where("group_size = 6000 AND keep_id = 1").count() == 6000
    kept = E.drop_copies(docs(rows))
    assert kept.count() == 3001 and kept.columns == docs([]).columns
    small = [r["doc_id"] for r in E.drop_copies(docs(ROWS)).collect()]
    assert sorted(small, key=str) == sorted([3, 9, 2, 7, 5, 1, 10, 11], key=str)


def test_runs_are_sorted_and_merged_in_rounds(spark, docs):
    rows = [(i, f"text {i % 97}") for i in range(1000)]
    runs = E.cut(E.sorted_runs(E.digests(docs(rows).repartition(6))))
    by_run = {}
    for r in runs.collect():
        by_run.setdefault(r["run"], []).append(r)
    assert len(by_run) > 1 and sum(r["group_size"] for r in runs.collect()) == 1000
    for own in by_run.values():
        keys = [r["text_sha256"] for r in own]
        assert keys == sorted(set(keys))  # sorted, one row for each digest
    merged = E.merge_runs(runs, max(by_run), 2, 8)
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    rounds, last = 1, max(by_run) // 2
    while last:
        rounds, last = rounds + 1, last // 2
    assert plan.count("Sort [") == rounds == plan.count("MapInArrow") == plan.count("RepartitionByExpression")
    assert sorted((r["keep_id"], r["group_size"]) for r in merged.collect()) == [(k, len(range(k, 1000, 97))) for k in range(97)]


def test_groups_over_many_batches(spark, docs):
    rows = [(i, f"text {i % 5}") for i in range(300)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = E.deduplicate(docs(rows).repartition(3)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"]) for r in got) == [(i, i % 5, 60) for i in range(300)]


def test_clashing_names(spark):
    rows = [(i, "t", *range(7)) for i in (2, 1, -(1 << 62), None, None)] + [(7, "other", *range(7))] * 2
    names = ["_id", "_sha", "_k", "_n", "_kept", "_text", "_stays"]
    d = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} long" for n in names))
    kept = E.drop_copies(d)
    assert kept.columns == d.columns and sorted(tuple(r) for r in kept.collect()) == [(-(1 << 62), "t", *range(7)), (7, "other", *range(7))]


def test_empty(docs):
    assert E.deduplicate(docs([])).count() == 0 and E.drop_copies(docs([])).count() == 0
