import corpus_pipeline as C
import pytest

from taxaspark.llm import decontaminate, exact_dedup, near_dedup, toxicity
from taxaspark.llm.common import read
from taxaspark.llm.queries import queries


def test_stages_follow_each_other(spark, sf_dir):
    assert [n for n, _ in C.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "mixing"]
    docs = read(spark, sf_dir, "documents")
    columns = docs.columns
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == columns
        ids = {r["doc_id"] for r in out.collect()}
        before = {r["doc_id"] for r in docs.collect()}
        if name == "toxicity":
            bad = {r["doc_id"] for r in toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels"))).where("predicted = 1").collect()}
        elif name == "exact_dedup":
            bad = {r["doc_id"] for r in exact_dedup.deduplicate(docs).where("NOT kept").collect()}
        elif name == "near_dedup":
            bad = {r["doc_id"] for r in near_dedup.classes(docs).where("NOT kept").collect()}
        else:
            bad = {r["doc_id"] for r in decontaminate.contaminated(docs, read(spark, sf_dir, "benchmark")).collect()}
        assert ids == before - bad
        docs = spark.createDataFrame(out.collect(), out.schema)
    last = {r["doc_id"]: r["taken"] for r in C.STAGES[-1][1](spark, docs, sf_dir).collect()}
    assert {r["doc_id"]: r["taken"] for r in C.run(spark, sf_dir).collect()} == last


@pytest.mark.parametrize("name", sorted(queries()))
def test_queries_run_on_the_tables(spark, sf_dir, name):
    out = queries()[name](spark, sf_dir)
    table = "pages" if name.split("_")[0] in ("op1", "op2", "op6") else "documents"
    n = out.count()
    assert n > 0 and (name.startswith("op10_") or n == read(spark, sf_dir, table).count())
