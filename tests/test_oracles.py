"""Every engine query gives what its SQL gives in DuckDB."""

import oracle
import pytest

from taxaspark.plans import registry


@pytest.fixture(scope="module")
def duck(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, duck, sf_dir, name):
    assert oracle.difference(spark, duck, registry.queries()[name], registry.oracle_sql()[name], sf_dir) == ""


def test_entry_and_contract(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0


def test_hll_is_near_exact(spark, sf_dir):
    q = registry.queries()
    near = {r["name"]: r["distinct_parts"] for r in q["clade_distinct_hll"](spark, sf_dir).collect()}
    for r in q["clade_distinct_exact"](spark, sf_dir).collect():
        assert abs(near[r["name"]] - r["distinct_parts"]) <= 0.05 * r["distinct_parts"] + 2
