import pytest

from __spark_entry__ import SMOKE_DIR, entry, oracle_sql
from __spark_entry__ import queries as all_queries
from strata.plans.oracles import ORACLES
from strata.plans.registered import REGISTERED
from strata.specs import GOLD
from tests.support import compare, duck, plan


@pytest.fixture(scope="module")
def con():
    return duck(SMOKE_DIR)


def queries():
    """Those of the layers; others that the entry file may add have tests of their own."""
    return {name: query for name, query in all_queries().items() if name in REGISTERED}


def test_every_query_has_sql():
    assert set(REGISTERED) == set(ORACLES)
    assert set(REGISTERED) <= set(all_queries()) and set(ORACLES) <= set(oracle_sql())


def test_entry_is_the_enriched_table(spark):
    assert entry(spark).columns == GOLD.fieldNames()
    assert not entry(spark).isEmpty()


@pytest.mark.parametrize("name", list(queries()))
def test_query_equals_its_sql(spark, con, name):
    assert compare(queries()[name](spark, SMOKE_DIR), con, oracle_sql()[name]) is None


def test_flagship_reads_only_what_it_needs(spark):
    text = plan(entry(spark))
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_extendedprice:double>" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text


def test_no_query_needs_a_cross_join_or_python(spark):
    for name, query in queries().items():
        if name.startswith(("enrich", "quality", "typed", "step", "match", "loss", "integrity")):
            text = plan(query(spark, SMOKE_DIR))
            assert "CartesianProduct" not in text and "NestedLoop" not in text, name
            assert "Python" not in text, name
