"""Registered queries against their SQL counterparts at the smallest scale."""

import pytest

import __spark_entry__ as entry
from compare import difference
from supplyloom.plans import catalog, oracle

QUERIES, ORACLE = catalog.queries(), oracle.oracle_sql()


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) == {
        "train_link_model", "evaluate_link_model", "param_search", "embedding_projection",
    }


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, sf, name):
    assert difference(spark, name, sf, QUERIES[name], ORACLE[name]) is None


def test_entry(spark):
    out = entry.entry(spark)
    assert out.count() > 0 and "seller_risk_premium" in out.columns
