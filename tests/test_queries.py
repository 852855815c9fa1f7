"""Every driver query against its DuckDB counterpart."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry
from resultlake.queries.catalog import QUERIES
from resultlake.queries.oracles import ORACLES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_dir, name):
    found = entry.queries()[name](spark, sf_dir)
    plan = found._jdf.queryExecution().executedPlan().toString()
    # No pairing of everything with everything, no Python but the page reader.
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert bad not in plan
    assert compare(found, connect(sf_dir), entry.oracle_sql()[name]) == ""


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["page_id", "order", "text", "link"]
