"""Every registered query against its SQL counterpart on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry
from daypanel.catalog.oracles import ORACLES
from daypanel.catalog.queries import QUERIES
from tests.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"
# Products of whole tables, and rows that leave the JVM.
UNWANTED = ["CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow", "MapPartitions"]
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not there")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in UNWANTED if node in plan]
    assert differences(df, con, ORACLES[name]) == []


@pytest.mark.parametrize("name", ["gap_fill", "prev_day_delta", "dim_upsert", "lookup_left_join", "view_nytcounties", "cdataset_raw"])
def test_query_with_shuffled_joins(spark, con, name):
    """The plans that large tables get: no side is broadcast by its size."""
    session = spark.newSession()
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    session.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    assert differences(QUERIES[name](session, SF_DIR), con, ORACLES[name]) == []


def test_oracles_share_no_list_with_the_code():
    import ast

    from daypanel.catalog import expected, oracles

    for module, allowed in ((oracles, {"__future__", "daypanel.catalog.expected"}), (expected, {"__future__"})):
        with open(module.__file__) as f:
            nodes = list(ast.walk(ast.parse(f.read())))
        assert {n.module for n in nodes if isinstance(n, ast.ImportFrom)} == allowed
        assert not [n for n in nodes if isinstance(n, ast.Import)]
