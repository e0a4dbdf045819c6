"""Every named query against its SQL on an independent engine."""

from __future__ import annotations

import pytest
from oracle_compare import compare

import __spark_entry__ as entry_point
from vellumflow.registry.oracle import ORACLE
from vellumflow.registry.queries import QUERIES


#: An approximate search, held against the exact one in test_vector_index.py.
WITHOUT_SQL = {"indexed_topk"}


def test_every_query_has_sql():
    assert set(QUERIES) - WITHOUT_SQL == set(ORACLE)
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLE) <= set(entry_point.oracle_sql())


def test_entry(spark):
    assert entry_point.entry(spark).count() == 695


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WITHOUT_SQL))
def test_query(spark, sf, con, name):
    count, difference = compare(QUERIES[name](spark, sf), con, ORACLE[name])
    assert difference is None
    # The only queries whose rule selects nothing on the smallest data.
    assert count > 0 or name == "budget_alerts"
