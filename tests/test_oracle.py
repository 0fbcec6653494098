"""Every catalogue query against its SQL twin."""

from __future__ import annotations

import pytest
from compare import compare, connect

import __spark_entry__ as entry_module

# the queries of the subpackage llm have tests of their own
QUERIES, ORACLE = entry_module.CATALOGUE, entry_module.ORACLE


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


def test_entry_returns_rows(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_twin(spark, sf_dir, connection, name):
    assert compare(QUERIES[name](spark, sf_dir), connection, ORACLE[name]) == []
