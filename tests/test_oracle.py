"""Every registered query against its SQL on the smallest driver tables."""

import pytest
from compare import connect, differences

from __spark_entry__ import entry, oracle_sql, queries
from vendora.oracle import ORACLE
from vendora.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


def test_entry_returns_months(spark):
    assert entry(spark).count() == 80


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, ORACLE[name]) == []
