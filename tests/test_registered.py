"""Every registered query against its SQL, at the smallest scale."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.queries import REGISTRY
from checks.sql import SQL
from tests.oracle import connect, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


#: Queries that SQL cannot express in bounded time; each is compared with brute force elsewhere in the tests.
BRUTE_FORCE = {"ucc_discovery_lineitem", "fd_discovery_lineitem"}


def test_every_query_has_sql_or_brute_force():
    assert set(REGISTRY) == set(SQL) | BRUTE_FORCE and not BRUTE_FORCE & set(SQL)
    assert set(REGISTRY) <= set(queries()) and set(SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    assert differences(queries()[name](spark, SF_DIR), con, oracle_sql()[name]) is None


def test_entry(spark):
    assert set(entry(spark).select("change_op").distinct().toPandas()["change_op"]) == {"INSERT", "UPDATE", "DELETE"}
