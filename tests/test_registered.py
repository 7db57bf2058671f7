"""Every registered query next to its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare, duck

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    verdict, _, _ = compare(spark, con, SF, QUERIES[name], ORACLE.get(name))
    assert verdict.startswith(("ok", "rows only")), verdict


def test_every_sql_has_its_query():
    assert set(ORACLE) <= set(QUERIES)


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
