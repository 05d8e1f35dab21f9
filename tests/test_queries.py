"""Every registered query against DuckDB, or, where SQL has no answer, that it yields rows."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import compare, duck


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)




@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_equals_sql(spark, sf_dir, con, name):
    differences = compare(queries()[name](spark, sf_dir), con, oracle_sql()[name])
    assert not differences, differences


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_yields_rows(spark, sf_dir, name):
    assert queries()[name](spark, sf_dir).limit(1).count() == 1


def test_entry(spark):
    assert entry(spark).count() > 0


def test_sql_has_its_query():
    assert set(oracle_sql()) <= set(queries())
