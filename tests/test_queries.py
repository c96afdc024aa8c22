"""Every core query with SQL gives what DuckDB gives; the others run."""

import pytest

from tests.oracle import same
from voxloom.plans import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_duckdb(spark, data, name):
    same(QUERIES[name](spark, data), SQL[name], data)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, data, name):
    assert QUERIES[name](spark, data).count() > 0


def test_entry(spark, data):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert "release_manifest" in e.queries()
