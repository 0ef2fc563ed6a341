import pytest

from logloom.plans import catalog
from tests.oracle import compare, connect

QUERIES, ORACLE = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, name, QUERIES[name], ORACLE[name]) > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, sf_dir, name):
    assert len(QUERIES[name](spark, sf_dir).collect()) > 0


def test_entry(spark):
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0
