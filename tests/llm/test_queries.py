import pytest

from logloom.llm import queries
from tests.oracle import compare, connect

QUERIES, ORACLE = queries.queries(), queries.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, name, QUERIES[name], ORACLE[name]) > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_stages_keep_the_columns(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, sf_dir)
        assert after.columns == docs.columns and after.count() > 0
        kept = after
