import pytest
from oracle import same

from kinfold.llm import queries

SQL = queries.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    same(spark, queries.queries(), SQL, name)


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(SQL)))
def test_runs_over_the_small_tables(spark, name):
    assert queries.queries()[name](spark, "/root/testdata/sf0.001").count() > 0
