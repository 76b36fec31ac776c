import pytest
from oracle import same

from kinfold.plans import queries as core
from kinfold.plans import reference, reference_sql

QUERIES, SQL = core.queries() | reference.queries(), core.oracle_sql() | reference_sql.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    same(spark, QUERIES, SQL, name)


def test_every_query_is_registered_once():
    import __spark_entry__

    assert set(SQL) <= set(QUERIES) <= set(__spark_entry__.queries())
