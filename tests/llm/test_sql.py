import pytest
from oracle import assert_same

from grafloom.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query(spark, name):
    assert_same(spark, queries.QUERIES[name], queries.ORACLE_SQL[name])


def test_one_query_an_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
