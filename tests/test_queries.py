import pytest
from oracle import assert_same

from grafloom.plans import case_queries, graph_queries, io_queries, kg_queries, more_queries, table_queries

QUERIES = kg_queries.QUERIES | more_queries.QUERIES | io_queries.QUERIES | graph_queries.QUERIES | table_queries.QUERIES | case_queries.QUERIES
SQL = kg_queries.ORACLE_SQL | more_queries.ORACLE_SQL | io_queries.ORACLE_SQL | graph_queries.ORACLE_SQL | table_queries.ORACLE_SQL | case_queries.ORACLE_SQL


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    assert_same(spark, QUERIES[name], SQL[name])
