import pytest

from compare import connect, rows_of_spark, rows_of_sql
from frameloom.llm import oracles, queries


@pytest.fixture(scope="module")
def sql(data):
    return connect(data)


@pytest.mark.parametrize("name", list(oracles.oracle_sql()))
def test_matches_sql(spark, data, sql, name):
    assert rows_of_spark(queries.queries()[name](spark, data)) == rows_of_sql(sql, oracles.oracle_sql()[name])


def test_names():
    names = list(queries.queries())
    assert {f"p{n}" for n in range(1, 11)} == {n.split("_")[0] for n in names} and set(oracles.oracle_sql()) <= set(names)
