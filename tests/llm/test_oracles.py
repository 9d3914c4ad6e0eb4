import pytest

from corpusloom.llm import queries

from ..oracle import differences


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_and_sql_agree(spark, name):
    assert differences(queries.QUERIES[name](spark, "/root/testdata/sf0.01"), queries.ORACLES[name], "/root/testdata/sf0.01") == ""
