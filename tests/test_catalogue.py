import pytest

from corpusloom import catalogue

from .oracle import differences

SMALL = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_and_sql_agree(spark, name):
    assert differences(catalogue.QUERIES[name](spark, SMALL), catalogue.ORACLES[name], SMALL) == ""


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_query_runs(spark, name):
    assert catalogue.QUERIES[name](spark, SMALL).count() > 0
