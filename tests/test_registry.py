import pytest

from broadsheet.registry import QUERIES
from tests.check_registry import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql is not None])
def test_query_equals_its_sql_twin(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], SF).startswith("ok")


def test_entry_and_contract(spark):
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) <= set(contract.queries())
    df = contract.entry(spark)
    assert df.columns == ["page_id", "url", "source", "label", "headline"] and df.count() > 0
