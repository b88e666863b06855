import pytest
from compare import connection, rows_of_spark, rows_of_sql

from strandline.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connection(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, duck, name):
    got = rows_of_spark(QUERIES[name](spark, SF))
    if name in ORACLES:
        assert got == rows_of_sql(duck, ORACLES[name])
    else:
        assert got[1]


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
