import pytest

import __spark_entry__ as contract
from check import database, differences

FOLDER = "/root/testdata/sf0.001"
QUERIES = contract.queries()
CHECKS = contract.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return database(FOLDER)


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    if name in CHECKS:
        assert differences(df, db.execute(CHECKS[name])) == []
    else:
        assert df.count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0
