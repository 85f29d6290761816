"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from check_oracle import compare, connect

NAMES = [q for q in contract.queries() if q in contract._registry.QUERIES]


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert {r.admission_type_group for r in rows} == {"Emergency", "Urgent", "Elective", "Newborn", "Other_Unknown"}


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, small, duck, name):
    df = contract.queries()[name](spark, small)
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(duck, df, sql) is None
