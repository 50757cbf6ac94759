"""Every catalog query against its SQL on the smallest tables."""

import pytest
from compare import compare, connect

import __spark_entry__ as contract
from tripwright import catalog

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.oracle_sql())
    assert set(catalog.QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, con, name):
    sql = contract.oracle_sql()[name]
    assert compare(spark, con, FOLDER, name, contract.queries()[name], sql) == ""


def test_expected_rule_counts(spark):
    rows = contract.queries()["rule_counts"](spark, FOLDER).collect()
    assert {r.rule: r.n for r in rows} == dict(
        enumerate((114, 365, 48, 163, 418, 104, 96, 1187, 271), 1)
    )


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert sum(r.n for r in rows) == 5 * 3234
