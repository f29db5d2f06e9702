"""Every registered query against its SQL twin on an independent engine."""

import pytest
from compare import assert_same, connect

import __spark_entry__ as contract
from paylake.oracle import sql
from paylake.queries import registered


@pytest.fixture(scope="module")
def oracle(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(registered()) == set(sql())


@pytest.mark.parametrize("name", sorted(registered()))
def test_query(spark, sf_dir, oracle, name):
    rows = assert_same(registered()[name](spark, sf_dir), oracle, sql()[name])
    assert rows > 0


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == [
        "provider", "total_reached_provider", "total_never_completed", "never_complete_rate_pct",
    ]
    assert frame.count() == 10
