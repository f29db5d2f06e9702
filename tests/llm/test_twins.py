"""Registered queries against their SQL twins on an independent engine."""

import pytest
from compare import assert_same, connect

import __spark_entry__ as contract
from paylake.llm.queries import registered, sql


@pytest.fixture(scope="module")
def oracle(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(sql()))
def test_query(spark, sf_dir, oracle, name):
    assert assert_same(registered()[name](spark, sf_dir), oracle, sql()[name]) > 0


def test_all_are_registered():
    names = contract.queries()
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14))
    assert "pipeline" in names
    assert set(sql()) <= set(contract.oracle_sql())
