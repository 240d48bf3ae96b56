"""Every registered query with a SQL twin, value by value."""

from __future__ import annotations

import check_oracle
import pytest

from workloads.registry import ORACLE, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return check_oracle.connection(sf_dir)


def test_every_twin_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, sf_dir, duck, name):
    found = QUERIES[name](spark, sf_dir).toArrow()
    assert check_oracle.compare(found, duck.sql(ORACLE[name]).to_arrow_table()) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() == 30
    assert set(contract.queries()) >= set(QUERIES)
