"""Every registered query against its SQL, and the shape of the registry."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from checks.compare import difference, duck
from tests.conftest import SMALL

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_sql_names_are_registered():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    assert difference(spark, con, SMALL, QUERIES[name], SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["event_date", "attack_count", "cumulative_attack_count"]
