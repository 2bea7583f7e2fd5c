"""Every registered query against its SQL twin, on the smallest tables."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__ as entry_point
from touchline.plans.registry import QUERIES as OWN
from touchline.session import clear_scratch

QUERIES = entry_point.queries()
ORACLE = entry_point.oracle_sql()


@pytest.fixture(autouse=True)
def cleared(spark):
    yield
    clear_scratch(spark)


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(OWN.keys() & ORACLE.keys()))
def test_matches_sql(spark, duck, sf_dir, name):
    assert compare.check(spark, duck, sf_dir, name, QUERIES, ORACLE) == []


@pytest.mark.parametrize("name", sorted(OWN.keys() - ORACLE.keys()))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).columns


def test_sql_has_queries():
    assert ORACLE.keys() <= QUERIES.keys()


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["match_id", "player_id", "perf", "rating"]
