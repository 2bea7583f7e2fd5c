"""Every query of the subpackage that has a SQL twin against it, on the smallest tables."""

from __future__ import annotations

import compare
import pytest

from touchline.llm.registry import ORACLE, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, sf_dir, name):
    assert compare.check(spark, duck, sf_dir, name, QUERIES, ORACLE) == []
