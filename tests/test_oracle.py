"""Every registered query with SQL gives the rows DuckDB gives."""

import pytest

from casemill.plans.registry import all_oracles, all_queries
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_matches_sql(spark, duck, name):
    assert compare(all_queries()[name](spark, SF_DIR), duck, all_oracles()[name]) == []


def test_every_oracle_has_a_query():
    assert set(all_oracles()) <= set(all_queries())
