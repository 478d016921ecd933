"""Every query with an SQL counterpart agrees with it on the smallest scale factor."""

import os

import pytest

import workload.learn_queries  # noqa: F401
from tests.compare import DATA, compare, connect
from workload.oracle import ORACLE
from workload.queries import QUERIES

SF_DIR = f"{DATA}/{os.environ.get('TEST_SF', 'sf0.001')}"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


#: Minutes with the published settings, so they run only with TEST_SLOW=1, once a round; tests/test_round.py
#: and tests/test_trees.py fit every family and search small grids.
SLOW = {"ml4c_patience_on_given_rows", "ml5b_random_cuts", "ml7b_family_checks", "ml9b_grid_checks"}
slow = pytest.mark.skipif(not os.environ.get("TEST_SLOW"), reason="set TEST_SLOW=1")


@pytest.mark.parametrize("name", [pytest.param(n, marks=[slow] * (n in SLOW)) for n in sorted(ORACLE)])
def test_matches_sql(spark, con, name):
    ok, note = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_DIR)
    assert ok, note
