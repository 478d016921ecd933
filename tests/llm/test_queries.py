"""The registered queries on the smallest tables, against SQL where there is any."""

import os

import duckdb
import pytest

from beatgrid.llm.queries import ORACLE, QUERIES
from tests.compare import DATA, compare

SF_DIR = f"{DATA}/{os.environ.get('TEST_SF', 'sf0.001')}"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    return con


def test_every_operator_has_a_query():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, con, name):
    ok, note = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_DIR)
    assert ok, note
