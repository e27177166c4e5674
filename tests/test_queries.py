"""Every registered query against its SQL twin, on the smallest shared tables."""

from pathlib import Path

import compare
import pytest

from minutebook.catalog import bar_queries, payload_queries, quality_queries, store_queries  # noqa: F401
from minutebook.catalog.registry import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="shared tables absent")


@pytest.fixture(scope="module")
def con():
    return compare.duck(SF_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    want = con.execute(SQL[name]).df()
    assert compare.difference(got, want) is None
