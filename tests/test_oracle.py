"""Every named query against its SQL on the smallest test data."""

import os

import pytest

import oracle
from slicemill.plans import all_queries

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF_DIR)


# Result sets that are rightly empty on the smallest tables.
MAY_BE_EMPTY = {"day_detail", "sym_diff", "payload_variants", "snapshot_keys", "orphans"}


@pytest.mark.parametrize("name", sorted(all_queries.QUERIES))
def test_query(spark, duck, name):
    why = oracle.differences(spark, duck, name, all_queries.QUERIES[name], all_queries.ORACLE.get(name), SF_DIR)
    assert why is None or (why == "both empty" and name in MAY_BE_EMPTY), why


def test_every_query_has_sql_and_ids():
    assert set(all_queries.ORACLE) == set(all_queries.QUERIES)
    assert all(all_queries.COVERS.values())
