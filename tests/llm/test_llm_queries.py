"""Every query of the folder on the smallest tables, against its SQL where there is one."""

import os

import pytest

import oracle
from slicemill.llm import queries

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    duck = oracle.connect(SF_DIR)
    assert oracle.differences(spark, duck, name, queries.QUERIES[name], queries.ORACLE.get(name), SF_DIR) is None


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
