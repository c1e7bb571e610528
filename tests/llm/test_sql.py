from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from oracle_check import compare, connect
from workload.oracle import ORACLE

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - set(ORACLE)))
def test_registered_query_equals_its_sql(spark, name):
    assert compare(spark, connect(SF_DIR), SF_DIR, entry.queries()[name], entry.oracle_sql()[name]) is None
