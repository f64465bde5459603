"""Every registered query against its reference SQL on the smallest tables, where they exist."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import check  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_entry(spark):
    assert check.entry.entry(spark).columns[0] == "job_id"


def test_every_oracle_has_a_query():
    assert set(check.entry.oracle_sql()) <= set(check.entry.queries())


@pytest.mark.parametrize("name", sorted(check.entry.queries()))
def test_query_equals_sql(spark, name):
    assert check.compare(spark, check.connect(SF), name, SF).startswith(("ok", "rows"))
