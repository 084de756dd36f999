"""Every registered query against the same in SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_points
from oracle import connect, differences
from sievemill.plans import catalog

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(name for name, (_, sql) in catalog.QUERIES.items() if sql))
def test_query_equals_sql(spark, con, name):
    assert differences(spark, con, SF_DIR, entry_points.queries()[name], entry_points.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_queries_without_sql(spark):
    rest = {name for name, (_, sql) in catalog.QUERIES.items() if not sql}
    assert rest == {"src_folder_listing"}
    assert entry_points.queries()["src_folder_listing"](spark, SF_DIR).count() == len(os.listdir(SF_DIR))
