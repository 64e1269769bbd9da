"""Every registered query beside its SQL, on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

import __spark_entry__ as entry  # noqa: E402
from oracle import compare, connect  # noqa: E402

FOLDER = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
# Queries that find nothing in the smallest tables, in Spark and in SQL alike.
EMPTY_WHEN_SMALL = {"jn7_measured_fees", "sco7_twin_pairs", "sco8_displaced"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_equals_its_sql(spark, connection, name):
    problem = compare(spark, connection, FOLDER, name, entry.queries()[name], entry.oracle_sql().get(name))
    if problem == "no rows on either side" and name in EMPTY_WHEN_SMALL:
        problem = None
    assert problem is None, problem


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship_has_rows(spark):
    if FOLDER != "/root/testdata/sf0.001":
        pytest.skip("the flagship reads its own folder")
    assert 0 < entry.entry(spark).count() <= 10
