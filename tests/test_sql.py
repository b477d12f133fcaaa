"""Every registered query gives the rows of its SQL twin."""

import os

import pytest

import __spark_entry__ as entry
from tools.check_sql import compare, duck

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


# The corpus operators have tests of their own, in tests/llm.
NAMES = [n for n, run in entry.queries().items() if not run.__module__.startswith(("leafmill.llm", "corpus_pipeline"))]


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    rows = entry.queries()[name](spark, SF).toPandas()
    assert compare(rows, con.execute(entry.oracle_sql()[name]).df()) is None


def test_every_query_has_sql():
    assert set(NAMES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).columns == ["category", "n"]
