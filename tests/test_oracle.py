"""Every registered query against its SQL twin on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import compare  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from lakemart import catalog  # noqa: E402

QUERIES, ORACLE = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def con(small_dir):
    return compare.connect(small_dir)


@pytest.fixture(scope="module")
def small_dir():
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("test tables are not here")
    return folder


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, con, small_dir, name):
    same, note = compare.compare(spark, con, QUERIES[name], ORACLE[name], small_dir)
    assert same, note


def test_registered():
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())


def test_entry(spark, small_dir):
    assert entry.entry(spark).count() == 66
