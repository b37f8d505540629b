"""Every registered query against its SQL on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry_module  # noqa: E402
from check_queries import compare, connect  # noqa: E402
from tallyloom.queries import load_all  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(load_all()))
def test_query_matches_its_sql(spark, duck, name):
    registered = load_all()[name]
    df = registered.run(spark, SF_DIR)
    assert registered.sql is not None
    assert compare(df, duck, registered.sql).startswith("ok")


def test_contract(spark):
    assert entry_module.entry(spark).count() > 0
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
