"""Every registered query of the survey pipelines against its DuckDB oracle SQL on the sf0.001 tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from compare import compare_one, duck  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from reeflens.plans.catalog import QUERIES  # noqa: E402
from reeflens.plans.oracle import SQL  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare_one(spark, con, name, SF, QUERIES[name], SQL[name])
    assert ok, msg


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


def test_entry_registers_everything():
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
