"""Every registered query against its SQL, on whole tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import difference

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
RUNS, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, name):
    assert difference(spark, FOLDER, RUNS[name], ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(RUNS) - set(ORACLES)))
def test_has_rows(spark, name):
    assert RUNS[name](spark, FOLDER).count() > 0


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(RUNS)
