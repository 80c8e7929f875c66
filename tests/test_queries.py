"""Every registered query beside its SQL twin on the smallest data."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_flagship_runs(spark):
    assert entry.entry(spark).where("is_total = 1").count() == 1


def test_names_agree():
    assert set(ORACLES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    if name in ORACLES:
        assert compare(df, con, ORACLES[name]) == ""
    else:
        df.count()
