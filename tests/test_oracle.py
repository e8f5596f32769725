"""Every query against its SQL twin on the small tables."""

import pytest

import __spark_entry__ as entry_points
from caremetrics.plans.oracle import oracle
from caremetrics.plans.queries import registry
from tests.conftest import SF
from tools.check import compare, open_tables

QUERIES = registry()
SQL = oracle()


@pytest.fixture(scope="module")
def con():
    return open_tables(SF)


def test_every_twin_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry_is_lazy_and_has_rows(spark):
    df = entry_points.entry(spark)
    assert df.columns == [
        "measurename",
        "reportedmeasurename",
        "state",
        "reportingstartdate",
        "mean_value",
    ]
    assert df.count() == 1352


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_same_as_sql(spark, con, key):
    df = QUERIES[key](spark, SF)
    if key in SQL:
        assert compare(df, con, SQL[key]) == ""
    else:
        assert df.count() > 0
