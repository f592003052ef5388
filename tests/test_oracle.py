"""Every registered query against its check SQL in DuckDB, and the driver's contract."""

import pytest
from pyspark.sql import DataFrame

import __spark_entry__ as entry
from compare import database, difference
from conftest import SMALL, plan_of

ORACLE = entry.oracle_sql()
MAY_BE_EMPTY = {"op2_secret_scan"}  # the smallest folder holds none


@pytest.fixture(scope="module")
def duck():
    return database(SMALL)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SMALL)
    assert isinstance(df, DataFrame) and len(set(df.columns)) == len(df.columns)
    plan = plan_of(df)
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    if name in ORACLE:
        assert difference(df, duck, ORACLE[name]) is None
    else:
        assert df.count() > 0 or name in MAY_BE_EMPTY


def test_flagship(spark):
    assert entry.entry(spark).count() > 100
