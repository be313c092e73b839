"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import differences, spark_rows, sql_rows

ORACLES = entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, data, con, name):
    got, cols = spark_rows(entry.queries()[name](spark, data))
    want, sql_cols = sql_rows(con, ORACLES[name])
    assert cols == sql_cols
    assert differences(got, want, cols) == ""


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


def test_entry_schema(spark, data):
    df = entry.entry(spark)
    assert len(df.columns) == len(set(df.columns)) > 150
