"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as entry
from tests.compare import difference, spark_result, sql_result, type_difference

QUERIES = {name: fn for m in entry.BASE for name, fn in m.QUERIES.items()}
SQL = {name: sql for m in entry.BASE for name, sql in m.SQL.items()}


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, folder, name):
    df = QUERIES[name](spark, folder)
    assert type_difference(df, con, SQL[name]) is None
    assert difference(spark_result(df), sql_result(con, SQL[name])) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["k", "start"] and df.count() > 0


def test_report_sample_is_repeatable(spark, folder):
    one, two = (QUERIES["report_sample"](spark, folder).collect() for _ in range(2))
    assert one == two and len(one) == 100
    assert [r.k for r in one] == sorted(r.k for r in one)
