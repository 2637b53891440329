"""Every registered query with an oracle equals its DuckDB SQL (sf0.001)."""

import pytest

import __spark_entry__ as E
from tests._compare import assert_same
from tests.conftest import SF_SMALL

SQL = E.oracle_sql()


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_sql(spark, duck, key):
    got = E.queries()[key](spark, SF_SMALL).toPandas()
    want = duck.execute(SQL[key]).df()
    assert_same(got, want)


def test_every_sql_key_has_a_query():
    assert set(SQL) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"doc_id", "section", "key", "value", "pos"}
