"""Queries without a SQL form run on the small tables and return rows."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

ROWS = sorted(k for k in set(E.queries()) - set(E.oracle_sql()) if not k.startswith("op") and k != "pipeline" or k == "omp")


@pytest.mark.parametrize("key", ROWS)
def test_rows_query_runs(spark, key):
    """Rows without nulls in every column; what they hold is checked in test_learners and tests/llm."""
    rows = E.queries()[key](spark, SF_SMALL).collect()
    assert rows
    assert any(all(v is not None for v in r) for r in rows)
