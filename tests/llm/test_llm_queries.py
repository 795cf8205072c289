"""Every corpus query on the smallest tables; those with an SQL form against DuckDB."""

import pytest
from compare import compare, connect

from tidemark.llm import oracle, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_sql(spark, name):
    assert compare(spark, connect(SF), name, SF, queries.queries()[name], oracle.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(oracle.oracle_sql())))
def test_rows(spark, name):
    rows = queries.queries()[name](spark, SF).collect()
    assert len(rows) == (50 if name.startswith("op6") else 200)
