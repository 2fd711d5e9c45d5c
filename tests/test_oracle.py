"""Every query with SQL gives in Spark what DuckDB gives."""

import pytest
from compare import both

from lodestrata import catalogue

SF = "/root/testdata/sf0.001"
SQL = catalogue.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, name):
    mine, theirs = both(spark, SF, catalogue.queries()[name], SQL[name])
    assert mine[0] == theirs[0]
    assert mine[1] == theirs[1]
    assert mine[1] or name in ("name_match",)


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(SQL)))
def test_query_without_sql(spark, name):
    assert catalogue.queries()[name](spark, SF).count() > 0
