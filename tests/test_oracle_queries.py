"""Every registered query with a SQL twin must agree with DuckDB (sf0.001)."""

import pytest

import __spark_entry__ as E
from tools.check_oracle import rows_of, type_diffs

from table_dirs import SF_SMALL

NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con(duck):
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert type_diffs(df.schema, rel) == []
    assert rows_of(df.columns, srows) == rows_of(rel.columns, rel.fetchall())


def test_every_query_runs_or_has_oracle(spark):
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["ip", "access_count", "critical_count", "ip_block"]
    assert df.count() > 0
