"""Every registered query against its DuckDB oracle on sf0.001 (the same
comparison the correctness gate makes at sf0.01)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from conftest import SF0001  # noqa: E402
from docweave.sources.tables import TABLES  # noqa: E402
from oracle_check import digest  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF0001)
    rows = [tuple(r) for r in df.collect()]
    res = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(res.columns)
    orows = res.fetchall()
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(res.columns, orows)


def test_every_query_has_builder_and_runs_rows_only(spark):
    for name in set(E.queries()) - set(E.oracle_sql()):
        assert E.queries()[name](spark, SF0001).count() > 0


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"domain", "pages", "size"} <= set(df.columns)
