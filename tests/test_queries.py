"""Every registered query against its SQL on the smallest tables."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from joblark.plans import oracles
from joblark.plans import queries as registered
from tools.check_oracle import rows_of

DATA = Path(os.environ.get("JOBLARK_TESTDATA", "/root/testdata")) / "sf0.001"
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_its_sql():
    assert set(registered.registry()) == set(oracles.oracle_sql())


@pytest.mark.parametrize("name", list(registered.registry()))
def test_query_agrees_with_sql(spark, con, name):
    df = entry.queries()[name](spark, str(DATA))
    got = rows_of(df.columns, df.collect())
    result = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == rows_of(columns, result.fetchall())
    assert got


def test_entry(spark):
    assert entry.entry(spark).count() > 0
