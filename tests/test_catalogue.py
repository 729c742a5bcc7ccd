"""Registered queries against their SQL twins on the smallest data."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import rows

DATA = Path("/root/testdata/sf0.001")
TWINS = entry.oracle_sql()

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def test_every_twin_has_a_query():
    assert set(TWINS) <= set(entry.queries())


def test_entry(spark):
    found = entry.entry(spark).collect()
    assert found and {r["action"] for r in found} <= {"ALLOW", "WARN", "REVIEW", "BLOCK"}


@pytest.mark.parametrize("name", sorted(TWINS))
def test_twin(spark, con, name):
    df = entry.queries()[name](spark, str(DATA))
    cursor = con.execute(TWINS[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, df.collect()) == rows(names, cursor.fetchall())
