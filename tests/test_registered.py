"""Registered queries against their SQL, on the smallest test data."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
# Those of a package that may not be there have tests of their own.
OPTIONAL = re.compile(r"op\d+_|pipeline$")
CORE = {name for name in entry.queries() if not OPTIONAL.match(name)}
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for file in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{file}'")
    return con


def test_every_query_has_its_sql():
    assert CORE and {name for name in entry.oracle_sql() if not OPTIONAL.match(name)} == CORE


def test_every_check_can_fail(spark):
    rows = entry.queries()["quality_faults"](spark, FOLDER).collect()
    assert len(rows) == 13 and {r.result for r in rows} == {"FAIL"}


@pytest.mark.parametrize("name", sorted(CORE))
def test_same_rows_as_sql(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    result = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    ours = sorted(repr(tuple(r)) for r in df.select(*columns).collect())
    assert sorted(df.columns) == sorted(columns)
    assert ours == sorted(repr(r) for r in result.fetchall())
