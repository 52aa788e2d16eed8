"""Every registered query next to its SQL, at the smallest scale."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from carrack.registry import QUERIES
from check import canonical


@pytest.fixture(scope="module")
def con(small):
    con = duckdb.connect()
    for file in Path(small).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def test_every_query_has_sql():
    assert QUERIES.keys() <= entry_module.queries().keys()
    assert QUERIES.keys() <= entry_module.oracle_sql().keys()


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, con, name):
    result = entry_module.queries()[name](spark, small)
    cursor = con.execute(entry_module.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(result.columns)
    assert canonical(result.columns, result.collect()) == canonical(columns, cursor.fetchall())
