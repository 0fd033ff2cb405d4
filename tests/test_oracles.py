"""Every registered query against its SQL on DuckDB."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def in_order(rows):
    return sorted(rows, key=lambda row: [(value is None, str(value)) for value in row])


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    rows = df.collect()
    assert rows
    result = duck.execute(entry.oracle_sql()[name])
    kinds = {d[0]: str(d[1]) for d in result.description}
    assert {c: KINDS[t] for c, t in df.dtypes} == kinds
    columns = sorted(kinds)
    names = list(kinds)
    theirs = [tuple(row[names.index(c)] for c in columns) for row in result.fetchall()]
    assert in_order(tuple(row[c] for c in columns) for row in rows) == in_order(theirs)


def test_entry(spark):
    assert entry.entry(spark).columns == ["token", "n"]
