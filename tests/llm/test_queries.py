"""The queries that SQL can express against DuckDB, types included."""

from pathlib import Path

import duckdb
import pytest

from tamis.llm import oracles, queries

SF = "/root/testdata/sf0.001"
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query(spark, name):
    duck = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    df = queries.QUERIES[name](spark, SF)
    result = duck.execute(oracles.ORACLES[name])
    kinds = {d[0]: str(d[1]) for d in result.description}
    assert {c: KINDS[t] for c, t in df.dtypes} == kinds
    assert sorted(map(repr, map(tuple, df.select(*kinds).collect()))) == sorted(map(repr, result.fetchall()))
