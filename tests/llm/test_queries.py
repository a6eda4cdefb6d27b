"""The registered queries against their SQL, run by DuckDB on the same files."""

import glob
import os

import duckdb
import pytest

from tidemark.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        table = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    ours = QUERIES[name](spark, sf_dir)
    theirs = connection.execute(ORACLES[name])
    names = [d[0] for d in theirs.description]
    assert sorted(names) == sorted(ours.columns)
    assert sorted(map(tuple, ours.select(names).collect())) == sorted(theirs.fetchall())
