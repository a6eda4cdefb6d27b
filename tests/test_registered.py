"""Every registered query against its SQL, run by DuckDB on the same files."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as registry
import fixtures.oracles
import fixtures.queries

ORACLES = fixtures.oracles.ORACLES


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    text = [tuple("-" if r[i] is None else str(r[i]) for i in order) for r in rows]
    return sorted(text)


def test_every_query_has_sql():
    assert set(fixtures.oracles.ORACLES) == set(fixtures.queries.QUERIES)
    assert set(ORACLES) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf_dir, duck, name):
    ours = registry.queries()[name](spark, sf_dir)
    theirs = duck.sql(ORACLES[name])
    assert sorted(ours.columns) == sorted(theirs.columns)
    expected = normal(theirs.fetchall(), theirs.columns)
    assert expected
    assert normal(ours.collect(), ours.columns) == expected


def test_flagship(spark):
    result = registry.entry(spark)
    assert result.count() == 364
