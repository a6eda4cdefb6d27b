"""Expectations, reports and schema checks."""

import pytest
from helpers import rows_of
from pyspark.sql import Observation
from pyspark.sql import types as T

from tidemark.operators.quality import (
    SchemaMismatch,
    enforce_schema,
    expect,
    quality_report,
)

RULES = {"known": "id IS NOT NULL", "positive": "v > 0"}


@pytest.fixture
def data(spark):
    return spark.createDataFrame([(1, 1.0), (None, 2.0), (3, None), (4, -1.0)], "id INT, v DOUBLE")


def test_drop_keeps_only_rows_where_rules_are_true(data):
    assert rows_of(expect(data, RULES)) == [(1, 1.0)]


def test_warn_keeps_rows_and_counts(data):
    seen = Observation("seen")
    assert expect(data, RULES, "warn", seen).count() == 4
    assert seen.get == {"rows": 4, "known": 1, "positive": 2}


def test_fail_stops_the_job(data):
    assert expect(data.filter("id = 1"), RULES, "fail").count() == 1
    with pytest.raises(Exception, match="expectation"):
        expect(data, RULES, "fail").collect()


def test_unknown_action(data):
    with pytest.raises(ValueError):
        expect(data, RULES, "ignore")


def test_quality_report(data):
    assert rows_of(quality_report(data, RULES, "t")) == [
        ("t", "known", 3, 1, 0.25),
        ("t", "positive", 2, 2, 0.5),
    ]
    assert rows_of(quality_report(data.limit(0), RULES, "t"), "passed", "failed", "failed_rate") == [
        (0, 0, None),
        (0, 0, None),
    ]


def test_enforce_schema(data):
    schema = T.StructType.fromDDL("v DOUBLE, id INT")
    assert enforce_schema(data, schema).columns == ["v", "id"]
    wider = T.StructType.fromDDL("id INT, new STRING")
    with pytest.raises(SchemaMismatch):
        enforce_schema(data, wider)
    assert enforce_schema(data, wider, evolve=True).columns == ["id", "new", "v"]
    with pytest.raises(SchemaMismatch):
        enforce_schema(data, T.StructType.fromDDL("id BIGINT"), evolve=True)
