"""Small builders shared by the tests."""

import json
from datetime import datetime, timezone

from pyspark.sql import functions as F

from tidemark.operators.bronze import to_bronze

RECORD = "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"
TOPIC = "dbserver1.banking_db."
NOON = datetime(2024, 1, 1, 12, tzinfo=timezone.utc)


def event(table, op, ts_ms, before=None, after=None, **extra):
    body = {
        "before": before,
        "after": after,
        "source": {"db": "banking_db", "table": table, "ts_ms": ts_ms, "snapshot": "false"},
        "op": op,
        "ts_ms": ts_ms,
        **extra,
    }
    return json.dumps({k: v for k, v in body.items() if v is not None})


def records(spark, texts, topic=TOPIC + "accounts", start=0):
    rows = [
        (None, None if t is None else bytearray(t.encode()), topic, 0, start + i, NOON)
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, RECORD)


def bronze(spark, texts, table="accounts", start=0):
    return to_bronze(records(spark, texts, TOPIC + table, start))


def rows_of(df, *columns):
    """Rows as a sorted list of tuples."""
    df = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in df.collect()), key=repr)


def same(left, right):
    """Both frames hold the same rows, counted with repeats."""
    right = right.select(*left.columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def ms(day, hour=0):
    return F.lit(day * 86_400_000 + hour * 3_600_000)
