"""Reading the change-event envelope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.order import MAX_MILLIS
from tidemark.schemas import envelope_schema


def table_of(topic: Column, source_table: Column | None = None) -> Column:
    """Table an event belongs to: the source's own name if given, else the last topic part."""
    last_part = F.element_at(F.split(topic, r"\."), -1)
    return last_part if source_table is None else F.coalesce(source_table, last_part)


def parse_envelope(
    events: DataFrame, image: T.DataType | None = None, value: str = "raw_cdc_json"
) -> DataFrame:
    """Add the envelope's fields to each event; malformed or empty text gives NULL fields.

    Adds ``before_image, after_image, source_db, source_table, source_ts_ms, source_snapshot,
    operation_type, operation_timestamp_ms, event_time``; the last is NULL for a missing or absurd
    time. The text is parsed by a generator
    rather than a projection: filters on parsed fields then stay above it, where Catalyst would
    otherwise push them below and parse each text a second time.
    """
    payload = F.from_json(value, envelope_schema(image), {"mode": "PERMISSIVE"})
    parsed = events.select("*", F.inline(F.array(payload)).alias(
        "_before", "_after", "_source", "_op", "_ts_ms"
    ))
    plausible = F.col("_ts_ms").between(1 - MAX_MILLIS, MAX_MILLIS - 1)
    return parsed.select(
        *events.columns,
        F.col("_before").alias("before_image"),
        F.col("_after").alias("after_image"),
        F.col("_source.db").alias("source_db"),
        F.col("_source.table").alias("source_table"),
        F.col("_source.ts_ms").alias("source_ts_ms"),
        F.col("_source.snapshot").alias("source_snapshot"),
        F.col("_op").alias("operation_type"),
        F.col("_ts_ms").alias("operation_timestamp_ms"),
        F.when(plausible, F.timestamp_millis("_ts_ms")).alias("event_time"),
    )
