"""Typed change logs per table: every valid event, key filled in from either image."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.envelope import parse_envelope
from tidemark.functions.images import cast_text, flatten_images
from tidemark.functions.order import position_out_of_range
from tidemark.operators.bronze import route
from tidemark.operators.quality import VALID_OPERATION, any_cast_failed, holds
from tidemark.schemas import key_of, table_schema, text_image

METADATA = (
    "operation_type",
    "operation_timestamp_ms",
    "kafka_timestamp",
    "processing_timestamp",
    "ingestion_timestamp",
    "event_time",
    "kafka_partition",
    "kafka_offset",
)

# Why an event stays out of a change log, in the order the reasons are tried.
REJECTIONS = (
    "tombstone",
    "malformed",
    "wrong_table",
    "invalid_operation",
    "missing_key",
    "bad_time",
    "bad_position",
)


def parsed_events(bronze: DataFrame, table: str, schema: T.StructType | None = None) -> DataFrame:
    """One table's raw events with the envelope read once into text images."""
    schema = schema or table_schema(table)
    events = route(bronze, table).withColumn("ingestion_timestamp", F.current_timestamp())
    return parse_envelope(events, image=text_image(schema))


def typed_images(parsed: DataFrame, schema: T.StructType) -> DataFrame:
    """Both images flattened to typed columns, followed by the event's metadata."""
    return parsed.select(*flatten_images(schema), *METADATA)


def rejection(table: str, schema: T.StructType) -> Column:
    """Why a parsed event cannot enter the change log (NULL if it can).

    A Kafka tombstone (no text at all) is no event and is told apart from malformed text.
    """
    empty = (
        F.col("operation_type").isNull()
        & F.col("operation_timestamp_ms").isNull()
        & F.col("before_image").isNull()
        & F.col("after_image").isNull()
    )
    key = schema[key_of(schema)]
    key_text = F.coalesce(F.col("after_image")[key.name], F.col("before_image")[key.name])
    foreign = F.coalesce(F.col("source_table"), F.lit(table)) != table
    return (
        F.when(F.col("raw_cdc_json").isNull(), "tombstone")
        .when(empty, "malformed")
        .when(foreign, "wrong_table")
        .when(~holds(VALID_OPERATION["valid_operation"]), "invalid_operation")
        .when(cast_text(key_text, key.dataType).isNull(), "missing_key")
        .when(F.col("event_time").isNull(), "bad_time")
        .when(F.coalesce(position_out_of_range(), F.lit(False)), "bad_position")
    )


def change_log(
    bronze: DataFrame,
    table: str,
    schema: T.StructType | None = None,
    observation: Observation | str | None = None,
) -> DataFrame:
    """Valid events of one table, typed: ``n`` columns, ``n`` ``before_`` columns, metadata.

    Validation comes before any per-key choice, so a bad newest event cannot hide a good older
    one. A delete has no after-image; its key is taken from the before-image. Narrow plan: no
    shuffle, works alike on batch and streaming frames.

    With an observation (a name on streams), events and rejections by reason are counted in
    passing; streams report them with each micro-batch.
    """
    schema = schema or table_schema(table)
    parsed = parsed_events(bronze, table, schema)
    if observation is not None:
        rejected = rejection(table, schema)
        counts = [F.count_if(rejected == reason).alias(reason) for reason in REJECTIONS]
        parsed = parsed.observe(observation, F.count(F.lit(1)).alias("events"), *counts)
    return typed_log(parsed.filter(rejection(table, schema).isNull()), table, schema)


def typed_log(
    parsed: DataFrame, table: str, schema: T.StructType | None = None, extra: Sequence[Column] = ()
) -> DataFrame:
    """The change log's rows of parsed events that are known to be valid; ``extra`` columns are taken along."""
    schema = schema or table_schema(table)
    key = key_of(schema)
    typed = parsed.select(*flatten_images(schema), *METADATA, *extra)
    return typed.withColumn(key, F.coalesce(F.col(key), F.col(f"before_{key}")))


def quarantine(bronze: DataFrame, table: str, schema: T.StructType | None = None) -> DataFrame:
    """Events kept out of the change log, and those let in with a value that did not fit its type.

    ``reason`` is ``malformed``, ``wrong_table``, ``invalid_operation``, ``missing_key``,
    ``bad_time``, ``bad_position`` (a partition or offset beyond what the event order has room for)
    or ``cast_failure``. Tombstones are not faults and do not appear.
    """
    schema = schema or table_schema(table)
    parsed = parsed_events(bronze, table, schema)
    bad_cast = F.when(any_cast_failed(schema), "cast_failure")
    reason = F.coalesce(rejection(table, schema), bad_cast)
    return (
        parsed.withColumn("reason", reason)
        .filter("reason IS NOT NULL AND reason <> 'tombstone'")
        .select(
            "reason",
            "raw_cdc_json",
            "kafka_topic",
            "kafka_partition",
            "kafka_offset",
            "kafka_timestamp",
        )
    )


def split_valid(
    bronze: DataFrame, table: str, schema: T.StructType | None = None
) -> tuple[DataFrame, DataFrame]:
    """The change log and the quarantine of one table."""
    return change_log(bronze, table, schema), quarantine(bronze, table, schema)


def field_changes(log: DataFrame, schema: T.StructType) -> DataFrame:
    """Audit trail ``(key, time, operation, field, old_value, new_value)`` of differing fields.

    Works row by row on typed values, so two encodings of one date are no change. No shuffle.
    """
    key = key_of(schema)
    after_gone = F.col("operation_type") == "d"
    pairs = F.array(
        *[
            F.struct(
                F.lit(name).alias("field"),
                F.col(f"before_{name}").cast("string").alias("old_value"),
                F.when(~after_gone, F.col(name).cast("string")).alias("new_value"),
            )
            for name in schema.fieldNames()
        ]
    )
    differing = F.filter(pairs, lambda p: ~p["old_value"].eqNullSafe(p["new_value"]))
    return log.select(
        key,
        "operation_timestamp_ms",
        "operation_type",
        "kafka_partition",
        "kafka_offset",
        F.inline(differing),
    )
