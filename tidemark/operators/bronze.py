"""Raw change events as they are stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.envelope import table_of

PARTITIONS = ("table_name", "ingestion_date")


def to_bronze(records: DataFrame, route_by: str = "source") -> DataFrame:
    """Kafka records to raw rows with their table and arrival date.

    ``route_by="source"`` takes the table from the event's own ``source.table`` and falls back to
    the topic; ``"topic"`` never looks into the text and is cheaper where topics can be trusted.
    """
    text = F.col("value").cast("string")
    source = F.get_json_object(text, "$.source.table") if route_by == "source" else None
    arrived = F.current_timestamp()
    return records.select(
        text.alias("raw_cdc_json"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        arrived.alias("processing_timestamp"),
        table_of(F.col("topic"), source).alias("table_name"),
        F.to_date(arrived).alias("ingestion_date"),
    )


def drop_redelivered(bronze: DataFrame) -> DataFrame:
    """One row per (topic, partition, offset), for logs written by an at-least-once sink."""
    return bronze.dropDuplicates(["kafka_topic", "kafka_partition", "kafka_offset"])


def route(bronze: DataFrame, table: str) -> DataFrame:
    """One table's events, by equality on the partition column so that the scan is pruned."""
    return bronze.filter(F.col("table_name") == table)
