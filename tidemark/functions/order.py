"""The order of change events as one number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bounds of what the number has room for: milliseconds from 1970 (the year 5138), and the
# first partition and offset that are too large.
MAX_MILLIS, MAX_PARTITION, MAX_OFFSET = 10**14, 10**6, 10**18


def position_out_of_range() -> Column:
    """Whether a Kafka partition or offset has no room in the event order."""
    partition, offset = F.col("kafka_partition"), F.col("kafka_offset")
    return (
        (partition >= MAX_PARTITION - 1) | (partition < 0) | (offset >= MAX_OFFSET - 1) | (offset < 0)
    )


def event_order_key() -> Column:
    """Time, Kafka partition and offset packed in that order into one decimal.

    A number, unlike a struct, can be compared inside a hash aggregation; with a struct Spark
    sorts all rows first. What is NULL comes first. A value that has no room fails the job whatever
    the ANSI setting is, so an order is never wrong; change logs hold none, as such events go to the
    quarantine.
    """
    time, partition, offset = "operation_timestamp_ms", "kafka_partition", "kafka_offset"
    outside = (F.abs(time) >= MAX_MILLIS - 1) | position_out_of_range()
    packed = F.expr(
        f"cast(coalesce({time}, {1 - MAX_MILLIS}) as decimal(14,0)) * cast('1e24' as decimal(25,0))"
        f" + cast(coalesce({partition}, -1) + 1 as decimal(6,0)) * cast('1e18' as decimal(19,0))"
        f" + cast(coalesce({offset}, -1) + 1 as decimal(18,0))"
    )
    failure = F.raise_error(F.lit("event time, partition or offset out of range"))
    return F.when(F.coalesce(outside, F.lit(False)), failure.cast("decimal(38,0)")).otherwise(packed)
