"""Audit of a raw log by Kafka offset: what is missing, what came twice, what is out of order.

A window over one Kafka partition would run in one task, and one partition may hold most of the log.
Here offsets are dealt into ranges of fixed length, so a task's window holds no more rows than a range
has offsets, and only one summary row per range meets those of its neighbours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Offsets of one range: the most rows of a partition that a single task sorts.
RANGE = 1_000_000
PARTITION = ["kafka_topic", "kafka_partition"]


def _with_previous(log: DataFrame, span: int) -> DataFrame:
    """One row per offset: how often it came, its first and last time, the offset before it in its
    Kafka partition and the latest time among all offsets before it."""
    once = (
        log.filter("kafka_offset IS NOT NULL")
        .groupBy(*PARTITION, "kafka_offset")
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.min("kafka_timestamp").alias("_time"),
            F.max("kafka_timestamp").alias("_until"),
        )
        .withColumn("_range", F.floor(F.col("kafka_offset") / span))
    )
    inside = Window.partitionBy(*PARTITION, "_range").orderBy("kafka_offset")
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = once.withColumns(
        {
            "_previous": F.lag("kafka_offset").over(inside),
            "_latest": F.max("_until").over(earlier),
        }
    )
    # what a range needs to know of those before it: one row per range
    ranges = once.groupBy(*PARTITION, "_range").agg(
        F.max("kafka_offset").alias("_end"), F.max("_until").alias("_until")
    )
    before = Window.partitionBy(*PARTITION).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(
        *PARTITION,
        "_range",
        F.max("_end").over(before).alias("_end_before"),
        F.max("_until").over(before).alias("_until_before"),
    )
    # a topic or partition may be NULL
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"o.{c}")) for c in [*PARTITION, "_range"]]
    joined = rows.alias("o").join(ranges.alias("r"), same[0] & same[1] & same[2])
    return joined.select(
        *[F.col(f"o.{c}").alias(c) for c in [*PARTITION, "kafka_offset", "copies", "_time"]],
        F.coalesce("_previous", "_end_before").alias("previous"),
        F.greatest("_latest", "_until_before").alias("_latest"),
    )


def offset_gaps(log: DataFrame, span: int = RANGE) -> DataFrame:
    """``(topic, partition, first_missing, last_missing, missing)`` of every run of offsets that is
    absent between two that are there."""
    rows = _with_previous(log, span).filter(F.col("kafka_offset") > F.col("previous") + 1)
    return rows.select(
        *PARTITION,
        (F.col("previous") + 1).alias("first_missing"),
        (F.col("kafka_offset") - 1).alias("last_missing"),
        (F.col("kafka_offset") - F.col("previous") - 1).alias("missing"),
    )


def offset_audit(log: DataFrame, span: int = RANGE) -> DataFrame:
    """One row per Kafka partition: its first and last offset, how many different ones there are, how
    many are missing between them, how many rows repeat one, and how many offsets have a time before
    that of an earlier offset."""
    behind = F.col("_time") < F.col("_latest")
    audited = _with_previous(log, span).groupBy(*PARTITION)
    return audited.agg(
        F.min("kafka_offset").alias("first_offset"),
        F.max("kafka_offset").alias("last_offset"),
        F.count(F.lit(1)).alias("offsets"),
        (F.max("kafka_offset") - F.min("kafka_offset") + 1 - F.count(F.lit(1))).alias("missing"),
        F.sum(F.col("copies") - 1).alias("repeated"),
        F.count_if(behind).alias("out_of_order"),
    )
