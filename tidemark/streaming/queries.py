"""Streaming queries: raw ingestion and day-windowed facts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from tidemark.config import ROCKSDB_PROVIDER, LakeConfig
from tidemark.functions.money import exact_sum
from tidemark.operators.bronze import PARTITIONS, to_bronze
from tidemark.operators.facts import (
    ACCOUNT_DIMENSIONS,
    account_updates,
    closing_balance,
    counted_transactions,
)
from tidemark.sources.tables import spread_for_write

# Where the session's settings of that store are.
ROCKSDB = "spark.sql.streaming.stateStore.rocksdb"


def with_trigger(writer: DataStreamWriter, interval: str, once: bool = False) -> DataStreamWriter:
    """Run at the given interval, or drain what is there and stop."""
    if once:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval)


def keep_state_on_disk(spark: SparkSession) -> None:
    """Have streams started from here on hold their state in RocksDB rather than in memory."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)


@contextmanager
def lean_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside do not count the rows of their state, as every write would look its key
    up for that, and upload what a batch changed rather than whole files of state."""
    options = {f"{ROCKSDB}.trackTotalNumberOfRows": "false", f"{ROCKSDB}.changelogCheckpointing.enabled": "true"}
    before = {name: spark.conf.get(name, None) for name in options}
    for name, value in options.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def run_bronze(
    records: DataFrame, config: LakeConfig, once: bool = False, route_by: str = "source"
) -> StreamingQuery:
    """Append records to the raw log, partitioned by table and arrival date.

    The file sink commits each micro-batch once, also after a restart from the checkpoint, so no
    empty-batch check or batch-id bookkeeping is needed.
    """
    writer = (
        to_bronze(records, route_by)
        .writeStream.format(config.table_format)
        .outputMode("append")
        .option("checkpointLocation", f"{config.checkpoint_path}/bronze")
        .partitionBy(*PARTITIONS)
    )
    return with_trigger(writer, config.trigger_interval, once).start(config.bronze_path)


def run_change_log(
    log: DataFrame, table: str, config: LakeConfig, once: bool = False
) -> StreamingQuery:
    """Append a table's typed valid events to its stored change log."""
    writer = (
        log.writeStream.format(config.table_format)
        .outputMode("append")
        .option("checkpointLocation", f"{config.checkpoint_path}/silver_{table}_log")
    )
    return with_trigger(writer, config.trigger_interval, once).start(f"{config.silver_path}/{table}_log")


def rows_dropped_late(query: StreamingQuery) -> int:
    """Rows that came after the watermark had passed their day, as the query's recent progress (its
    last 100 micro-batches) has it; ``LateRows`` counts them for good. Spark counts after its
    partial aggregation. If there are any, the closed days are incomplete; ``rebuild_closed_days``
    makes them whole."""
    return sum(
        operator.get("numRowsDroppedByWatermark", 0)
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )


class LateRows(StreamingQueryListener):
    """Counts every query's rows behind the watermark from when it is added to ``spark.streams`` on.

    ``counts`` goes by query id, which a query keeps over restarts; it starts from zero with the driver.
    """

    def __init__(self):
        self.counts: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        late = sum(operator.numRowsDroppedByWatermark for operator in event.progress.stateOperators)
        query = str(event.progress.id)
        self.counts[query] = self.counts.get(query, 0) + late

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def rebuild_closed_days(facts: DataFrame, name: str, day: str, config: LakeConfig) -> str:
    """Write facts computed from the whole stored log to a new place and return it.

    ``facts`` is the batch form of what ``run_closed_days`` writes, late events included, limited to
    the days wanted. The streamed table stays as it is (its sink keeps a log of its own files), so
    readers can switch over when the job is done.
    """
    path = f"{config.gold_path}/{name}_rebuilt-{uuid.uuid4().hex[:12]}"
    months = facts.withColumn("month", month_of(day))
    spread_for_write(months, ["month"]).write.format(config.table_format).partitionBy("month").save(path)
    return path


def month_of(day: str) -> Column:
    return F.date_format(day, "yyyy-MM")


def daily_balances_stream(log: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """``daily_account_balances`` over a stream.

    Days are event-time windows, so state of a day is let go once the watermark has passed it.
    In append mode a day appears when it is closed; in update mode whenever it changes.
    """
    day = F.window("event_time", "1 day")
    return (
        account_updates(log)
        .withWatermark("event_time", watermark)
        .groupBy(day, *ACCOUNT_DIMENSIONS)
        .agg(closing_balance(), F.count(F.lit(1)).alias("daily_updates_count"))
        .select(
            F.to_date("window.start").alias("account_date"),
            *ACCOUNT_DIMENSIONS,
            "end_of_day_balance",
            "daily_updates_count",
        )
    )


def transaction_events_stream(log: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """Daily sums over a stream of transaction events, each non-delete event counting.

    A stream cannot take back an earlier state of a transaction; where transactions are corrected
    after the fact, use the batch summary over the snapshot.
    """
    day = F.window("event_time", "1 day")
    return (
        counted_transactions(log)
        .withWatermark("event_time", watermark)
        .groupBy(day, "account_id", "transaction_type")
        .agg(
            exact_sum("amount").alias("total_transaction_amount"),
            F.count("transaction_id").alias("number_of_transactions"),
        )
        .select(
            F.to_date("window.start").alias("transaction_date"),
            "account_id",
            "transaction_type",
            "total_transaction_amount",
            "number_of_transactions",
        )
    )


def run_closed_days(
    facts: DataFrame, name: str, day: str, config: LakeConfig, once: bool = False
) -> StreamingQuery:
    """Append each closed day's facts to a table partitioned by month.

    Months, because a backfill closes thousands of days at once and each partition costs files;
    within a month the files' own statistics narrow a scan by day. ``fact_writers`` tasks of the
    configuration write each month, where otherwise every aggregation task would add a small file to every month.
    """
    keep_state_on_disk(facts.sparkSession)
    writer_no = F.pmod(F.xxhash64("account_id"), F.lit(config.fact_writers))
    writer = (
        facts.withColumn("month", month_of(day))
        .repartition("month", writer_no)
        .writeStream.format(config.table_format)
        .outputMode("append")
        .option("checkpointLocation", f"{config.checkpoint_path}/{name}")
        .partitionBy("month")
    )
    return with_trigger(writer, config.trigger_interval, once).start(f"{config.gold_path}/{name}")
