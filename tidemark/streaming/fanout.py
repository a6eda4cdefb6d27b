"""All silver change logs from one stream: each micro-batch of the raw log is read once.

A stream has one sink, so the batch goes to a staging table as it is, and from there to the logs of the tables
it holds, each event parsed as its table needs it. Only where a log took in fewer events than the batch has for
its table, or values that did not fit, are these read once more for the quarantine. Each log and the quarantine
get a folder per batch. Folders are replaced whole, and a folder that already has all rows of its batch is left
alone, so a retried batch adds nothing twice.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.config import LakeConfig
from tidemark.functions.envelope import parse_envelope
from tidemark.operators.changelog import parsed_events, quarantine, rejection, typed_log
from tidemark.operators.quality import any_cast_failed
from tidemark.schemas import TABLES, table_schema
from tidemark.sources.files import find
from tidemark.sources.tables import CODEC, read_bronze_stream, spread_for_write
from tidemark.streaming.queries import with_trigger

# Destination of events that enter no log.
REJECTED = "rejected"
QUARANTINE = "quarantine"
QUARANTINE_SCHEMA = (
    "reason STRING, table_name STRING, raw_cdc_json STRING, kafka_topic STRING, kafka_partition INT, "
    "kafka_offset BIGINT, kafka_timestamp TIMESTAMP"
)
# Logs of one batch that are written at the same time. Plan only.
WRITERS = 4
# Rows from which a batch's part of a log is written in the pieces in which it is read. Plan only.
MANY_ROWS = 1_000_000


def route_events(raw: DataFrame, tables: Sequence[str] = TABLES) -> DataFrame:
    """Raw events of any tables, parsed once, with ``destination`` (a table or ``rejected``) and, for
    the rejected, the ``reason``: those of ``quarantine``, ``tombstone`` or ``unknown_table``."""
    parsed = parse_envelope(raw.withColumn("ingestion_timestamp", F.current_timestamp()))
    reasons = F.when(F.col("table_name").isNull() | ~F.col("table_name").isin(*tables), "unknown_table")
    for table in tables:
        reasons = reasons.when(F.col("table_name") == table, rejection(table, table_schema(table)))
    destination = F.when(F.col("reason").isNull(), F.col("table_name")).otherwise(REJECTED)
    return parsed.withColumn("reason", reasons).withColumn("destination", destination)


@dataclass(frozen=True)
class SilverFanout:
    """The change logs of all captured tables below ``silver_path``, and the stored quarantine."""

    spark: SparkSession
    lake: LakeConfig
    tables: Sequence[str] = TABLES

    def log_path(self, table: str) -> str:
        return f"{self.lake.silver_path}/{table}_log"

    @property
    def quarantine_path(self) -> str:
        return f"{self.lake.silver_path}/{QUARANTINE}"

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Take in one micro-batch of the raw log; taking it in again changes nothing."""
        staging = f"{self.lake.silver_path}/staging"
        # Not partitioned, for which all texts would be sorted: a file of the raw log holds one table's
        # events, so most staged row groups are one table's and the others' readers skip them.
        batch.write.mode("overwrite").option("compression", CODEC).parquet(staging)
        staged = self.spark.read.schema(batch.schema).parquet(staging)
        # one row per table at most
        present = {r.table_name: r["count"] for r in staged.groupBy("table_name").count().collect()}

        def faults(table: str) -> DataFrame | None:
            """Write the table's log; what the batch has for the quarantine, if it has any."""
            parsed = parsed_events(staged, table)
            schema = table_schema(table)
            # casts and checks are done once, for what is written and what is counted
            bad, misfits = Observation(), F.coalesce(any_cast_failed(schema), F.lit(False))
            rows = typed_log(parsed.filter(rejection(table, schema).isNull()), table, extra=[misfits.alias("_misfit")])
            seen = rows.observe(bad, F.count_if("_misfit").alias("misfits"), F.count(F.lit(1)).alias("rows"))
            if self._write_once(seen.drop("_misfit"), self.log_path(table), batch_id, present[table]):
                if bad.get["misfits"] == 0 and bad.get["rows"] == present[table]:
                    return None
            return quarantine(staged, table).withColumn("table_name", F.lit(table))

        known = [t for t in self.tables if t in present]
        unknown = F.col("table_name").isNull() | ~F.col("table_name").isin(*self.tables)
        with ThreadPoolExecutor(WRITERS) as pool:
            found = [rows for rows in pool.map(faults, known) if rows is not None]
        if present.keys() - set(known):
            found.append(route_events(staged.filter(unknown), self.tables))
        kept = [c.split()[0] for c in QUARANTINE_SCHEMA.split(", ")]
        nothing = self.spark.createDataFrame([], QUARANTINE_SCHEMA)
        rows = reduce(DataFrame.unionByName, [rows.select(*kept) for rows in found], nothing)
        self._write_once(rows, self.quarantine_path, batch_id)

    def _write_once(self, rows: DataFrame, path: str, batch_id: int, raw: int | None = None) -> bool:
        """Write the batch's folder of a table, unless it holds all its rows from an earlier try; ``raw``
        is how many events they come from. Whether it was written."""
        folder = f"{path}/batch_id={batch_id}"
        if raw is not None and (stored := self._stored(folder)) is not None and stored == rows.count():
            return False
        many = raw is not None and raw >= MANY_ROWS
        rows = rows if many else spread_for_write(rows)
        rows.write.mode("overwrite").option("compression", CODEC).parquet(folder)
        return True

    def _stored(self, folder: str) -> int | None:
        if not find(self.spark, folder):
            return None
        try:
            return self.spark.read.parquet(folder).count()
        except AnalysisException as error:
            if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
                return None
            raise

    def quarantine(self) -> DataFrame:
        """All rejected events and accepted ones with a value that did not fit, with their ``reason``."""
        rows = self.spark.read.schema(f"{QUARANTINE_SCHEMA}, batch_id BIGINT")
        return rows.parquet(self.quarantine_path)

    def run(self, once: bool = False) -> StreamingQuery:
        """One stream that lists the raw log once per micro-batch and feeds every table."""
        raw = read_bronze_stream(
            self.spark, self.lake.bronze_path, self.lake.table_format, self.lake.max_files_per_trigger
        )
        writer = (
            raw.writeStream.queryName(f"silver_fanout_{id(self)}")
            .foreachBatch(self.apply)
            .option("checkpointLocation", f"{self.lake.checkpoint_path}/silver")
        )
        return with_trigger(writer, self.lake.trigger_interval, once).start()
