"""State at a moment from stored snapshots and the part of the log after the nearest one.

The change log is stored by event day, snapshots by the moment they hold. A snapshot is made from the
one before it and the days in between, and a state is read the same way, so neither reads old days.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.latest import latest_per_key
from tidemark.sources.tables import spread_for_write

DAY = "event_day"


def store_by_day(log: DataFrame, path: str) -> None:
    """Append change-log rows by the day of their event; rows without a time have no place here."""
    rows = log.filter("event_time IS NOT NULL").withColumn(DAY, F.to_date("event_time"))
    spread_for_write(rows, [DAY]).write.mode("append").partitionBy(DAY).parquet(path)


def _micros(moment: datetime) -> int:
    zoned = moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
    return int((zoned - datetime(1970, 1, 1, tzinfo=timezone.utc)).total_seconds()) * 10**6 + zoned.microsecond


@dataclass(frozen=True)
class Snapshots:
    """Snapshots of one table. ``log_path`` was written by ``store_by_day``; moments are datetimes,
    UTC if they have no zone, by event time."""

    spark: SparkSession
    path: str
    log_path: str
    key: str | Sequence[str]

    def moments(self) -> list[int]:
        """When the snapshots are of, in microseconds; one number per snapshot."""
        try:
            found = self.spark.read.schema("at BIGINT").parquet(self.path).select("at").distinct()
            return sorted(row.at for row in found.collect())
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return []
            raise

    def _rows(self, micros: int) -> DataFrame:
        """Last events up to a moment, deletes included, with candidates for each key from the
        nearest snapshot and from the later days."""
        stored = self.spark.read.parquet(self.log_path)
        instant = F.timestamp_micros(F.lit(micros))
        tail = stored.filter((F.col("event_time") <= instant) & (F.col(DAY) <= F.to_date(instant)))
        base = max((m for m in self.moments() if m <= micros), default=None)
        if base is None:
            return tail
        since = F.timestamp_micros(F.lit(base))
        tail = tail.filter((F.col("event_time") > since) & (F.col(DAY) >= F.to_date(since)))
        held = self.spark.read.schema(stored.schema).parquet(f"{self.path}/at={base}")
        return held.unionByName(tail)

    def take(self, moment: datetime) -> None:
        """Store the state at a moment, or replace it."""
        micros = _micros(moment)
        rows = latest_per_key(self._rows(micros), self.key)
        folder = f"{self.path}/at={micros}"
        spread_for_write(rows.withColumn("taken_at", F.current_timestamp())).write.mode("overwrite").parquet(folder)

    def state_at(self, moment: datetime, live: bool = True) -> DataFrame:
        """What ``state_at`` over the whole log gives, from the nearest earlier snapshot on."""
        return latest_per_key(self._rows(_micros(moment)), self.key, live).drop(DAY)

    def outdated(self) -> list[int]:
        """Snapshots that lack events: some that belong before them arrived after they were taken.

        Take these anew, the earliest first. Counts rows of the log by day and arrival, which reads
        two columns of it.
        """
        stored = self.spark.read.parquet(self.log_path).select("event_time", "processing_timestamp")
        behind = []
        for micros in self.moments():
            taken = self.spark.read.parquet(f"{self.path}/at={micros}").agg(F.min("taken_at")).first()[0]
            late = stored.filter(
                (F.col("event_time") <= F.timestamp_micros(F.lit(micros)))
                & (F.col("processing_timestamp") > F.lit(taken))
            )
            if taken is not None and not late.isEmpty():
                behind.append(micros)
        return behind
