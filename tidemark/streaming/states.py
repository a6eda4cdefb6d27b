"""Newest event per key by a stateful operator, whose state lets go of deleted keys.

``keyed.latest_table`` keeps every key for good and needs no Python. This form is for streams whose keys
come and go: what it holds per key is an order and an operation, and a timer clears a deleted key once
no older event of it can count any more.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.schemas import EVENT_ORDER
from tidemark.streaming.queries import keep_state_on_disk

# The operator travels to the executors with its code, as these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE = "at BIGINT, part INT, off BIGINT, op STRING"


def _order(row) -> tuple:
    """Place in the order of events; what is NULL comes first."""
    return tuple((value is not None, value) for value in (row[c] for c in EVENT_ORDER))


class NewestEvent(StatefulProcessor):
    """Passes on a key's newest event of each micro-batch if it is newer than all before."""

    def __init__(self, retention_ms: int):
        self.retention_ms = retention_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        best = max(rows, key=_order)
        held = self.newest.get()
        if held is not None:
            before = tuple((value is not None, value) for value in held[:3])
            if before >= _order(best):
                return
            if held[3] == "d":
                for timer in list(self.handle.listTimers()):
                    self.handle.deleteTimer(timer)
        self.newest.update((*[best[c] for c in EVENT_ORDER], best["operation_type"]))
        if best["operation_type"] == "d":
            now = max(timerValues.getCurrentWatermarkInMs(), best["operation_timestamp_ms"])
            self.handle.registerTimer(now + self.retention_ms)
        yield best

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.newest.clear()
        return iter(())

    def close(self) -> None:
        pass


def newest_events_stream(
    log: DataFrame, key: str, watermark: str = "10 minutes", retention_ms: int = 86_400_000
) -> DataFrame:
    """A change log's stream reduced to the events that were the newest of their key when they came.

    The last one of a key is its newest event. Events behind the watermark are dropped; a deleted key is
    forgotten once the watermark is ``retention_ms`` past its delete, so choose that to exceed the lateness
    to be borne: an older event that comes still later would bring the key back.
    """
    keep_state_on_disk(log.sparkSession)
    return (
        log.withWatermark("event_time", watermark)
        .groupBy(key)
        .transformWithState(
            NewestEvent(retention_ms), outputStructType=log.schema, outputMode="Append", timeMode="EventTime"
        )
    )
