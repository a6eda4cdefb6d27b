"""Newest row per key, now or at an earlier moment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.schemas import EVENT_ORDER


def top_row(df: DataFrame, by: Sequence[str], order: Sequence[str] = EVENT_ORDER) -> DataFrame:
    """The greatest row of each group by ``order``.

    Spark limits each group to one row before the shuffle as well as after it, so a key that
    holds most of the table still sends one row per map task.
    """
    newest_first = Window.partitionBy(*by).orderBy(*[F.col(c).desc() for c in order])
    ranked = df.withColumn("_rank", F.row_number().over(newest_first))
    return ranked.filter("_rank = 1").drop("_rank")


def latest_per_key(
    log: DataFrame,
    key: str | Sequence[str],
    live: bool = False,
    order: Sequence[str] = EVENT_ORDER,
) -> DataFrame:
    """Last event of each key; ``live`` leaves out keys whose last event is a delete."""
    keys = [key] if isinstance(key, str) else list(key)
    newest = top_row(log, keys, order)
    return newest.filter("operation_type <> 'd'") if live else newest


def state_at(
    log: DataFrame, key: str | Sequence[str], moment: Column, live: bool = True
) -> DataFrame:
    """The table as it stood at ``moment`` (a timestamp), rebuilt from the change log."""
    return latest_per_key(log.filter(F.col("event_time") <= moment), key, live)
