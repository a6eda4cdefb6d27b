"""Ordered per-key work that stays spread out when a few keys hold much of the table.

A window over one key runs in one task. Here the rows of heavy keys are dealt out by ranges of key
and order, the window runs per range, and only what crosses a border is joined up later.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.sources.tables import materialize

# Rows of one key that a single task may sort.
ROWS_PER_TASK = 2_000_000
# Ranges are cut by a sample, so cut more of them than the mean asks for; for the same reason, and as
# they are dealt to tasks by hash, up to as many times the session's tasks.
OVERSPLIT = 4
SLICE = "_slice"


def _position(df: DataFrame, column: str) -> Column:
    """The ordering column as a whole number."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(dtype, T.DateType):
        return F.unix_date(column).cast("bigint")
    if isinstance(dtype, T.IntegralType):
        return F.col(column).cast("bigint")
    raise TypeError(f"{column} must be an integer, date or timestamp, not {dtype.simpleString()}")


def split_hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    rows_per_task: int | None = ROWS_PER_TASK,
    count_on: DataFrame | None = None,
) -> tuple[DataFrame, list[str], bool]:
    """Give each heavy key's rows a slice number that grows with ``order``.

    Returns the frame, the columns to partition ordered windows by, and whether some key has more
    than ``rows_per_task`` rows at one point of the order, where no cut can part them. The columns
    are just ``keys`` when no key is heavy, else ``keys`` and a slice number, NULL on the rows of
    ordinary keys.

    Counting the keys is one aggregation over the key columns alone, run at once; only their
    number reaches the driver. The heavy keys stay a table, however many they are, and are joined
    on the key. Their rows are then range-partitioned by key and order, for which Spark samples
    them, so slices follow the rows' own distribution, outliers and bunched times included. Rows
    at the same point stay together. Sliced rows are stored, as a slice is where Spark put it.
    There are never more slices, hence tasks and files, than ``OVERSPLIT`` times the tasks that the
    session's shuffles have: these take their even share of all rows anyway, so smaller slices
    would spread no better.
    Only a speed choice hangs on the counts: any cut along the order gives the same final result.
    So ``count_on`` may name a cheaper frame with the same keys to count on.

    ``rows_per_task=None`` skips the count, for inputs known to hold no heavy key.
    """
    part = list(keys)
    if rows_per_task is None:
        return df, part, False
    position = _position(df, order)
    counted = df if count_on is None else count_on
    counts = counted.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    heavy = materialize(counts.filter(F.col("_rows") > rows_per_task), "heavy_keys")
    rows = heavy.agg(F.sum("_rows")).first()[0]
    if not rows:
        return df, part, False
    spark = df.sparkSession
    tasks = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism
    )
    slices = min(-(-rows * OVERSPLIT // rows_per_task), OVERSPLIT * tasks)
    ordinary = df.join(heavy, part, "left_anti")
    dealt = (
        df.join(heavy, part, "left_semi")
        .repartitionByRange(slices, *part, position)
        .withColumn(SLICE, F.spark_partition_id())
    )
    dealt = materialize(dealt, "heavy_rows")
    points = dealt.groupBy(*part, position.alias("_at")).count()
    piled = not points.filter(F.col("count") > rows_per_task).isEmpty()
    nothing = F.lit(None).cast("int")
    return ordinary.withColumn(SLICE, nothing).unionByName(dealt), [*part, SLICE], piled


def by_heat(
    df: DataFrame, keys: Sequence[str], part: Sequence[str]
) -> tuple[DataFrame, DataFrame | None]:
    """The rows of ordinary keys, and those of heavy keys with their slices (None if there are
    none), so that only the heavy ones pay for being cut up."""
    slices = list(part[len(keys):])
    if not slices:
        return df, None
    heavy = F.col(slices[0]).isNotNull()
    return df.filter(~heavy).drop(*slices), df.filter(heavy)


def fill_from_earlier(
    df: DataFrame,
    keys: Sequence[str],
    part: Sequence[str],
    order: Sequence[str],
    value: str,
    into: str,
    include_current: bool = True,
) -> DataFrame:
    """Add ``into``: the last non-NULL ``value`` of the key up to each row.

    ``part`` comes from ``split_hot_keys``. Within a slice this is a window; a slice's opening
    rows take the last value of the key's earlier slices from a side table with one row per slice
    of a heavy key. That join is on the window's own partitioning, so the rows do not move again.
    """
    through = 0 if include_current else -1

    def filled(rows: DataFrame, by: Sequence[str]) -> DataFrame:
        ordered = Window.partitionBy(*by).orderBy(*order)
        upto = ordered.rowsBetween(Window.unboundedPreceding, through)
        return rows.withColumn(into, F.last(value, ignorenulls=True).over(upto))

    ordinary, heavy = by_heat(df, keys, part)
    if heavy is None:
        return filled(ordinary, keys)
    slices = part[len(keys):]
    earlier = (
        Window.partitionBy(*keys)
        .orderBy(*slices)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    present = F.when(F.col(value).isNotNull(), F.struct(*order))
    carried = (
        heavy.groupBy(*part)
        .agg(F.max_by(value, present).alias("_end"))
        .withColumn("_carry", F.last("_end", ignorenulls=True).over(earlier))
        .select(*part, "_carry")
    )
    joined = filled(heavy, part).join(carried, list(part), "left")
    joined = joined.withColumn(into, F.coalesce(into, "_carry")).drop("_carry", *slices)
    return filled(ordinary, keys).unionByName(joined)
