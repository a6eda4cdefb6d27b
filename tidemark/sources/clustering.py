"""Files laid out so that a lookup by key, by time or by both reads few of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bits of each column's place that are interleaved: up to 256 steps.
BITS = 8


def _whole(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("bigint")
    if isinstance(kind, T.IntegralType):
        return F.col(column).cast("bigint")
    raise TypeError(f"{column} must be an integer, date or timestamp, not {kind.simpleString()}")


def with_place(df: DataFrame, columns: Sequence[str], name: str = "_place", accuracy: int = 10_000) -> DataFrame:
    """Add rows' places on a curve that goes through all columns' ranges together (Z-order).

    A column's place is its step among 255 approximate quantiles of the whole frame, so skewed and
    bunched values are spread evenly. The quantiles are one aggregation, and nothing else comes to the
    driver. Rows without a value come first.
    """
    steps = 1 << BITS
    shares = [i / steps for i in range(1, steps)]
    asked = [F.percentile_approx(_whole(df, c), shares, accuracy) for c in columns]
    borders = df.agg(*[q.alias(f"q{i}") for i, q in enumerate(asked)]).first()
    place = F.lit(0)
    rows = df
    for i, column in enumerate(columns):
        cuts = sorted(set(borders[i] or []))
        padded = F.array(*[F.lit(x).cast("bigint") for x in [*cuts, *[None] * (steps - 1 - len(cuts))]])
        rows = rows.withColumn("_value", _whole(df, column)).withColumn("_step", F.lit(0))
        for bit in reversed(range(BITS)):  # by halving, the number of borders up to the value
            size = 1 << bit
            passed = F.get(padded, F.col("_step") + size - 1) <= F.col("_value")
            rows = rows.withColumn("_step", F.when(passed, F.col("_step") + size).otherwise(F.col("_step")))
        rows = rows.withColumn(f"_step{i}", F.col("_step"))
        for bit in range(BITS):
            part = F.shiftright(f"_step{i}", bit).bitwiseAND(F.lit(1))
            place = place.bitwiseOR(F.shiftleft(part, bit * len(columns) + i))
    return rows.withColumn(name, place).select(*df.columns, name)


def write_clustered(
    df: DataFrame, path: str, columns: Sequence[str], files: int, bloom: Sequence[str] = (), rows_per_group: int = 0
) -> None:
    """Write about ``files`` files, each a stretch of the curve through ``columns``.

    Footers then rule out most files and row groups for a range of any of the columns. ``bloom`` names
    columns that get Bloom filters too, which rule out row groups for single values within a range.
    """
    placed = with_place(df, columns)
    rows = placed.repartitionByRange(files, "_place").sortWithinPartitions("_place").drop("_place")
    writer = rows.write.mode("overwrite")
    for column in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    if rows_per_group:
        writer = writer.option("parquet.block.row.count.limit", rows_per_group)
    # footers have no bounds for timestamps in Spark's usual form
    conf, form = df.sparkSession.conf, "spark.sql.parquet.outputTimestampType"
    before = conf.get(form)
    conf.set(form, "TIMESTAMP_MICROS")
    try:
        writer.parquet(path)
    finally:
        conf.set(form, before)
