"""Column profiles per day as sketches that merge, and how a day differs from those before it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

# Registers of a distinct-count sketch as a power of two: a standard error of 1.6 %.
DISTINCT_BITS = 12
# Size of a quantile sketch: a rank is off by about 0.7 % of the rows (half of K = 200's 1.33 %).
QUANTILE_K = 400
QUANTILES = (0.05, 0.5, 0.95)


def _as_long_form(df: DataFrame, columns: Sequence[str]) -> Column:
    """One entry per column: its name, its value as text and, for numbers and times, as a double."""

    def number(name: str) -> Column:
        kind = df.schema[name].dataType
        if isinstance(kind, T.NumericType):
            value = F.col(name).cast("double")
            return F.when(~F.isnan(value), value)
        if isinstance(kind, T.TimestampType):
            return F.unix_micros(name) / F.lit(1_000_000.0)
        if isinstance(kind, T.DateType):
            return F.unix_date(name).cast("double")
        return F.lit(None).cast("double")

    entries = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"), number(c).alias("number"))
        for c in columns
    ]
    return F.inline(F.array(*entries))


def daily_profile(df: DataFrame, day: Column, columns: Sequence[str]) -> DataFrame:
    """``(day, column_name, rows, filled, distinct_sketch, number_sketch)``.

    All columns in one pass and one aggregation, combined map-side: a task sends a sketch of bounded
    size per day and column, however many rows or values there are.
    """
    long = df.select(day.alias("day"), _as_long_form(df, columns))
    return long.groupBy("day", "column_name").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("value").alias("filled"),
        F.hll_sketch_agg("value", F.lit(DISTINCT_BITS)).alias("distinct_sketch"),
        F.kll_sketch_agg_double("number", F.lit(QUANTILE_K)).alias("number_sketch"),
    )


def merged_profile(profile: DataFrame, period: Column) -> DataFrame:
    """The same for longer periods (a column of ``day``), from the days' sketches alone."""
    return profile.groupBy(period.alias("day"), "column_name").agg(
        F.sum("rows").alias("rows"),
        F.sum("filled").alias("filled"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("number_sketch").alias("number_sketch"),
    )


def read_profile(profile: DataFrame, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """Figures instead of sketches: ``distinct_values`` and an array of ``quantiles`` (NULL without
    numbers)."""
    some = F.kll_sketch_get_n_double("number_sketch") > 0
    asked = F.array(*[F.lit(float(q)) for q in quantiles])
    return profile.select(
        "day",
        "column_name",
        "rows",
        "filled",
        F.hll_sketch_estimate("distinct_sketch").alias("distinct_values"),
        F.when(some, F.kll_sketch_get_quantile_double("number_sketch", asked)).alias("quantiles"),
    )


def drift(profile: DataFrame, days: int = 7) -> DataFrame:
    """Each day and column against the ``days`` calendar days before it (those that there are).

    ``filled_change`` is the difference of the shares that are filled, ``distinct_ratio`` the number of
    different values over the earlier days' mean, ``median_rank`` where the day's median stands among
    the earlier days' numbers, in hundredths (0.5 if nothing moved). NULL for a first day.
    """
    earlier = Window.partitionBy("column_name").orderBy(F.unix_date("day")).rangeBetween(-days, -1)
    distinct = F.hll_sketch_estimate("distinct_sketch")
    seen = profile.withColumns(
        {
            "_distinct": distinct,
            "_rows": F.sum("rows").over(earlier),
            "_filled": F.sum("filled").over(earlier),
            "_mean_distinct": F.avg(distinct).over(earlier),
            "_sketches": F.collect_list("number_sketch").over(earlier),  # ``days`` sketches at most
        }
    )
    empty = F.slice("_sketches", 2, days)
    before = F.aggregate(empty, F.element_at("_sketches", 1), lambda a, b: F.kll_sketch_merge_double(a, b))
    before = F.when(F.size("_sketches") > 0, before)
    has = (F.kll_sketch_get_n_double("number_sketch") > 0) & (F.kll_sketch_get_n_double("_before") > 0)
    median = F.kll_sketch_get_quantile_double("number_sketch", F.lit(0.5))
    grid = F.kll_sketch_get_quantile_double("_before", F.array(*[F.lit(i / 100) for i in range(1, 101)]))
    reached = F.size(F.filter(grid, lambda q: q <= F.col("_median"))) / F.lit(100.0)
    seen = seen.withColumn("_before", before).withColumn("_median", F.when(has, median))
    return seen.select(
        "day",
        "column_name",
        (F.try_divide("filled", "rows") - F.try_divide("_filled", "_rows")).alias("filled_change"),
        F.try_divide("_distinct", "_mean_distinct").alias("distinct_ratio"),
        F.when(has, reached).alias("median_rank"),
    )
