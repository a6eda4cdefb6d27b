"""Slowly changing dimensions, type 1 and type 2."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators.latest import latest_per_key, top_row
from tidemark.operators.quality import VALID_BRANCH, expect
from tidemark.operators.skew import ROWS_PER_TASK, by_heat, split_hot_keys

START, END = "__START_AT", "__END_AT"

# The customer attributes whose change opens a new version, in declared order.
CUSTOMER_TRACKED = (
    "first_name",
    "last_name",
    "email",
    "phone_number",
    "address_line1",
    "address_line2",
    "city",
    "state",
    "zip_code",
    "date_of_birth",
    "gender",
)


def _merge_runs(rows: DataFrame, by: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    """Merge neighbouring rows of a group into versions, each shown by its last row.

    Rows carry ``__START_AT``, ``__END_AT`` (NULL if not yet known), ``_deleted`` and ``_joinable``
    (whether the row may continue the one before it). Two neighbours are one version if both are
    deletes, or neither is and their tracked columns agree, NULLs counting as equal. All windows
    share one partitioning and order: one shuffle, one sort.
    """
    ordered = Window.partitionBy(*by).orderBy(START)
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    image = F.struct(*tracked)
    same = (F.col("_prev_deleted") == F.col("_deleted")) & (
        F.col("_deleted") | image.eqNullSafe(F.col("_prev_image"))
    )
    marked = (
        rows.withColumns(
            {
                "_prev_deleted": F.lag("_deleted").over(ordered),
                "_prev_image": F.lag(image).over(ordered),
                "_next_start": F.lead(START).over(ordered),
            }
        )
        .withColumn("_opens", ~(F.col("_joinable") & F.coalesce(same, F.lit(False))))
        .withColumn("_leads", F.col("_joinable") & F.col("_prev_deleted").isNull())
    )
    opening = F.when(F.col("_opens"), F.struct(START, "_leads"))
    closed = marked.withColumns(
        {
            "_opening": F.last(opening, ignorenulls=True).over(upto),
            "_next_opens": F.lead("_opens").over(ordered),
        }
    ).filter("_next_opens IS NULL OR _next_opens")
    return (
        closed.withColumn(END, F.coalesce(END, "_next_start"))
        .withColumn(START, F.col("_opening")[START])
        .withColumn("_joinable", F.col("_opening")["_leads"])
        .drop("_prev_deleted", "_prev_image", "_next_start", "_opens", "_leads")
        .drop("_opening", "_next_opens")
    )


def stitch_versions(
    versions: DataFrame, keys: Sequence[str], pieces: Sequence[str], tracked: Sequence[str]
) -> DataFrame:
    """Join up versions that were built per piece of each key's history.

    Only a piece's first and last version can touch another piece, so only those are brought
    together per key; the versions between them stay where they are.
    """
    border = F.col("_joinable") | F.col(END).isNull()
    seats = {f"_seat_{c}": F.when(~border, F.col(c)) for c in pieces}
    seated = versions.withColumns({**seats, "_inner": ~border})
    merged = _merge_runs(seated, [*keys, "_inner", *seats], tracked)
    return merged.drop("_inner", *seats)


def version_rows(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    tracked: Sequence[str],
    delete_when: str = "false",
    tie_break: Sequence[str] = (),
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Versions with their delete markers still in place (``_deleted``), as ``scd2_apply`` uses."""
    stored = changes.columns
    usable = changes.filter(
        " AND ".join(f"`{c}` IS NOT NULL" for c in [*keys, sequence_by])
    )
    ties = list(tie_break) or ["_tie"]
    if not tie_break:
        usable = usable.withColumn("_tie", F.xxhash64(*stored))
    rows, part, piled = split_hot_keys(usable, keys, sequence_by, rows_per_task)
    if piled:
        # Many rows of one key share a sequence and count once: thin them out before the shuffle.
        rows = top_row(rows, [*part, sequence_by], ties)

    def merged(rows: DataFrame, by: Sequence[str]) -> DataFrame:
        ordered = Window.partitionBy(*by).orderBy(sequence_by, *ties)
        single = (
            rows.withColumn("_next", F.lead(sequence_by).over(ordered))
            .filter(F.col("_next").isNull() | (F.col("_next") != F.col(sequence_by)))
            .drop("_next", "_tie")
            .withColumns(
                {
                    START: F.col(sequence_by),
                    END: F.lit(None).cast(changes.schema[sequence_by].dataType),
                    "_deleted": F.coalesce(F.expr(delete_when), F.lit(False)),
                    "_joinable": F.lit(True),
                }
            )
        )
        return _merge_runs(single, by, tracked)

    columns = [*stored, START, END, "_deleted", "_joinable"]
    ordinary, heavy = by_heat(rows, keys, part)
    versions = merged(ordinary, keys).select(*columns)
    if heavy is None:
        return versions
    stitched = stitch_versions(merged(heavy, part), keys, part[len(keys):], tracked)
    return versions.unionByName(stitched.select(*columns))


def scd2_apply(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    tracked: Sequence[str],
    delete_when: str = "false",
    except_cols: Sequence[str] = (),
    tie_break: Sequence[str] = (),
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Full history of a keyed table from its changes, in any order and with repeats.

    A version lasts while the ``tracked`` columns stay equal; other columns hold their last value
    within it. ``delete_when`` (SQL) closes the open version, and a later row opens a new one even
    with equal values. Intervals ``[__START_AT, __END_AT)`` are half-open, NULL end = open. Rows
    that share key and sequence count once, the greatest by ``tie_break``. Rows without a key or
    sequence cannot be placed and belong in quarantine.
    """
    versions = version_rows(
        changes, keys, sequence_by, tracked, delete_when, tie_break, rows_per_task
    )
    return visible_versions(versions, except_cols)


def visible_versions(versions: DataFrame, except_cols: Sequence[str] = ()) -> DataFrame:
    """Versions as readers see them: without delete markers and helper columns."""
    return versions.filter("NOT _deleted").drop("_deleted", "_joinable", *except_cols)


def current(history: DataFrame) -> DataFrame:
    """Open versions of a type 2 history."""
    return history.filter(F.col(END).isNull())


def as_of(history: DataFrame, moment: Column) -> DataFrame:
    """Versions valid at ``moment``, in the units of ``__START_AT``."""
    return history.filter(
        (F.col(START) <= moment) & (F.col(END).isNull() | (moment < F.col(END)))
    )


def scd1_apply(log: DataFrame, key: str) -> DataFrame:
    """Type 1 dimension: last state of every key that still exists."""
    return latest_per_key(log.filter(F.col(key).isNotNull()), key, live=True)


def customer_dimension_changes(log: DataFrame) -> DataFrame:
    """Customer change rows as the history wants them, with the event order kept for ties."""
    return log.select(
        "customer_id",
        *CUSTOMER_TRACKED,
        "registration_date",
        F.col("operation_timestamp_ms").alias("effective_timestamp"),
        F.col("operation_type").alias("cdc_operation_type"),
        F.current_timestamp().alias("gold_ingestion_timestamp"),
        "kafka_partition",
        "kafka_offset",
    )


# How customer changes become the customer dimension.
CUSTOMER_HISTORY = {
    "keys": ["customer_id"],
    "sequence_by": "effective_timestamp",
    "tracked": CUSTOMER_TRACKED,
    "delete_when": "cdc_operation_type = 'd'",
    "tie_break": ["kafka_partition", "kafka_offset"],
}
CUSTOMER_HIDDEN = ("cdc_operation_type", "kafka_partition", "kafka_offset")


def customer_history(changes: DataFrame, rows_per_task: int | None = ROWS_PER_TASK) -> DataFrame:
    """Type 2 customer dimension from ``customer_dimension_changes``.

    The changes are read twice (keys first), so hand in a stored frame where they are costly.
    """
    return scd2_apply(
        changes,
        **CUSTOMER_HISTORY,
        except_cols=CUSTOMER_HIDDEN,
        rows_per_task=rows_per_task,
    )


def branch_dimension(log: DataFrame) -> DataFrame:
    """Branches that exist, each with its last state and when that was written."""
    return scd1_apply(expect(log, VALID_BRANCH), "branch_id").select(
        "branch_id",
        "branch_name",
        "address",
        "city",
        "state",
        "zip_code",
        "phone_number",
        F.col("operation_timestamp_ms").alias("last_updated_ms"),
    )
