"""Stored tables: reading by path or name, publishing with properties, schema growth, compaction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.config import scratch_dir

BRONZE_SCHEMA = (
    "raw_cdc_json STRING, kafka_topic STRING, kafka_partition INT, kafka_offset BIGINT, "
    "kafka_timestamp TIMESTAMP, processing_timestamp TIMESTAMP, table_name STRING, "
    "ingestion_date DATE"
)

# Of stored text and intermediate tables: JSON takes about half the room it takes with Spark's default.
CODEC = "zstd"
# Has Spark delete the shuffle files of a query when it ends.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_bronze(
    spark: SparkSession, path: str, fmt: str = "parquet", merge_schema: bool = False
) -> DataFrame:
    """The raw log with its declared columns.

    ``merge_schema`` also brings in columns that were added over time. It reads the footer of
    every file to find them, so keep it for jobs that need those columns.
    """
    reader = spark.read.format(fmt)
    if merge_schema:
        return reader.option("mergeSchema", "true").load(path)
    return (reader if fmt == "delta" else reader.schema(BRONZE_SCHEMA)).load(path)


def read_bronze_stream(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The raw log as it grows. File streams need the schema up front; Delta brings its own."""
    reader = spark.readStream.format(fmt)
    if fmt != "delta":
        reader = reader.schema(BRONZE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def read_dataset(spark: SparkSession, name: str, streaming: bool = False) -> DataFrame:
    """A published table by name, bounded or as a stream."""
    return (spark.readStream if streaming else spark.read).table(name)


def spread_for_write(df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """Rebalance before a write: small partitions are merged and big ones split by measured size,
    so a dominant table or day is written by many tasks and a tiny one into a single file."""
    return df.hint("rebalance", *partition_by) if partition_by else df.hint("rebalance")


def append(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    spread: bool = True,
) -> None:
    """Append, letting the table gain columns (Parquet merges them on read, Delta on write).

    ``spread=False`` leaves out the rebalancing, for rows that are dealt evenly already and lie in
    few partitions.
    """
    rows = spread_for_write(df, partition_by) if spread else df
    writer = rows.write.format(fmt).mode("append")
    option = ("mergeSchema", "true") if fmt == "delta" else ("compression", CODEC)
    writer = writer.option(*option)
    writer.partitionBy(*partition_by).save(path)


def union_evolving(*frames: DataFrame) -> DataFrame:
    """Union by name of frames from different schema versions; absent columns become NULL."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back.

    For frames that several later passes read: they then scan the columns they need instead of
    computing the frame again, and a lost executor costs a re-read, not a re-run. The shuffle files of
    the write go when it ends; else they stay until the driver happens to collect garbage, and the steps
    of a long job pile up on the executors' disks.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    before = spark.conf.get(SHUFFLES_GO, "false")
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        df.write.option("compression", CODEC).parquet(path)
    finally:
        spark.conf.set(SHUFFLES_GO, before)
    return spark.read.schema(df.schema).parquet(path)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def publish(
    df: DataFrame,
    name: str,
    path: str | None = None,
    comment: str | None = None,
    quality: str | None = None,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
) -> DataFrame:
    """Store a frame as a catalog table with comment and quality tag, and read it back."""
    spark = df.sparkSession
    writer = spread_for_write(df, partition_by).write.format(fmt).mode("overwrite")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    if comment:
        spark.sql(f"COMMENT ON TABLE {name} IS {_quoted(comment)}")
    if quality:
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('quality' = {_quoted(quality)})")
    return spark.table(name)


def compact_partitions(
    spark: SparkSession,
    source: str,
    target: str,
    partition_by: Sequence[str],
    schema: T.StructType | str,
    where: str | None = None,
) -> DataFrame:
    """Rewrite a partitioned table's many small files into few, at a new place.

    ``schema`` is the table's, partition columns included: without it Spark would guess their types
    from folder names (``007`` as 7) and read a file of the many to find the others. ``where`` (on
    partition columns) limits the work, for example to closed days. The source stays as it is, so
    readers and a failed run lose nothing; switch them over when it is done.
    """
    rows = spark.read.schema(schema).parquet(source)
    if where:
        rows = rows.filter(where)
    (
        spread_for_write(rows, partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(target)
    )
    return spark.read.schema(schema).parquet(target)
