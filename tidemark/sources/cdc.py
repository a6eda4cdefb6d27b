"""Change-event sources: Kafka, or replayed files of Kafka-shaped records."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tidemark.config import LakeConfig

# The columns of Spark's Kafka source that are used.
RECORD_SCHEMA = (
    "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"
)


class KafkaUnavailable(RuntimeError):
    """The Kafka source package is not on the session's classpath."""


def _kafka(reader, config: LakeConfig, **extra: str) -> DataFrame:
    try:
        return reader.format("kafka").options(**config.kafka_options(), **extra).load()
    except AnalysisException as error:
        raise KafkaUnavailable(
            "add the spark-sql-kafka-0-10 package matching this Spark version"
        ) from error


def read_cdc_stream(
    spark: SparkSession,
    config: LakeConfig,
    fmt: str = "kafka",
    path: str | None = None,
    max_files_per_trigger: int | None = None,
    file_format: str = "parquet",
) -> DataFrame:
    """Unbounded change records from all matching Kafka topics, or from files added to ``path``.

    Lost offsets and lost files are both tolerated unless the configuration says otherwise.
    """
    if fmt == "kafka":
        return _kafka(spark.readStream, config)
    if fmt != "files":
        raise ValueError(f"fmt must be kafka or files, not {fmt!r}")
    reader = (
        spark.readStream.schema(RECORD_SCHEMA)
        .format(file_format)
        .option("ignoreMissingFiles", str(not config.fail_on_data_loss).lower())
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def read_cdc_batch(
    spark: SparkSession,
    config: LakeConfig,
    fmt: str = "kafka",
    path: str | None = None,
    file_format: str = "parquet",
) -> DataFrame:
    """The same records as a bounded frame, for backfills."""
    if fmt == "kafka":
        return _kafka(spark.read, config)
    if fmt != "files":
        raise ValueError(f"fmt must be kafka or files, not {fmt!r}")
    return spark.read.schema(RECORD_SCHEMA).format(file_format).load(path)
