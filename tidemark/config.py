"""One settings object for paths, Kafka options and cadence, plus session and scratch helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


@dataclass(frozen=True)
class LakeConfig:
    bronze_path: str
    checkpoint_path: str
    silver_path: str = ""
    gold_path: str = ""
    kafka_bootstrap_servers: str = "localhost:9092"
    topic_pattern: str = r"dbserver1\.banking_db\..+"
    starting_offsets: str = "earliest"
    fail_on_data_loss: bool = False
    # Kafka records a micro-batch takes at most; None: all there are. 50_000 is a usual choice
    # for small sources.
    max_offsets_per_trigger: int | None = None
    # Files a micro-batch takes at most from a stored table, the first one of a backfill included.
    max_files_per_trigger: int | None = 1000
    trigger_interval: str = "30 seconds"
    keyed_interval: str = "10 minutes"
    watermark: str = "10 minutes"
    table_format: str = "parquet"
    buckets: int = 64
    # Calendar period of a piece of the live facts: with the buckets, what a late event has redone.
    fact_period: str = "day"
    # Tasks that write a month of closed-day facts.
    fact_writers: int = 256

    @classmethod
    def under(cls, base: str, **overrides) -> "LakeConfig":
        """All layers below one root directory."""
        base = base.rstrip("/")
        paths = {f"{layer}_path": f"{base}/{layer}" for layer in ("bronze", "silver", "gold")}
        return cls(**{**paths, "checkpoint_path": f"{base}/checkpoints", **overrides})

    @classmethod
    def from_env(cls, base: str, env=os.environ) -> "LakeConfig":
        """Layers below ``base``, with broker, topic and path settings taken from the environment."""
        names = {
            "kafka_bootstrap_servers": "KAFKA_BOOTSTRAP_SERVERS",
            "topic_pattern": "KAFKA_TOPIC_PATTERN",
            "bronze_path": "BRONZE_LAYER_BASE_PATH",
            "checkpoint_path": "CHECKPOINT_BASE_PATH",
        }
        return cls.under(base, **{field: env[var] for field, var in names.items() if var in env})

    def kafka_options(self) -> dict[str, str]:
        # Option names of the Kafka source.
        options = {
            "kafka.bootstrap.servers": self.kafka_bootstrap_servers,
            "subscribePattern": self.topic_pattern,
            "startingOffsets": self.starting_offsets,
            "failOnDataLoss": str(self.fail_on_data_loss).lower(),
        }
        if self.max_offsets_per_trigger:
            options["maxOffsetsPerTrigger"] = str(self.max_offsets_per_trigger)
        return options


def session_builder(app_name: str = "tidemark", delta: bool = False) -> SparkSession.Builder:
    """Recommended session settings; ``delta`` needs the Delta Lake package on the classpath."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
        .config("spark.ui.enabled", "false")
    )
    if delta:
        builder = (
            builder.config("spark.sql.extensions", "io.delta.sql.DeltaSparkSessionExtension")
            .config(
                "spark.sql.catalog.spark_catalog",
                "org.apache.spark.sql.delta.catalog.DeltaCatalog",
            )
            .config("spark.databricks.delta.schema.autoMerge.enabled", "true")
        )
    return builder


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory for written intermediate tables and stream checkpoints.

    It lies in the shared folder named by ``spark.checkpoint.dir``. Only a local-mode session
    may go without that setting.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
