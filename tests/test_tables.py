"""Stored tables, views, configuration and a full refresh."""

import glob
import time

import pytest
from helpers import rows_of, same
from pyspark.sql import functions as F

from fixtures import cdc, queries
from tidemark.config import ROCKSDB_PROVIDER, LakeConfig, scratch_dir, session_builder
from tidemark.operators.bronze import to_bronze
from tidemark.operators.changelog import change_log
from tidemark.plans.layers import gold_tables, refresh, silver_tables
from tidemark.plans.views import GOLD_VIEWS
from tidemark.sources.tables import (
    SHUFFLES_GO,
    append,
    compact_partitions,
    materialize,
    publish,
    read_bronze,
    union_evolving,
)


def test_config_from_environment():
    env = {"KAFKA_BOOTSTRAP_SERVERS": "b:1", "BRONZE_LAYER_BASE_PATH": "/x"}
    lake = LakeConfig.from_env("/base/", env)
    assert (lake.kafka_bootstrap_servers, lake.bronze_path) == ("b:1", "/x")
    assert lake.silver_path == "/base/silver"
    assert lake.kafka_options() == {
        "kafka.bootstrap.servers": "b:1",
        "subscribePattern": r"dbserver1\.banking_db\..+",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    slow = LakeConfig.under("/base", max_offsets_per_trigger=50_000)
    assert slow.kafka_options()["maxOffsetsPerTrigger"] == "50000"


def test_session_builder_options():
    options = session_builder(delta=True)._options
    assert options["spark.sql.streaming.stateStore.providerClass"] == ROCKSDB_PROVIDER
    assert "delta" in options["spark.sql.extensions"]


def test_scratch_lies_in_the_named_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "a"), scratch_dir(spark, "a")
    assert first.startswith(root) and first != second


def test_publish_sets_comment_and_quality(spark):
    path = scratch_dir(spark, "published")
    table = publish(spark.range(3), "it_is", path, "it's a table", "gold")
    assert table.count() == 3
    described = {r[0]: r[1] for r in spark.sql("DESCRIBE EXTENDED it_is").collect()}
    assert described["Comment"] == "it's a table"
    assert "quality=gold" in described["Table Properties"]
    assert publish(spark.range(2), "it_is", path).count() == 2


def test_append_gains_columns(spark):
    path = scratch_dir(spark, "grown")
    append(spark.range(2), path)
    append(spark.range(2).withColumn("x", F.lit("a")), path)
    rows = read_bronze(spark, path, merge_schema=True)
    assert rows_of(rows, "id", "x") == [(0, "a"), (0, None), (1, "a"), (1, None)]
    ids = spark.range(1).select("id")
    both = union_evolving(ids, ids.withColumn("x", F.lit("a")))
    assert rows_of(both) == [(0, "a"), (0, None)]


def test_compaction_keeps_rows_and_cuts_files(spark):
    root = scratch_dir(spark, "compact")
    rows = spark.range(4000).withColumn("day", F.col("id") % 3)
    rows.repartition(16).write.partitionBy("day").parquet(f"{root}/small")
    packed = compact_partitions(spark, f"{root}/small", f"{root}/packed", ["day"], rows.schema)
    assert same(packed, spark.read.parquet(f"{root}/small"))
    assert len(glob.glob(f"{root}/small/*/*.parquet")) == 48
    assert len(glob.glob(f"{root}/packed/*/*.parquet")) <= 6
    one = compact_partitions(spark, f"{root}/small", f"{root}/one", ["day"], rows.schema, "day = 1")
    assert one.count() == rows.filter("day = 1").count()


def test_materialize_keeps_schema_and_rows(spark):
    df = spark.range(3).selectExpr("id", "struct(id AS a) AS s", "current_timestamp() AS t")
    assert materialize(df, "m").dtypes == df.dtypes
    assert materialize(df, "m").count() == 3


@pytest.fixture(scope="module")
def raw_log(spark, sf_dir):
    def table(name):
        return cdc.table(spark, sf_dir, name)

    everything = union_evolving(
        cdc.accounts(table("events")),
        cdc.customers(table("orders")),
        cdc.transactions(table("lineitem")),
        cdc.branches(table("supplier")),
    )
    path = scratch_dir(spark, "bronze")
    append(to_bronze(everything), path, ["table_name", "ingestion_date"])
    return read_bronze(spark, path)


def test_refresh_publishes_all_layers(spark, raw_log):
    lake = LakeConfig.under(scratch_dir(spark, "refresh"))
    tables = ["customers", "accounts", "atm_transactions", "branches", "merchants"]
    refresh(spark, raw_log, lake, tables)
    assert spark.table("silver.silver_accounts").count() == 15
    assert spark.table("silver.silver_merchants").isEmpty()
    assert spark.table("gold.gold_customer_dimension_history").count() == 874
    counts = {view: spark.table(f"gold.{view}").count() for view in GOLD_VIEWS}
    assert counts == {
        "vw_gold_customer_current": 93,
        "vw_gold_daily_account_summary": 364,
        "vw_gold_daily_transaction_summary": 4455,
        "vw_gold_branch_current": 9,
    }
    assert dict(spark.table("gold.vw_gold_branch_current").dtypes)["last_updated_at"] == "timestamp"
    refresh(spark, raw_log, lake, tables)  # again, over what is there
    assert spark.table("gold.vw_gold_branch_current").count() == 9


def test_lazy_layers_agree_with_check_values(spark, raw_log):
    silver = silver_tables(raw_log)
    assert len(silver) == 13
    assert silver["merchants"].snapshot.isEmpty()
    gold = gold_tables(
        silver["customers"].log,
        silver["accounts"].log,
        silver["atm_transactions"].snapshot,
        silver["branches"].log,
    )
    total = gold["gold_daily_transactions_summary"].agg(F.sum("total_transaction_amount"))
    assert round(total.first()[0], 2) == 243_403_726.02
    daily = gold["gold_daily_account_balances"]
    assert daily.agg(F.sum("daily_updates_count")).first()[0] == 790
    assert gold["gold_customer_dimension"].count() == 93
    assert change_log(raw_log, "accounts").count() == 989


def test_raw_logs_of_all_tables_are_stored_once(spark, tmp_path, monkeypatch):
    """Made straight into the shared log: no second copy, and one write moves no text."""
    regions = spark.createDataFrame([(i, f"R{i}") for i in range(8)], "r_regionkey BIGINT, r_name STRING")
    regions.write.parquet(f"{tmp_path}/region.parquet")
    suppliers = spark.createDataFrame(
        [(i, f"S{i}", i % 3) for i in range(1, 41)], "s_suppkey BIGINT, s_name STRING, s_nationkey INT"
    )
    suppliers.write.parquet(f"{tmp_path}/supplier.parquet")
    monkeypatch.setattr(queries, "MAKERS", {n: queries.MAKERS[n] for n in ("services", "branches")})
    monkeypatch.setattr(queries, "_STORED", {})
    everything = queries.raw_of_all_tables(spark, str(tmp_path), f"{tmp_path}/all")
    assert {r.table_name: r["count"] for r in everything.groupBy("table_name").count().collect()} == {
        "services": 8, "branches": 44
    }
    for name in queries.MAKERS:
        stored = queries.raw(spark, str(tmp_path), name)
        assert all(f"{tmp_path}/all/table_name=" in f for f in stored.inputFiles())
        made = queries.made(spark, str(tmp_path), name)
        assert rows_of(stored, "raw_cdc_json", "kafka_offset") == rows_of(made, "raw_cdc_json", "kafka_offset")
    # what is stored already is copied by partition
    again = queries.raw_of_all_tables(spark, str(tmp_path), f"{tmp_path}/again")
    assert rows_of(again) == rows_of(everything)
    parts = list(queries.in_partitions(everything))
    assert len(parts) == 2 and sum(p.count() for p in parts) == 52
    for part in parts:
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Sort" not in plan


def test_a_table_dealt_evenly_is_read_as_it_lies(spark, tmp_path):
    """Rows move only where some core would have far more of them than others."""
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(4000).withColumnRenamed("id", "n")
    rows.repartition(4 * cores).write.parquet(f"{tmp_path}/even.parquet")
    rows.coalesce(1).write.parquet(f"{tmp_path}/one.parquet")
    rows.repartition(4 * cores, F.greatest("n", F.lit(3900))).write.parquet(f"{tmp_path}/heavy.parquet")
    spark.range(0).write.parquet(f"{tmp_path}/empty.parquet")
    for name, moved in (("even", False), ("one", True), ("heavy", True), ("empty", True)):
        table = cdc.table(spark, str(tmp_path), name)
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert ("Exchange" in plan) == moved, name
        assert table.count() == (0 if name == "empty" else 4000)


def test_shuffle_files_of_stored_steps_go(spark):
    """Large steps need not pile up on the executors' disks."""
    local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def held():
        return sum(f.getName().startswith("shuffle_") for f in (local.getAllFiles().apply(i) for i in range(local.getAllFiles().size())))

    before = held()
    counts = materialize(spark.range(20_000).groupBy((F.col("id") % 5000).alias("k")).count(), "counts")
    for _ in range(50):
        if held() <= before:
            break
        time.sleep(0.2)
    assert held() <= before and counts.count() == 5000
    assert spark.conf.get(SHUFFLES_GO) == "false"
