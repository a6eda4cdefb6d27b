"""Registered queries: each runs library operators over whole test tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fixtures import cdc
from tidemark.config import LakeConfig, scratch_dir
from tidemark.functions.envelope import parse_envelope, table_of
from tidemark.functions.images import cast_text
from tidemark.functions.money import exact_sum
from tidemark.functions.order import event_order_key
from tidemark.operators import bronze as bronze_ops
from tidemark.operators import changelog, facts, joins, latest, offsets, profiles, quality, scd
from tidemark.plans.layers import silver_tables
from tidemark.plans.views import create_gold_views, create_schema
from tidemark.schemas import key_of, table_schema
from tidemark.sources import clustering, snapshots
from tidemark.sources.cdc import read_cdc_batch, read_cdc_stream
from tidemark.sources.tables import (
    append,
    compact_partitions,
    materialize,
    publish,
    read_bronze,
    read_bronze_stream,
    read_dataset,
    union_evolving,
)
from tidemark.streaming import keyed, live, states
from tidemark.streaming import queries as streams
from tidemark.streaming.fanout import SilverFanout

MAKERS = {
    "accounts": (cdc.accounts, "events"),
    "customers": (cdc.customers, "orders"),
    "atm_transactions": (cdc.transactions, "lineitem"),
    "branches": (cdc.branches, "supplier"),
    "loans": (cdc.loans, "orders"),
    "cards": (cdc.cards, "customer"),
    "employees": (cdc.employees, "supplier"),
    "transaction_types": (cdc.transaction_types, "nation"),
    "audit_logs": (cdc.audit_logs, "events"),
    "products": (cdc.products, "part"),
    "services": (cdc.services, "region"),
    "transaction_details": (cdc.transaction_details, "lineitem"),
    "merchants": (cdc.merchants, "customer"),
}

STATE_MOMENT = "timestamp'2024-01-15 00:00:00'"
HISTORY_MOMENT = 883612800000  # 1998-01-01 in epoch ms

ACCOUNT_FIELDS = (
    "account_id",
    "customer_id",
    "account_type",
    "balance",
    "currency",
    "open_date",
    "status",
    "last_activity_date",
)
CHANGE_FIELDS = (
    *ACCOUNT_FIELDS,
    "operation_type",
    "operation_timestamp_ms",
    "event_time",
    "kafka_partition",
    "kafka_offset",
)
HISTORY_FIELDS = (
    "customer_id",
    "first_name",
    "city",
    "date_of_birth",
    "registration_date",
    "effective_timestamp",
    "__START_AT",
    "__END_AT",
)


def plain(df: DataFrame, *columns: str) -> DataFrame:
    """Chosen columns, instants without zone (as the test tables hold them)."""
    df = df.select(*columns) if columns else df
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def records(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    make, source = MAKERS[name]
    return make(cdc.table(spark, sf_dir, source))


_STORED: dict[tuple[str, str, str], DataFrame] = {}


def made(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bronze_ops.to_bronze(records(spark, sf_dir, name), route_by="topic")


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The raw log of one table, stored the first time a session asks for it: queries are about what
    they do with a log, not about making one."""
    place = (spark.sparkContext.applicationId, sf_dir, name)
    if place not in _STORED:
        _STORED[place] = materialize(made(spark, sf_dir, name), f"raw_{name}")
    return _STORED[place]


def log(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return changelog.change_log(raw(spark, sf_dir, name), name)


# Raw layer and parsing


def bronze_projection(spark, sf_dir):
    rows = bronze_ops.to_bronze(records(spark, sf_dir, "accounts"))
    return plain(
        rows.withColumn(
            "dated_by_arrival", F.col("ingestion_date") == F.to_date("processing_timestamp")
        ),
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
        "kafka_timestamp",
        "table_name",
        "dated_by_arrival",
    )


def topic_table_name(spark, sf_dir):
    """Topics of two, three and four parts, with and without the source's own table name."""
    events = cdc.table(spark, sf_dir, "events")
    topic = F.element_at(
        F.array(
            F.lit("a.accounts"),
            F.lit("dbserver1.banking_db.loans"),
            F.lit("p.banking_db.banking_db.cards"),
        ),
        (F.col("event_id") % 3 + 1).cast("int"),
    )
    source = F.when(F.col("event_id") % 2 == 0, "customers")
    return events.select("event_id", table_of(topic, source).alias("table_name"))


def parsed_envelope(spark, sf_dir):
    return parse_envelope(raw(spark, sf_dir, "accounts")).select(
        "kafka_offset",
        F.col("operation_type").alias("op"),
        F.col("operation_timestamp_ms").alias("ts_ms"),
        "source_db",
        "source_table",
        "source_ts_ms",
        "source_snapshot",
        F.size(F.map_keys("after_image")).alias("after_fields"),
        F.col("after_image")["status"].alias("after_status"),
    )


def typed_images(spark, sf_dir):
    schema = table_schema("accounts")
    parsed = changelog.parsed_events(raw(spark, sf_dir, "accounts"), "accounts")
    before = [f"before_{f}" for f in ACCOUNT_FIELDS]
    return plain(changelog.typed_images(parsed, schema), *CHANGE_FIELDS, *before)


def typed_dates(spark, sf_dir):
    loans = log(spark, sf_dir, "loans").select(
        F.lit("loans").alias("table_name"),
        F.col("loan_id").alias("offset"),
        F.col("start_date").alias("first_date"),
        F.col("end_date").alias("second_date"),
        F.lit(None).cast("timestamp").alias("instant"),
    )
    customers = log(spark, sf_dir, "customers").select(
        F.lit("customers").alias("table_name"),
        F.col("kafka_offset").alias("offset"),
        F.col("date_of_birth").alias("first_date"),
        F.lit(None).cast("date").alias("second_date"),
        F.col("registration_date").alias("instant"),
    )
    return plain(loans.unionByName(customers))


def typed_epochs(spark, sf_dir):
    """Epoch texts of one to sixteen digits, in milliseconds and in microseconds."""
    width = (F.col("event_id") % 16 + 1).cast("int")
    micros = F.unix_micros(F.col("ts").cast("timestamp")).cast("string")
    text = F.substring(micros, F.lit(1), width)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", text.alias("text"))
    stamp = T.TimestampType()
    return events.select(
        "event_id",
        F.unix_micros(cast_text(F.col("text"), stamp)).alias("from_millis"),
        F.unix_micros(cast_text(F.col("text"), stamp, epoch="micros")).alias("from_micros"),
        F.unix_date(cast_text(F.col("text"), T.DateType())).alias("days"),
    )


# Quality


def valid_operations(spark, sf_dir):
    parsed = changelog.parsed_events(raw(spark, sf_dir, "accounts"), "accounts")
    valid = quality.expect(parsed, quality.VALID_OPERATION, "drop")
    return valid.select("kafka_offset", "operation_type")


def faulty(spark, sf_dir):
    return bronze_ops.to_bronze(
        cdc.with_faults(records(spark, sf_dir, "accounts")), route_by="topic"
    )


def quarantined(spark, sf_dir):
    rejected = changelog.quarantine(faulty(spark, sf_dir), "accounts")
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("events"))


def accepted(spark, sf_dir):
    """The other side of the split: what the same faulty input lets through."""
    kept, _ = changelog.split_valid(faulty(spark, sf_dir), "accounts")
    return kept.select("account_id", "balance", "operation_type", "kafka_offset")


def foreign_events(spark, sf_dir):
    """One topic with the events of two tables: a table's log takes those that name it as their source."""
    both = records(spark, sf_dir, "accounts").unionByName(records(spark, sf_dir, "loans"))
    mixed = bronze_ops.to_bronze(both.withColumn("topic", F.lit("a.b.loans")), route_by="topic")
    kept, rejected = changelog.split_valid(mixed, "loans")
    counted = kept.agg(F.lit("kept").alias("outcome"), F.count(F.lit(1)).alias("events"))
    return counted.unionByName(
        rejected.groupBy(F.col("reason").alias("outcome")).agg(F.count(F.lit(1)).alias("events"))
    )


def cast_failures(spark, sf_dir):
    parsed = changelog.parsed_events(faulty(spark, sf_dir), "accounts")
    return quality.cast_failures(parsed, table_schema("accounts"))


def quality_report(spark, sf_dir):
    parsed = changelog.parsed_events(raw(spark, sf_dir, "accounts"), "accounts")
    rules = {
        **quality.VALID_OPERATION,
        "valid_account_id": "account_id IS NOT NULL",
        "large_balance": "balance >= 50",
    }
    typed = changelog.typed_images(parsed, table_schema("accounts"))
    return quality.quality_report(typed, rules, "accounts")


# Silver


def route_by_table(spark, sf_dir):
    both = records(spark, sf_dir, "accounts").unionByName(
        records(spark, sf_dir, "atm_transactions")
    )
    rows = bronze_ops.to_bronze(both)
    counts = [
        bronze_ops.route(rows, name).agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("events")
        )
        for name in ("accounts", "atm_transactions")
    ]
    return counts[0].unionByName(counts[1])


def change_log(spark, sf_dir):
    return plain(log(spark, sf_dir, "accounts"), *CHANGE_FIELDS)


def latest_per_key(spark, sf_dir):
    newest = latest.latest_per_key(log(spark, sf_dir, "accounts"), "account_id")
    return plain(newest, *CHANGE_FIELDS)


def latest_per_key_live(spark, sf_dir):
    newest = latest.latest_per_key(log(spark, sf_dir, "accounts"), "account_id", live=True)
    return plain(newest, *CHANGE_FIELDS)


def state_at(spark, sf_dir):
    then = latest.state_at(log(spark, sf_dir, "accounts"), "account_id", F.expr(STATE_MOMENT))
    return plain(then, *CHANGE_FIELDS)


def field_changes(spark, sf_dir):
    return changelog.field_changes(log(spark, sf_dir, "customers"), table_schema("customers"))


def raw_of_all_tables(spark, sf_dir, path):
    """The raw log of all thirteen tables, stored.

    Each table's part goes where it stays as it is made: one partition, dealt evenly, so nothing is
    shuffled, sorted or written a second time. What the session has stored already is copied."""
    for name in MAKERS:
        place = (spark.sparkContext.applicationId, sf_dir, name)
        rows = in_partitions(_STORED[place]) if place in _STORED else [made(spark, sf_dir, name)]
        for part in rows:
            append(part, path, bronze_ops.PARTITIONS, spread=False)
        _STORED.setdefault(place, bronze_ops.route(read_bronze(spark, path), name))
    return read_bronze(spark, path)


def in_partitions(rows):
    """The parts of a stored raw log by partition, with the partition's values as constants: a writer
    then need not sort them."""
    found = rows.select(*bronze_ops.PARTITIONS).distinct().collect()  # a table and a day each
    for part in found:
        same = [F.col(c).eqNullSafe(F.lit(part[c])) for c in bronze_ops.PARTITIONS]
        constant = {c: F.lit(part[c]).cast(rows.schema[c].dataType) for c in bronze_ops.PARTITIONS}
        yield rows.filter(same[0] & same[1]).withColumns(constant)


def silver(spark, sf_dir):
    """All thirteen silver tables from one stored raw log: changes, keys and live keys of each.

    Each log is read once; of a key's last event only its operation is wanted here.
    """
    bronze = raw_of_all_tables(spark, sf_dir, scratch_dir(spark, "bronze"))
    counts = None
    for name, table in silver_tables(bronze).items():
        key = key_of(table_schema(name))
        keys = table.log.groupBy(key).agg(
            F.count(F.lit(1)).alias("changes"),
            # a boolean, unlike a text, is aggregated by hash
            F.max_by(F.col("operation_type") == "d", event_order_key()).alias("deleted"),
        )
        line = keys.agg(
            F.lit(name).alias("table_name"),
            F.coalesce(F.sum("changes"), F.lit(0)).alias("changes"),
            F.count(F.lit(1)).alias("keys"),
            F.count_if(~F.col("deleted")).alias("live_keys"),
        )
        counts = line if counts is None else counts.unionByName(line)
    return counts


def column_totals(log: DataFrame, name: str) -> DataFrame:
    """Per column of a change log: how many values, and the sum of their remainders as whole numbers."""
    whole = {
        "string": lambda c: F.length(c),
        "date": F.unix_date,
        "timestamp": F.unix_micros,
        "double": lambda c: F.round(F.col(c) * 100),
    }
    fields = table_schema(name).fields
    found = log.agg(
        *[F.count(f.name).alias(f"{f.name}_filled") for f in fields],
        *[
            F.sum(
                F.pmod(whole.get(f.dataType.simpleString(), F.col)(f.name).cast("bigint"), F.lit(1_000_003))
            ).alias(f"{f.name}_total")
            for f in fields
        ],
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.col(f"{f.name}_filled").alias("filled"),
                F.coalesce(f"{f.name}_total", F.lit(0).cast("bigint")).alias("total"),
            )
            for f in fields
        ]
    )
    return found.select(F.lit(name).alias("table_name"), F.inline(lines))


def stream_silver(spark, sf_dir):
    """One stream for all thirteen change logs, in two waves; the typed columns of each, added up."""
    lake = LakeConfig.under(scratch_dir(spark, "stream_silver"))
    events = raw_of_all_tables(spark, sf_dir, f"{lake.bronze_path}_all")
    fan = SilverFanout(spark, lake)
    totals = None
    for wave in range(2):
        for part in in_partitions(events):
            arriving = part.filter(F.pmod("kafka_offset", F.lit(2)) == wave)
            append(arriving, lake.bronze_path, bronze_ops.PARTITIONS, spread=False)
        finish(fan.run(once=True))
    for name in MAKERS:
        line = column_totals(spark.read.parquet(fan.log_path(name)), name)
        totals = line if totals is None else totals.unionByName(line)
    return totals


def stream_quarantine(spark, sf_dir):
    """What the shared stream keeps out, unknown tables and misfit values included."""
    lake = LakeConfig.under(scratch_dir(spark, "stream_quarantine"))
    foreign = raw(spark, sf_dir, "services").withColumn("table_name", F.lit("closed_accounts"))
    append(faulty(spark, sf_dir).unionByName(foreign), lake.bronze_path, bronze_ops.PARTITIONS)
    fan = SilverFanout(spark, lake)
    finish(fan.run(once=True))
    return fan.quarantine().groupBy("table_name", "reason").agg(F.count(F.lit(1)).alias("events"))


# Gold


def history(spark, sf_dir):
    changes = scd.customer_dimension_changes(log(spark, sf_dir, "customers"))
    return scd.customer_history(materialize(changes, "customer_changes"))


def scd2_history(spark, sf_dir):
    return plain(history(spark, sf_dir), *HISTORY_FIELDS)


def scd2_history_hot(spark, sf_dir):
    """The same with every customer of more changes than most taken as heavy."""
    changes = scd.customer_dimension_changes(log(spark, sf_dir, "customers"))
    changes = materialize(changes, "customer_changes")
    usual = changes.groupBy("customer_id").count().agg(F.median("count")).first()[0]
    return plain(scd.customer_history(changes, rows_per_task=int(usual or 1)), *HISTORY_FIELDS)


def scd2_current(spark, sf_dir):
    return plain(scd.current(history(spark, sf_dir)), *HISTORY_FIELDS)


def scd2_as_of(spark, sf_dir):
    return plain(scd.as_of(history(spark, sf_dir), F.lit(HISTORY_MOMENT)), *HISTORY_FIELDS)


def scd1_branches(spark, sf_dir):
    return scd.branch_dimension(log(spark, sf_dir, "branches"))


def daily_account_balances(spark, sf_dir):
    return facts.daily_account_balances(log(spark, sf_dir, "accounts"))


def closing_balance_gaps(spark, sf_dir):
    """Closing balances of a log in which partitions and offsets are missing here and there."""
    number = F.col("kafka_offset")
    gaps = log(spark, sf_dir, "accounts").withColumns(
        {
            "kafka_partition": F.when(number % 5 > 0, F.col("kafka_partition")),
            "operation_timestamp_ms": F.expr("operation_timestamp_ms div 86400000 * 86400000"),
        }
    )
    return facts.daily_account_balances(gaps)


def exact_money(spark, sf_dir):
    """Sums of amounts with three and more decimals."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    amount = (F.col("l_partkey") * 8 + 1).cast("double") / F.lit(8000.0)
    return lines.groupBy("l_suppkey").agg(exact_sum(amount).alias("total"))


def daily_transactions_summary(spark, sf_dir):
    events = log(spark, sf_dir, "atm_transactions")
    return facts.daily_transactions(latest.latest_per_key(events, "transaction_id"))


def monthly_balances(spark, sf_dir):
    return facts.monthly_balances(daily_account_balances(spark, sf_dir))


def live_accounts(spark, sf_dir):
    return latest.latest_per_key(log(spark, sf_dir, "accounts"), "account_id", live=True)


def enrich_accounts(spark, sf_dir):
    changes = materialize(log(spark, sf_dir, "accounts"), "accounts_log")
    wide = joins.enrich_accounts(
        latest.latest_per_key(changes, "account_id", live=True),
        scd.current(history(spark, sf_dir)),
        facts.daily_account_balances(changes),
    )
    return wide.select(
        "account_id",
        "customer_id",
        "account_type",
        "currency",
        "status",
        "first_name",
        "city",
        "account_date",
        "end_of_day_balance",
        "daily_updates_count",
    )


def temporal_join(spark, sf_dir, max_versions=joins.MAX_VERSIONS):
    moved = log(spark, sf_dir, "atm_transactions").select(
        "transaction_id", "account_id", "amount", "operation_timestamp_ms", "kafka_offset"
    )
    return joins.temporal_join(
        moved,
        materialize(history(spark, sf_dir), "customer_history"),
        on={"account_id": "customer_id"},
        at="operation_timestamp_ms",
        columns=["city", "__START_AT", "__END_AT"],
        max_versions=max_versions,
    )


def temporal_join_walk(spark, sf_dir):
    """The same with most customers' histories taken as long."""
    return temporal_join(spark, sf_dir, max_versions=2)


def orphans(spark, sf_dir):
    return joins.orphans(
        live_accounts(spark, sf_dir),
        scd.current(history(spark, sf_dir)),
        {"customer_id": "customer_id"},
    ).select("account_id", "customer_id")


def non_orphans(spark, sf_dir):
    return joins.non_orphans(
        live_accounts(spark, sf_dir),
        scd.current(history(spark, sf_dir)),
        {"customer_id": "customer_id"},
    ).select("account_id", "customer_id")


def gold_view(view, table, build):
    """A reporting view over its published gold table."""

    def run(spark, sf_dir):
        create_schema(spark)
        publish(
            build(spark, sf_dir),
            f"gold.{table}",
            path=scratch_dir(spark, table),
            comment=f"Base of {view}",
            quality="gold",
        )
        create_gold_views(spark, views=[view])
        return plain(spark.table(f"gold.{view}"))

    return run


# Streams. Each drains what is there, then the stored result is read back.


def finish(query, seconds=1800):
    """Wait for a stream to drain its input, but not for ever."""
    if not query.awaitTermination(seconds):
        query.stop()
        raise TimeoutError(f"{query.name or query.id} took more than {seconds} s")


def record_stream(spark, sf_dir, name, make):
    """Change records made row by row from a stream over a test table's files."""
    path = f"{sf_dir}/{name}.parquet"
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path + "*")
    return make(stream)


def accounts_stream(spark, sf_dir):
    return record_stream(spark, sf_dir, "events", cdc.accounts)


def accounts_log_stream(spark, sf_dir):
    rows = bronze_ops.to_bronze(accounts_stream(spark, sf_dir), route_by="topic")
    return changelog.change_log(rows, "accounts")


def stream_bronze(spark, sf_dir):
    lake = LakeConfig.under(scratch_dir(spark, "stream_bronze"))
    finish(streams.run_bronze(accounts_stream(spark, sf_dir), lake, once=True))
    return read_bronze(spark, lake.bronze_path).select(
        "kafka_topic", "kafka_partition", "kafka_offset", "table_name"
    )


def record_files(spark, sf_dir, name):
    """Change records stored as files, for replay."""
    path = scratch_dir(spark, f"{name}_records")
    records(spark, sf_dir, "accounts").repartition(8).write.parquet(path)
    return path


def stream_replay(spark, sf_dir):
    """Records replayed from files into the raw log, two files to a micro-batch."""
    lake = LakeConfig.under(scratch_dir(spark, "stream_replay"))
    path = record_files(spark, sf_dir, "stream_replay")
    replayed = read_cdc_stream(spark, lake, fmt="files", path=path, max_files_per_trigger=2)
    finish(streams.run_bronze(replayed, lake, once=True))
    return read_bronze(spark, lake.bronze_path).select(
        "kafka_topic", "kafka_partition", "kafka_offset", "table_name"
    )


def batch_replay(spark, sf_dir):
    """The same records as a bounded frame."""
    lake = LakeConfig.under(scratch_dir(spark, "batch_replay"))
    path = record_files(spark, sf_dir, "batch_replay")
    rows = bronze_ops.to_bronze(read_cdc_batch(spark, lake, fmt="files", path=path))
    return rows.select("kafka_topic", "kafka_partition", "kafka_offset", "table_name")


def grown_log(spark, sf_dir):
    """A raw log that gains a column half-way, read with it."""
    path = scratch_dir(spark, "grown")
    rows = raw(spark, sf_dir, "accounts")
    append(rows.filter("kafka_offset % 2 = 0"), path, bronze_ops.PARTITIONS)
    region = F.concat(F.lit("r"), (F.col("kafka_offset") % 3).cast("string"))
    append(rows.filter("kafka_offset % 2 = 1").withColumn("region", region), path, bronze_ops.PARTITIONS)
    grown = read_bronze(spark, path, merge_schema=True)
    return grown.select("kafka_topic", "kafka_partition", "kafka_offset", "region")


def enforced_schema(spark, sf_dir):
    """Snapshots of an older form (a column short, one too many) brought to the declared columns."""
    old = spark.read.parquet(f"{sf_dir}/customer.parquet").selectExpr(
        "c_name AS first_name", "c_custkey AS customer_id", "c_acctbal AS score"
    )
    declared = T.StructType(
        [
            T.StructField("customer_id", old.schema["customer_id"].dataType),
            T.StructField("first_name", T.StringType()),
            T.StructField("email", T.StringType()),
        ]
    )
    return quality.enforce_schema(old, declared, evolve=True)


def stream_change_log(spark, sf_dir):
    """Two streams in a row: records to the raw log, the raw log to the typed change log."""
    lake = LakeConfig.under(scratch_dir(spark, "stream_change_log"))
    finish(streams.run_bronze(accounts_stream(spark, sf_dir), lake, once=True))
    changes = changelog.change_log(read_bronze_stream(spark, lake.bronze_path), "accounts")
    finish(streams.run_change_log(changes, "accounts", lake, once=True))
    return plain(spark.read.parquet(f"{lake.silver_path}/accounts_log"), *CHANGE_FIELDS)


def stream_latest(spark, sf_dir):
    lake = LakeConfig.under(scratch_dir(spark, "stream_latest"))
    table = keyed.latest_table(spark, f"{lake.silver_path}/accounts", "account_id", 4, "month")
    changes = accounts_log_stream(spark, sf_dir)
    finish(table.run(changes, "silver_accounts", lake, once=True))
    return plain(table.read(), *CHANGE_FIELDS)


def stream_latest_state(spark, sf_dir):
    """Newest events by a stateful operator; the last one passed on per key counts."""
    lake = LakeConfig.under(scratch_dir(spark, "stream_state"))
    newest = states.newest_events_stream(accounts_log_stream(spark, sf_dir), "account_id")
    writer = newest.writeStream.format("parquet").option("checkpointLocation", lake.checkpoint_path)
    path = f"{lake.silver_path}/accounts_newest"
    finish(streams.with_trigger(writer, lake.trigger_interval, once=True).start(path))
    return plain(latest.latest_per_key(spark.read.parquet(path), "account_id"), *CHANGE_FIELDS)


def stream_scd2(spark, sf_dir):
    """Customers arriving in two waves, out of order, into an incremental history.

    The stream is stopped between the waves and goes on from its checkpoint.
    """
    lake = LakeConfig.under(scratch_dir(spark, "stream_scd2"))
    replay = f"{lake.bronze_path}_replay"
    arriving = raw(spark, sf_dir, "customers")
    rows = read_bronze_stream(spark, replay + "*")
    changes = scd.customer_dimension_changes(changelog.change_log(rows, "customers"))
    changes = changes.withColumn("event_time", F.timestamp_millis("effective_timestamp"))
    table = keyed.history_table(
        spark,
        f"{lake.gold_path}/customer_history",
        **scd.CUSTOMER_HISTORY,
        except_cols=[*scd.CUSTOMER_HIDDEN, "event_time"],
        buckets=4,
        period="year",
    )
    for wave in (1, 0):  # together the whole table
        append(arriving.filter(F.col("kafka_offset") % 2 == wave), replay)
        finish(table.run(changes, "customer_history", lake, once=True))
    return plain(table.read(), *HISTORY_FIELDS)


def stream_daily_balances_append(spark, sf_dir):
    lake = LakeConfig.under(scratch_dir(spark, "stream_daily_append"))
    closed = streams.daily_balances_stream(accounts_log_stream(spark, sf_dir), lake.watermark)
    started = streams.run_closed_days(
        closed, "daily_account_balances", "account_date", lake, once=True
    )
    finish(started)
    stored = spark.read.parquet(f"{lake.gold_path}/daily_account_balances")
    return stored.select(
        "account_date",
        *facts.ACCOUNT_DIMENSIONS,
        "end_of_day_balance",
        "daily_updates_count",
    )


def stream_daily_balances_rebuilt(spark, sf_dir):
    """Closed days made whole from the stored change log, whatever came late."""
    lake = LakeConfig.under(scratch_dir(spark, "stream_daily_rebuilt"))
    finish(streams.run_change_log(accounts_log_stream(spark, sf_dir), "accounts", lake, once=True))
    stored = spark.read.parquet(f"{lake.silver_path}/accounts_log")
    path = streams.rebuild_closed_days(
        facts.daily_account_balances(stored), "daily_account_balances", "account_date", lake
    )
    return spark.read.parquet(path).drop("month")


def stream_daily_transactions_append(spark, sf_dir):
    """Closed days of all transaction events; corrections of a transaction count as events."""
    lake = LakeConfig.under(scratch_dir(spark, "stream_daily_transactions"))
    rows = record_stream(spark, sf_dir, "lineitem", cdc.transactions)
    changes = changelog.change_log(
        bronze_ops.to_bronze(rows, route_by="topic"), "atm_transactions"
    )
    closed = streams.transaction_events_stream(changes, lake.watermark)
    started = streams.run_closed_days(
        closed, "daily_transactions", "transaction_date", lake, once=True
    )
    finish(started)
    return spark.read.parquet(f"{lake.gold_path}/daily_transactions").select(
        "transaction_date",
        "account_id",
        "transaction_type",
        "total_transaction_amount",
        "number_of_transactions",
    )


def stream_by_name(spark, sf_dir):
    """A published table followed as a stream by its name, into a second one."""
    create_schema(spark, "silver")
    root = scratch_dir(spark, "by_name")
    publish(log(spark, sf_dir, "loans"), "silver.followed_loans", path=f"{root}/loans", quality="silver")
    followed = read_dataset(spark, "silver.followed_loans", streaming=True)
    dated = followed.select("loan_id", "account_id", "start_date", "status")
    writer = dated.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint")
    finish(streams.with_trigger(writer, "1 second", once=True).start(f"{root}/copy"))
    return spark.read.schema(dated.schema).parquet(f"{root}/copy")


def live_gold(spark, lake, table):
    """Gold tables over the stored change log of one table, after its stream has drained."""
    gold = live.LiveGold(spark, lake)
    finish(gold.run(once=True, tables=[table])[table])
    return gold


def stream_daily_balances_update(spark, sf_dir):
    """Records to the change log, the log to the live balances of all days, open ones included."""
    lake = LakeConfig.under(scratch_dir(spark, "stream_daily_update"), buckets=2, fact_period="month")
    finish(streams.run_change_log(accounts_log_stream(spark, sf_dir), "accounts", lake, once=True))
    return live_gold(spark, lake, "accounts").daily_account_balances


def stream_daily_balances_late(spark, sf_dir):
    """Partitions that are out of step: the events of some come days after those of the others.

    Three waves bring whole partitions, so that each later wave reaches back over all days.
    """
    lake = LakeConfig.under(scratch_dir(spark, "stream_daily_late"), buckets=2, fact_period="month")
    changes = materialize(log(spark, sf_dir, "accounts"), "accounts_log")
    for wave in range(3):
        arriving = changes.filter(F.col("kafka_partition") % 3 == 2 - wave)
        append(arriving, f"{lake.silver_path}/accounts_log")
        gold = live_gold(spark, lake, "accounts")
    return gold.daily_account_balances


def stream_daily_transactions(spark, sf_dir):
    """Transactions and their corrections in two waves, newer events of many in the first one."""
    lake = LakeConfig.under(scratch_dir(spark, "stream_transactions"), buckets=1, fact_period="month")
    events = raw(spark, sf_dir, "atm_transactions")
    for wave in (1, 0):  # each event is parsed once, straight into the log
        arriving = events.filter(F.pmod(F.col("kafka_offset"), F.lit(2)) == wave)
        arriving = changelog.change_log(arriving, "atm_transactions")
        append(arriving, f"{lake.silver_path}/atm_transactions_log", spread=False)
        gold = live_gold(spark, lake, "atm_transactions")
    return gold.daily_transactions


# Histories joined, snapshots, audits, profiles and lookups


def status_history(log, keys):
    """Versions of the status by the given key; deletes close them."""
    fields = [*dict.fromkeys(["account_id", "customer_id", *keys])]
    changes = log.select(*fields, "status", "operation_type", "operation_timestamp_ms", "kafka_partition", "kafka_offset")
    return scd.scd2_apply(
        changes,
        keys,
        "operation_timestamp_ms",
        ["status"],
        "operation_type = 'd'",
        ["operation_type", "operation_timestamp_ms", "kafka_partition"],
        ["kafka_partition", "kafka_offset"],
    )


def history_join(spark, sf_dir, max_versions=joins.MAX_VERSIONS, rows_per_task=joins.ROWS_PER_TASK):
    """Each account's status history against that of its customer, over all times both have one."""
    changes = materialize(log(spark, sf_dir, "accounts"), "accounts_log")
    accounts = materialize(status_history(changes, ["account_id"]).drop("kafka_offset"), "account_history")
    customers = status_history(changes.filter("operation_type <> 'd'"), ["customer_id"])
    customers = customers.withColumnRenamed("status", "customer_status")
    customers = materialize(customers.select("customer_id", "customer_status", scd.START, scd.END), "customer_history")
    return joins.history_join(
        accounts,
        customers,
        ["account_id"],
        {"customer_id": "customer_id"},
        ["customer_status"],
        rows_per_task,
        max_versions,
    )


def history_join_walk(spark, sf_dir):
    """The same with all histories taken as long."""
    return history_join(spark, sf_dir, max_versions=0)


SNAPSHOT_DAYS = (10, 15, 20)
MOMENTS = ("2024-01-09 12:00:00", "2024-01-15 00:00:00", "2024-01-15 06:30:00", "2024-01-28 00:00:00")


def state_at_snapshots(spark, sf_dir):
    """The accounts at moments before, at and after stored snapshots."""
    root = scratch_dir(spark, "snapshots")
    snapshots.store_by_day(log(spark, sf_dir, "accounts"), f"{root}/log")
    taken = snapshots.Snapshots(spark, f"{root}/snapshots", f"{root}/log", "account_id")
    for day in SNAPSHOT_DAYS:
        taken.take(datetime(2024, 1, day))
    states = None
    for moment in MOMENTS:
        state = taken.state_at(datetime.fromisoformat(moment)).withColumn("moment", F.lit(moment))
        states = state if states is None else states.unionByName(state)
    return plain(states, "moment", *CHANGE_FIELDS)


def audited_log(spark, sf_dir):
    """A raw log of two Kafka partitions, nine tenths in one, with offsets lost, repeated and, by their
    time, out of order."""
    number = F.col("event_id")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").filter(~(number % 37).isin(5, 6))
    copies = F.explode(F.sequence(F.lit(1), F.when(number % 41 == 0, 3).otherwise(1)))
    late = F.when(number % 53 == 0, F.expr("INTERVAL 2 DAYS")).otherwise(F.expr("INTERVAL 0 DAYS"))
    return events.select(
        F.lit("accounts").alias("kafka_topic"),
        (number % 10 == 0).cast("int").alias("kafka_partition"),
        number.alias("kafka_offset"),
        (F.col("ts").cast("timestamp") - late).alias("kafka_timestamp"),
        copies.alias("_copy"),
    ).drop("_copy")


def offset_gaps(spark, sf_dir):
    return offsets.offset_gaps(audited_log(spark, sf_dir), span=256)


def offset_audit(spark, sf_dir):
    return offsets.offset_audit(audited_log(spark, sf_dir), span=256)


PROFILED = ["account_id", "status", "balance", "last_activity_date"]


def quality_profile(spark, sf_dir):
    """Daily profiles of the accounts' changes merged to the month, held against exact figures.

    Whether the sketches' figures are within their errors: three standard errors of the number of
    different values, two hundredths of the rows in the median's rank.
    """
    changes = materialize(log(spark, sf_dir, "accounts").select("event_time", *PROFILED), "profiled")
    daily = materialize(profiles.daily_profile(changes, F.to_date("event_time"), PROFILED), "profile")
    month = profiles.read_profile(profiles.merged_profile(daily, F.trunc("day", "month")), [0.5])
    exact = None
    for name in PROFILED:
        number = F.unix_micros(name) / F.lit(1_000_000.0) if "date" in name else F.col(name)
        number = F.lit(None).cast("double") if name == "status" else number.cast("double")
        line = changes.agg(
            F.lit(name).alias("column_name"),
            F.countDistinct(F.col(name).cast("string")).alias("exact"),
            F.percentile(number, [0.48, 0.52]).alias("around"),
        )
        exact = line if exact is None else exact.unionByName(line)
    both = month.join(exact, "column_name")
    median = F.col("quantiles")[0]
    return both.select(
        F.col("day").alias("month"),
        "column_name",
        "rows",
        "filled",
        (F.abs(F.col("distinct_values") / F.col("exact") - 1) <= 3 * 0.0163).alias("distinct_within"),
        F.coalesce(median.between(F.col("around")[0], F.col("around")[1]), F.lit(True)).alias("median_within"),
    )


def key_lookup(spark, sf_dir):
    """Changes of some accounts within some days, from files clustered by account and time."""
    path = scratch_dir(spark, "clustered")
    changes = log(spark, sf_dir, "accounts")
    clustering.write_clustered(changes, path, ["account_id", "event_time"], files=16, bloom=["account_id"])
    wanted = F.col("account_id").isin(7, 77, 117) & F.col("event_time").between(
        F.lit("2024-01-05").cast("timestamp"), F.lit("2024-01-12").cast("timestamp")
    )
    return plain(spark.read.schema(changes.schema).parquet(path).filter(wanted), *CHANGE_FIELDS)


def compacted(spark, sf_dir):
    """A raw log of many small files, rewritten into few."""
    root = scratch_dir(spark, "compact")
    rows = raw(spark, sf_dir, "accounts").withColumn("event_day", F.to_date("kafka_timestamp"))
    rows.write.partitionBy("event_day").parquet(f"{root}/small")
    packed = compact_partitions(
        spark, f"{root}/small", f"{root}/packed", ["event_day"], rows.schema
    )
    return packed.select("kafka_topic", "kafka_partition", "kafka_offset", "event_day")


def compacted_text(spark, sf_dir):
    """The same with partition values that are text but look like numbers."""
    root = scratch_dir(spark, "compact_text")
    desk = F.lpad((F.col("event_id") % 12).cast("string"), 3, "0")
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", desk.alias("desk"))
    rows.write.partitionBy("desk").parquet(f"{root}/small")
    return compact_partitions(spark, f"{root}/small", f"{root}/packed", ["desk"], rows.schema)


QUERIES = {
    "bronze_projection": bronze_projection,
    "topic_table_name": topic_table_name,
    "parse_envelope": parsed_envelope,
    "typed_images": typed_images,
    "typed_dates": typed_dates,
    "typed_epochs": typed_epochs,
    "valid_operations": valid_operations,
    "quarantine": quarantined,
    "split_valid": accepted,
    "foreign_events": foreign_events,
    "cast_failures": cast_failures,
    "quality_report": quality_report,
    "route_by_table": route_by_table,
    "change_log": change_log,
    "latest_per_key": latest_per_key,
    "latest_per_key_live": latest_per_key_live,
    "state_at": state_at,
    "field_changes": field_changes,
    "silver_tables": silver,
    "stream_silver": stream_silver,
    "stream_quarantine": stream_quarantine,
    "scd2_history": scd2_history,
    "scd2_history_hot": scd2_history_hot,
    "scd2_current": scd2_current,
    "scd2_as_of": scd2_as_of,
    "scd1_branches": scd1_branches,
    "daily_account_balances": daily_account_balances,
    "closing_balance_gaps": closing_balance_gaps,
    "exact_money": exact_money,
    "daily_transactions_summary": daily_transactions_summary,
    "monthly_balances": monthly_balances,
    "enrich_accounts": enrich_accounts,
    "temporal_join": temporal_join,
    "temporal_join_walk": temporal_join_walk,
    "orphans": orphans,
    "non_orphans": non_orphans,
    "vw_gold_customer_current": gold_view(
        "vw_gold_customer_current",
        "gold_customer_dimension",
        lambda spark, sf_dir: scd.current(history(spark, sf_dir)),
    ),
    "vw_gold_daily_account_summary": gold_view(
        "vw_gold_daily_account_summary", "gold_daily_account_balances", daily_account_balances
    ),
    "vw_gold_daily_transaction_summary": gold_view(
        "vw_gold_daily_transaction_summary",
        "gold_daily_transactions_summary",
        daily_transactions_summary,
    ),
    "vw_gold_branch_current": gold_view(
        "vw_gold_branch_current", "gold_branch_dimension", scd1_branches
    ),
    "stream_bronze": stream_bronze,
    "stream_replay": stream_replay,
    "batch_replay": batch_replay,
    "grown_log": grown_log,
    "enforced_schema": enforced_schema,
    "stream_change_log": stream_change_log,
    "stream_by_name": stream_by_name,
    "stream_latest": stream_latest,
    "stream_latest_state": stream_latest_state,
    "stream_scd2": stream_scd2,
    "stream_daily_balances_append": stream_daily_balances_append,
    "stream_daily_balances_rebuilt": stream_daily_balances_rebuilt,
    "stream_daily_transactions_append": stream_daily_transactions_append,
    "stream_daily_balances_update": stream_daily_balances_update,
    "stream_daily_balances_late": stream_daily_balances_late,
    "stream_daily_transactions": stream_daily_transactions,
    "history_join": history_join,
    "history_join_walk": history_join_walk,
    "state_at_snapshots": state_at_snapshots,
    "offset_gaps": offset_gaps,
    "offset_audit": offset_audit,
    "quality_profile": quality_profile,
    "key_lookup": key_lookup,
    "compact_partitions": compacted,
    "compact_text_partitions": compacted_text,
}
