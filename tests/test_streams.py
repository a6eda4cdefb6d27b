"""Streams against the batch operators: restarts, retries, late and unordered events."""

import os
import random
import re
import time
from datetime import datetime

import pytest
from helpers import RECORD, bronze, event, records, rows_of, same
from pyspark.sql import functions as F

from fixtures import cdc
from tidemark.config import LakeConfig, scratch_dir
from tidemark.operators import scd
from tidemark.operators.bronze import to_bronze
from tidemark.operators.changelog import change_log, quarantine
from tidemark.operators.facts import (
    ACCOUNT_DIMENSIONS,
    daily_account_balances,
    daily_transactions,
)
from tidemark.operators.latest import latest_per_key
from tidemark.sources import files
from tidemark.sources.cdc import KafkaUnavailable, read_cdc_batch, read_cdc_stream
from tidemark.sources.tables import read_bronze, read_bronze_stream, read_dataset
from tidemark.streaming import fanout, keyed, live, queries, states


@pytest.fixture
def lake(spark):
    return LakeConfig.under(scratch_dir(spark, "lake"))


def drop_off(frame, path, name):
    """Put a frame into a watched folder as one file, older files first."""
    frame.coalesce(1).write.mode("append").parquet(f"{path}/{name}")


def test_kafka_source_reports_a_missing_package(spark, lake):
    with pytest.raises(KafkaUnavailable):
        read_cdc_stream(spark, lake)
    with pytest.raises(KafkaUnavailable):
        read_cdc_batch(spark, lake)
    with pytest.raises(ValueError):
        read_cdc_stream(spark, lake, fmt="queue")


def test_bronze_survives_a_restart_without_duplicates(spark, lake, sf_dir):
    inbox = f"{lake.bronze_path}_inbox"
    made = cdc.accounts(cdc.table(spark, sf_dir, "events"))
    made.filter("offset % 2 = 0").repartition(3).write.parquet(inbox)

    def drain():
        stream = read_cdc_stream(spark, lake, "files", inbox, max_files_per_trigger=1)
        query = queries.run_bronze(stream, lake, once=True)
        query.awaitTermination(120)
        return query

    first = drain()
    assert len([p for p in first.recentProgress if p["numInputRows"]]) == 3
    drain()
    stored = read_bronze(spark, lake.bronze_path)
    assert stored.count() == made.filter("offset % 2 = 0").count()
    made.filter("offset % 2 = 1").write.mode("append").parquet(inbox)
    drain()
    stored = read_bronze(spark, lake.bronze_path)
    batch = to_bronze(read_cdc_batch(spark, lake, "files", inbox))
    steady = ["raw_cdc_json", "kafka_topic", "kafka_partition", "kafka_offset", "table_name"]
    assert same(stored.select(*steady), batch.select(*steady))
    assert os.path.isdir(f"{lake.bronze_path}/table_name=accounts")


def test_change_log_streams_like_batch(spark, lake, sf_dir):
    to_bronze(cdc.accounts(cdc.table(spark, sf_dir, "events"))).write.parquet(lake.bronze_path)
    stream = change_log(read_bronze_stream(spark, lake.bronze_path), "accounts")
    queries.run_change_log(stream, "accounts", lake, once=True).awaitTermination(120)
    stored = spark.read.parquet(f"{lake.silver_path}/accounts_log").drop("ingestion_timestamp")
    batch = change_log(read_bronze(spark, lake.bronze_path), "accounts")
    assert same(stored, batch.drop("ingestion_timestamp"))


CHANGES = (
    "k INT, seq BIGINT, off BIGINT, op STRING, city STRING, event_time TIMESTAMP"
)
DAY_MS = 86_400_000


def random_changes(spark, seed, n=300, days=120):
    rng = random.Random(seed)
    rows = []
    for off in range(n):
        seq = rng.randrange(days * DAY_MS)
        k = 0 if rng.random() < 0.3 else rng.randrange(15)
        op = rng.choice("cuuud")
        city = None if op == "d" else rng.choice("AB")
        rows.append((k, seq, off, op, city, datetime.utcfromtimestamp(seq / 1000)))
    rng.shuffle(rows)
    return [spark.createDataFrame(rows[i::4], CHANGES) for i in range(4)], rows


@pytest.mark.parametrize("rows_per_task, period", [(2_000_000, "month"), (5, "month"), (None, "hour")])
def test_incremental_history_equals_batch_with_every_batch_retried(
    spark, lake, rows_per_task, period
):
    options = dict(
        keys=["k"],
        sequence_by="seq",
        tracked=["city"],
        delete_when="op = 'd'",
        tie_break=["off"],
        except_cols=["op", "event_time"],
    )
    batches, rows = random_changes(spark, 3, days=120 if period == "month" else 1)
    table = keyed.history_table(
        spark,
        f"{lake.gold_path}/h",
        buckets=3,
        period=period,
        rows_per_task=rows_per_task,
        **options,
    )
    for batch_id, batch in enumerate(batches):
        table.apply(batch, batch_id)
        table.apply(batch, batch_id)
    table.apply(batches[0].limit(0), 9)
    whole = scd.scd2_apply(spark.createDataFrame(rows, CHANGES), **options)
    assert same(table.read(), whole)
    if period == "hour":
        assert spark.read.parquet(table.table_path).select("period").distinct().count() > 20
    assert spark.read.parquet(table.log_path).count() == len(rows)


def test_history_of_a_piece_whose_keys_are_all_deleted(spark, lake):
    table = keyed.history_table(
        spark, f"{lake.gold_path}/h", ["k"], "seq", ["city"], "op = 'd'", ["off"], buckets=1
    )
    at = datetime(1970, 1, 1)
    table.apply(spark.createDataFrame([(1, 10, 0, "c", "A", at)], CHANGES), 0)
    assert rows_of(table.read(), "__START_AT", "__END_AT") == [(10, None)]
    table.apply(spark.createDataFrame([(1, 5, 1, "d", None, at), (1, 10, 2, "d", None, at)], CHANGES), 1)
    assert table.read().isEmpty()


def test_many_touched_pieces_are_worked_out_part_by_part(spark, lake, monkeypatch):
    monkeypatch.setattr(keyed, "LISTED_PIECES", 1)
    batches, rows = random_changes(spark, 8, n=60)
    table = keyed.history_table(
        spark, f"{lake.gold_path}/h", ["k"], "seq", ["city"], "op = 'd'", ["off"], buckets=2
    )
    for batch_id, batch in enumerate(batches):
        table.apply(batch, batch_id)
    whole = scd.scd2_apply(
        spark.createDataFrame(rows, CHANGES), ["k"], "seq", ["city"], "op = 'd'", tie_break=["off"]
    )
    assert same(table.read(), whole)


def test_latest_table_under_retries_and_late_events(spark, lake):
    def log(texts, start):
        return change_log(to_bronze(records(spark, texts, start=start)), "accounts")

    def change(op, ts, balance):
        image = {"account_id": 1, "balance": balance}
        return event("accounts", op, ts, **({"before": image} if op == "d" else {"after": image}))

    table = keyed.latest_table(spark, f"{lake.silver_path}/accounts", "account_id", buckets=2)
    first = log([change("c", 5 * DAY_MS, 1.0), change("d", 9 * DAY_MS, 1.0)], 0)
    late = log([change("u", 7 * DAY_MS, 3.0), change("u", 9 * DAY_MS - 1, 4.0)], 10)
    for batch_id, batch in enumerate([first, late]):
        table.apply(batch, batch_id)
        table.apply(batch, batch_id)
    assert rows_of(table.read(), "account_id", "operation_type") == [(1, "d")]
    table.apply(log([change("c", 9 * DAY_MS + 1, 8.0)], 20), 2)
    assert rows_of(table.read(), "operation_type", "balance") == [("c", 8.0)]


def account_files(spark, path, batches):
    for i, texts in enumerate(batches):
        made = records(spark, texts, start=i * 100)
        drop_off(made, path, f"b{i}")
    return spark.readStream.schema(RECORD).option("maxFilesPerTrigger", 1).parquet(path + "/*")


def change_at(hours, balance, account=1):
    image = {"account_id": account, "customer_id": 1, "balance": balance}
    return event("accounts", "u", hours * 3_600_000, after=image)


def test_append_mode_drops_events_past_the_watermark_and_batch_has_them(spark, lake):
    batches = [
        [change_at(1, 1.0), change_at(20, 2.0)],
        [change_at(30, 3.0)],  # the watermark moves to 29:50
        [change_at(31, 6.0)],  # day one closes
        [change_at(2, 9.0), change_at(60, 4.0)],  # the first is too late
        [change_at(61, 5.0)],
    ]
    stream = account_files(spark, f"{lake.bronze_path}_inbox", batches)
    log = change_log(to_bronze(stream, "topic"), "accounts")
    facts = queries.daily_balances_stream(log, "10 minutes")
    late = queries.LateRows()
    spark.streams.addListener(late)
    query = queries.run_closed_days(facts, "daily", "account_date", lake, once=True)
    query.awaitTermination(120)
    assert queries.rows_dropped_late(query) == 1
    for _ in range(100):  # progress reaches listeners a little later
        if late.counts.get(query.id):
            break
        time.sleep(0.1)
    spark.streams.removeListener(late)
    assert late.counts[query.id] == 1
    closed = spark.read.parquet(f"{lake.gold_path}/daily")
    assert rows_of(closed, "end_of_day_balance", "daily_updates_count") == [(2.0, 2), (6.0, 2)]
    static = spark.read.schema(RECORD).parquet(f"{lake.bronze_path}_inbox/*")
    batch = daily_account_balances(change_log(to_bronze(static, "topic"), "accounts"))
    assert rows_of(batch, "end_of_day_balance", "daily_updates_count") == [
        (2.0, 3),
        (5.0, 2),
        (6.0, 2),
    ]
    days = batch.filter("account_date < date'1970-01-03'")
    whole = spark.read.parquet(queries.rebuild_closed_days(days, "daily", "account_date", lake))
    assert rows_of(whole, "end_of_day_balance", "daily_updates_count") == [(2.0, 3), (6.0, 2)]
    assert whole.filter("month <> '1970-01'").isEmpty()


def test_update_mode_keeps_open_days_current(spark, lake):
    batches = [[change_at(1, 1.0)], [change_at(2, 2.0), change_at(30, 3.0)], [change_at(31, 4.0)]]
    stream = account_files(spark, f"{lake.bronze_path}_inbox", batches)
    log = change_log(to_bronze(stream, "topic"), "accounts")
    table = keyed.facts_table(
        spark, f"{lake.gold_path}/live", "account_id", ACCOUNT_DIMENSIONS, "account_date", 2
    )
    facts = queries.daily_balances_stream(log, "10 minutes")
    table.run(facts, "live", lake, once=True).awaitTermination(120)
    assert rows_of(table.read(), "end_of_day_balance", "daily_updates_count") == [
        (2.0, 2),
        (4.0, 2),
    ]


def shuffles(frame):
    return frame._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_live_balances_take_late_events_and_retries(spark, lake):
    """Parts of batches merge whatever their order; a late event has only its own day redone."""
    batches = [
        [change_at(1, 1.0), change_at(20, 2.0), change_at(30, 3.0), change_at(5, None, 2)],
        [change_at(200, 6.0)],
        [change_at(2, 9.0), change_at(21, 4.0), change_at(4, 7.0, 2)],  # days late
    ]
    logs = [change_log(to_bronze(records(spark, b, start=i * 100)), "accounts") for i, b in enumerate(batches)]
    table = keyed.balances_table(spark, f"{lake.gold_path}/b", buckets=2, period="day")
    for batch_id, log in enumerate(logs[:2]):
        table.apply(log, batch_id)
        table.apply(log, batch_id)
    untouched = {p for p in table.read().inputFiles() if "1970-01-09" in p}
    table.apply(logs[2], 2)
    whole = daily_account_balances(logs[0].unionByName(logs[1]).unionByName(logs[2]))
    assert same(table.read(), whole)
    assert untouched and untouched <= set(table.read().inputFiles())
    assert shuffles(table.read()) == 0


def transaction(op, hour, amount, key=1, account=7, kind="A"):
    image = {"transaction_id": key, "account_id": account, "transaction_type": kind, "amount": amount}
    images = {"before": image} if op == "d" else {"after": image}
    return event("atm_transactions", op, hour * 3_600_000, **images)


def transaction_batches(seed, batches=4, n=150):
    rng = random.Random(seed)
    made = []
    for _ in range(batches):
        texts = []
        for _ in range(n):
            amount = rng.choice([None, 0.1, 2.25, -7.3, 1e15])
            account = rng.choice([None, 1, 2, 3])
            texts.append(
                transaction(rng.choice("cuuud"), rng.randrange(24 * 9), amount, rng.randrange(40), account, rng.choice("AB"))
            )
        made.append(texts)
    return made


@pytest.mark.parametrize("period", ["day", "month"])
def test_live_transactions_under_corrections_and_deletes(spark, lake, period):
    """Newest states move between days, accounts and types, come late, and go."""
    inbox = f"{lake.bronze_path}_inbox"
    table = keyed.transactions_table(spark, f"{lake.gold_path}/t", buckets=2, period=period)
    seen = []
    for wave, texts in enumerate(transaction_batches(4)):
        frame = records(spark, texts, "dbserver1.banking_db.atm_transactions", wave * 1000)
        drop_off(frame, inbox, f"w{wave}")
        stream = spark.readStream.schema(RECORD).parquet(inbox + "/*")
        log = change_log(to_bronze(stream, "topic"), "atm_transactions")
        table.run(keyed.transaction_places(log), "t", lake, once=True).awaitTermination(120)
        seen.append(frame)
        arrived = seen[0]
        for more in seen[1:]:
            arrived = arrived.unionByName(more)
        newest = latest_per_key(change_log(to_bronze(arrived), "atm_transactions"), "transaction_id")
        assert same(table.read(), daily_transactions(newest))
    assert shuffles(table.read()) == 0


def test_a_transaction_that_is_deleted_leaves_nothing(spark, lake):
    inbox = f"{lake.bronze_path}_inbox"
    table = keyed.transactions_table(spark, f"{lake.gold_path}/t", buckets=1)
    for wave, text in enumerate([transaction("c", 1, 5.0), transaction("u", 30, 6.0), transaction("d", 31, 6.0)]):
        drop_off(records(spark, [text], "a.b.atm_transactions", wave), inbox, f"w{wave}")
        stream = spark.readStream.schema(RECORD).parquet(inbox + "/*")
        log = change_log(to_bronze(stream, "topic"), "atm_transactions")
        table.run(keyed.transaction_places(log), "t", lake, once=True).awaitTermination(120)
        days = [r.transaction_date.day for r in table.read().collect()]
        assert days == [[1], [2], []][wave]


def test_keyed_streams_do_not_count_their_state(spark, lake):
    """Counting would look every key up again; other streams of the session keep their settings."""
    inbox, setting = f"{lake.bronze_path}_inbox", f"{queries.ROCKSDB}.trackTotalNumberOfRows"
    table = keyed.transactions_table(spark, f"{lake.gold_path}/t", buckets=1)
    drop_off(records(spark, [transaction("c", h, 5.0, h) for h in range(9)], "a.b.atm_transactions"), inbox, "w")
    log = change_log(to_bronze(spark.readStream.schema(RECORD).parquet(inbox + "/*"), "topic"), "atm_transactions")
    query = table.run(keyed.transaction_places(log), "t", lake, once=True)
    query.awaitTermination(120)
    state = query.recentProgress[0]["stateOperators"][0]
    assert state["numRowsUpdated"] == 9 and state["numRowsTotal"] == 0
    assert spark.conf.get(setting, "unset") == "unset"
    assert table.read().agg(F.sum("number_of_transactions")).first()[0] == 9


def log_folders(table):
    return files.find(table.spark, f"{table.log_path}/bucket=*/period=*/batch_id=*")


def keyed_tables(spark, lake):
    """A table of every kind with the batches it takes, and what it should hold after all of them."""
    accounts = [
        change_log(to_bronze(records(spark, texts, start=i * 100)), "accounts")
        for i, texts in enumerate(
            [[change_at(h, float(h), h % 3) for h in range(w, 90 + w * 40, 3)] for w in range(4)]
        )
    ]
    changes, rows = random_changes(spark, 6, days=90)
    options = dict(keys=["k"], sequence_by="seq", tracked=["city"], delete_when="op = 'd'", tie_break=["off"])
    whole = accounts[0].unionByName(accounts[1]).unionByName(accounts[2]).unionByName(accounts[3])
    history = scd.scd2_apply(spark.createDataFrame(rows, CHANGES), **options)
    return {
        "latest": (
            keyed.latest_table(spark, f"{lake.silver_path}/l", "account_id", 2),
            accounts,
            latest_per_key(whole, "account_id").drop("ingestion_timestamp", "processing_timestamp"),
        ),
        "balances": (
            keyed.balances_table(spark, f"{lake.gold_path}/b", 2, "day"),
            accounts,
            daily_account_balances(whole),
        ),
        "history": (
            keyed.history_table(spark, f"{lake.gold_path}/h", buckets=2, **options),
            changes,
            history,
        ),
    }


@pytest.mark.parametrize("kind", ["latest", "balances", "history"])
def test_merging_the_log_between_batches_changes_no_result(spark, lake, kind, monkeypatch):
    table, batches, expected = keyed_tables(spark, lake)[kind]
    table.apply(batches[0], 0)
    table.apply(batches[1], 1)
    table.apply(batches[2], 2)
    closed = max(re.search("period=([^/]*)", f)[1] for f in log_folders(table))
    table.apply(batches[2], 2)
    assert table.merge_log(closed) > 0 and table._archived()
    left = [re.search(r"period=([^/]*)/batch_id=(.)", f).groups() for f in log_folders(table)]
    merged = set(table._archived())
    assert left and not [f for f in left if f[0] in merged and f[1] < "2"]
    # a merge that dies before it has removed what it replaced, then one that dies while writing
    with monkeypatch.context() as broken:
        broken.setattr(keyed.KeyedTable, "_forget", lambda *a: None)
        table.merge_log("9999", least=1)
    half = f"{table.archive_path}/period={closed}/upto=999"
    spark.range(3).withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(half)
    files.remove(spark, [f"{half}/_SUCCESS"])
    table.apply(batches[3], 3)
    table.apply(batches[3], 3)
    assert same(table.read().select(*expected.columns), expected)
    table.merge_log("9999", least=1)
    assert {f.rsplit("=", 1)[1] for f in log_folders(table)} == {"3"}
    table.apply(batches[0].limit(1), 4)
    assert table.read().count() == expected.count() or kind == "balances"


def test_pieces_come_in_lots(spark, monkeypatch):
    monkeypatch.setattr(keyed, "LISTED_PIECES", 3)
    rows = [(b, f"p{p}") for b in range(3) for p in range(4 if b else 2)]
    lots = list(keyed._in_lots(spark.createDataFrame(rows, "bucket INT, period STRING")))
    assert [len(lot) for lot in lots] == [3, 3, 3, 1]
    assert [tuple(p) for lot in lots for p in lot] == sorted(rows)


def account_change(op, hours, account, balance=1.0):
    image = {"account_id": account, "balance": balance}
    images = {"before": image} if op == "d" else {"after": image}
    return event("accounts", op, hours * 3_600_000, **images)


def test_state_lets_go_of_deleted_keys(spark, lake):
    """After the retention the state of deleted keys is gone, that of the others stays."""
    batches = [
        [account_change("c", 1, k) for k in range(10)],
        [account_change("d", 2, k) for k in range(8)] + [account_change("u", 0, 9, 5.0)],  # older: nothing
        [account_change("u", 3, 0, 7.0)],  # back before its timer
        [account_change("u", 60, 9)],
        [account_change("u", 61, 9)],
        [account_change("u", 62, 9)],
    ]
    inbox, rows = f"{lake.bronze_path}_inbox", []
    for i, batch in enumerate(batches):
        drop_off(records(spark, batch, start=i * 100), inbox, f"b{i}")
        stream = spark.readStream.schema(RECORD).parquet(inbox + "/*")
        log = change_log(to_bronze(stream, "topic"), "accounts")
        newest = states.newest_events_stream(log, "account_id", retention_ms=3_600_000)
        writer = newest.writeStream.format("parquet").option("checkpointLocation", lake.checkpoint_path)
        query = queries.with_trigger(writer, "1 second", once=True).start(lake.silver_path)
        query.awaitTermination(120)
        rows.append(query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
    assert max(rows) >= 10 and rows[-1] <= max(rows) - 7
    found = latest_per_key(spark.read.parquet(lake.silver_path), "account_id")
    seen = {r.account_id: (r.operation_type, r.balance) for r in found.collect()}
    assert seen[0] == ("u", 7.0) and seen[1][0] == "d" and seen[9] == ("u", 1.0) and len(seen) == 10


def test_a_new_checkpoint_on_an_old_log_is_refused(spark, lake):
    stream = account_files(spark, f"{lake.bronze_path}_inbox", [[change_at(5, 1.0)]])
    log = change_log(to_bronze(stream, "topic"), "accounts")
    table = keyed.latest_table(spark, f"{lake.silver_path}/accounts", "account_id", buckets=2)
    table.run(log, "one", lake, once=True).awaitTermination(120)
    table.run(log, "one", lake, once=True).awaitTermination(120)
    assert table.read().count() == 1
    with pytest.raises(ValueError, match="does not know"):
        table.run(log, "two", lake, once=True)


def test_latest_table_runs_as_a_stream(spark, lake):
    batches = [[change_at(5, 1.0), change_at(3, 0.0, 2)], [change_at(4, 9.0), change_at(40, 7.0, 2)]]
    stream = account_files(spark, f"{lake.bronze_path}_inbox", batches)
    log = change_log(to_bronze(stream, "topic"), "accounts")
    table = keyed.latest_table(spark, f"{lake.silver_path}/accounts", "account_id", buckets=2)
    table.run(log, "accounts", lake, once=True).awaitTermination(120)
    assert rows_of(table.read(), "account_id", "balance") == [(1, 1.0), (2, 7.0)]
    static = spark.read.schema(RECORD).parquet(f"{lake.bronze_path}_inbox/*")
    batch = latest_per_key(change_log(to_bronze(static, "topic"), "accounts"), "account_id")
    assert same(table.read().select("account_id", "balance"), batch.select("account_id", "balance"))


def test_a_stream_per_table_reports_what_it_rejects(spark, lake, sf_dir):
    to_bronze(cdc.accounts(cdc.table(spark, sf_dir, "events"))).write.parquet(lake.bronze_path)
    query = live.run_silver_apart(spark, lake, ["accounts"], once=True)["accounts"]
    query.awaitTermination(120)
    seen = [p.observedMetrics["silver_accounts"] for p in query.recentProgress]
    assert sum(s["events"] for s in seen) == 1000
    assert sum(s["invalid_operation"] for s in seen) == 11


def silver_batch(spark, sf_dir):
    frames = [
        cdc.with_faults(cdc.accounts(cdc.table(spark, sf_dir, "events"))).drop("fault"),
        cdc.branches(cdc.table(spark, sf_dir, "supplier")),
        cdc.services(cdc.table(spark, sf_dir, "region")).withColumn("topic", F.lit("a.b.unheard_of")),
    ]
    return to_bronze(frames[0].unionByName(frames[1]).unionByName(frames[2]), "topic")


def test_the_shared_stream_parses_once_and_writes_each_log_like_batch(spark, lake, sf_dir):
    fan = fanout.SilverFanout(spark, lake)
    bronze = silver_batch(spark, sf_dir)
    fan.apply(bronze, 0)
    routed = fanout.route_events(bronze)._jdf.queryExecution().optimizedPlan().toString()
    assert routed.count("from_json") == 1
    for table in ("accounts", "branches"):
        stored = spark.read.parquet(fan.log_path(table)).drop("batch_id", *VOLATILE)
        assert same(stored, change_log(bronze, table).drop(*VOLATILE))
        kept = fan.quarantine().filter(F.col("table_name") == table)
        assert same(kept.select("reason", "kafka_offset"), quarantine(bronze, table).select("reason", "kafka_offset"))
    unknown = fan.quarantine().filter("reason = 'unknown_table'")
    assert rows_of(unknown, "table_name") == [("unheard_of",)] * 5
    assert not os.path.exists(fan.log_path("cards"))


VOLATILE = ("ingestion_timestamp", "processing_timestamp")


def test_a_retried_batch_of_the_shared_stream_adds_nothing(spark, lake, sf_dir):
    """Complete folders keep their files, which later streams may have read; broken ones are redone."""
    fan = fanout.SilverFanout(spark, lake)
    bronze = silver_batch(spark, sf_dir)
    fan.apply(bronze, 7)
    files = set(spark.read.parquet(fan.log_path("accounts")).inputFiles())
    counts = [spark.read.parquet(fan.log_path(t)).count() for t in ("accounts", "branches")]
    rejected = fan.quarantine().count()
    half = spark.read.parquet(fan.log_path("branches")).limit(2).drop("batch_id")
    half = spark.createDataFrame(half.collect(), half.schema)
    half.write.mode("overwrite").parquet(f"{fan.log_path('branches')}/batch_id=7")
    fan.apply(bronze, 7)
    assert set(spark.read.parquet(fan.log_path("accounts")).inputFiles()) == files
    assert [spark.read.parquet(fan.log_path(t)).count() for t in ("accounts", "branches")] == counts
    assert fan.quarantine().count() == rejected
    fan.apply(bronze.limit(0), 8)
    assert fan.quarantine().count() == rejected


def test_published_table_as_a_stream(spark, lake):
    spark.range(5).withColumn("x", F.lit("a")).write.mode("overwrite").option(
        "path", f"{lake.silver_path}/t"
    ).saveAsTable("stream_source")
    stream = read_dataset(spark, "stream_source", streaming=True)
    assert stream.isStreaming
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{lake.checkpoint_path}/t")
        .trigger(availableNow=True)
        .start(f"{lake.gold_path}/t")
    )
    query.awaitTermination(60)
    assert spark.read.parquet(f"{lake.gold_path}/t").count() == 5
    assert read_dataset(spark, "stream_source").count() == 5


def test_whole_lake_as_streams_equals_batch(spark, lake, sf_dir):
    lake = LakeConfig.under(scratch_dir(spark, "whole"), buckets=2)
    inbox = f"{lake.bronze_path}_inbox"
    made = {
        "accounts": cdc.accounts(cdc.table(spark, sf_dir, "events")),
        "customers": cdc.customers(cdc.table(spark, sf_dir, "orders").filter("o_custkey < 20")),
        "atm_transactions": cdc.transactions(
            cdc.table(spark, sf_dir, "lineitem").filter("l_shipdate < '1995-03-01'")
        ),
        "branches": cdc.branches(cdc.table(spark, sf_dir, "supplier")),
    }
    for name, frame in made.items():
        drop_off(frame, inbox, name)
    stream = read_cdc_stream(spark, lake, "files", inbox + "/*")
    queries.run_bronze(stream, lake, once=True).awaitTermination(300)
    silver = live.run_silver(spark, lake, once=True)
    silver.awaitTermination(300)
    assert sum(len(p["sources"]) for p in silver.recentProgress) == len(silver.recentProgress)
    rejected = fanout.SilverFanout(spark, lake).quarantine()
    assert rows_of(rejected, "table_name", "reason") == [("accounts", "invalid_operation")] * 11
    gold = live.LiveGold(spark, lake)
    for query in gold.run(once=True).values():
        query.awaitTermination(300)

    def log(name):
        return change_log(to_bronze(made[name]), name)

    whole = scd.customer_history(scd.customer_dimension_changes(log("customers")))
    steady = [c for c in whole.columns if c != "gold_ingestion_timestamp"]
    assert same(gold.customer_history.select(*steady), whole.select(*steady))
    assert same(gold.customers.select(*steady), scd.current(whole).select(*steady))
    assert same(gold.branches, scd.branch_dimension(log("branches")))
    transactions = latest_per_key(log("atm_transactions"), "transaction_id")
    assert same(gold.daily_transactions, daily_transactions(transactions))
    assert same(gold.daily_account_balances, daily_account_balances(log("accounts")))


def test_fanout_stages_a_batch_without_sorting_its_texts(spark, tmp_path):
    """A table partitioned by destination would have every text of the batch sorted by it."""
    events = [event("accounts", "c", 1000 + i, after={"account_id": i}) for i in range(5)]
    loans = [event("loans", "c", 2000 + i, after={"loan_id": i}) for i in range(3)]
    batch = bronze(spark, [*events, "{bad"]).unionByName(bronze(spark, loans, "loans"))
    fan = fanout.SilverFanout(spark, LakeConfig.under(str(tmp_path)))
    fan.apply(batch, 0)
    fan.apply(batch, 0)
    assert not list((tmp_path / "silver/staging").glob("destination=*"))
    assert spark.read.parquet(fan.log_path("accounts")).count() == 5
    assert spark.read.parquet(fan.log_path("loans")).count() == 3
    assert [r.reason for r in fan.quarantine().collect()] == ["malformed"]


def test_the_shared_stream_parses_events_as_their_table_does(spark, tmp_path):
    """Texts are staged as they came and read as the batch log reads them; a log without faults is not
    read again for the quarantine."""
    loans = [event("loans", "c", 2000 + i, after={"loan_id": i}) for i in range(3)]
    twice = '{"after":{"account_id":1,"account_id":2},"source":{"table":"accounts"},"op":"c","ts_ms":1704067200000}'
    misfit = event("accounts", "c", 3000, after={"account_id": 5, "balance": "abc"})
    batch = bronze(spark, [twice, misfit]).unionByName(bronze(spark, loans, "loans"))
    fan = fanout.SilverFanout(spark, LakeConfig.under(str(tmp_path)))
    read_again = []
    whole = fanout.quarantine
    with pytest.MonkeyPatch.context() as patched:
        patched.setattr(fanout, "quarantine", lambda rows, table: read_again.append(table) or whole(rows, table))
        fan.apply(batch, 0)
    assert read_again == ["accounts"]
    assert spark.read.parquet(str(tmp_path / "silver/staging")).columns == batch.columns
    stored = spark.read.parquet(fan.log_path("accounts"))
    assert rows_of(stored, "account_id") == [(2,), (5,)] == rows_of(change_log(batch, "accounts"), "account_id")
    assert rows_of(fan.quarantine(), "table_name", "reason") == [("accounts", "cast_failure")]
