"""Schemas, envelope, casting, raw rows and the change log on hand-written events."""

from datetime import date, datetime

import pytest
from helpers import bronze, event, records, rows_of
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.envelope import parse_envelope, table_of
from tidemark.functions.images import cast_text
from tidemark.operators.bronze import drop_redelivered, route, to_bronze
from tidemark.operators.changelog import (
    change_log,
    field_changes,
    parsed_events,
    quarantine,
    split_valid,
)
from tidemark.operators.latest import latest_per_key
from tidemark.operators.quality import cast_failures
from tidemark.schemas import TABLES, envelope_schema, key_of, table_schema


def test_keys_of_all_tables(spark):
    keys = {t: key_of(table_schema(t)) for t in TABLES}
    assert len(keys) == 13
    assert keys["atm_transactions"] == "transaction_id"
    assert keys["transaction_types"] == "type_id"
    assert keys["audit_logs"] == "log_id"
    assert all(not table_schema(t)[k].nullable for t, k in keys.items())
    assert key_of(T.StructType().add("name", "string")) is None


def test_envelope_holds_string_maps(spark):
    assert isinstance(envelope_schema()["after"].dataType, T.MapType)


@pytest.mark.parametrize(
    "text, dtype, expected",
    [
        ("19000", T.DateType(), date(2022, 1, 8)),
        ("2022-01-08", T.DateType(), date(2022, 1, 8)),
        ("-1", T.DateType(), date(1969, 12, 31)),
        ("soon", T.DateType(), None),
        ("1700000000000", T.TimestampType(), datetime(2023, 11, 14, 22, 13, 20)),
        ("2023-11-14T22:13:20Z", T.TimestampType(), datetime(2023, 11, 14, 22, 13, 20)),
        ("9999999999999999999", T.TimestampType(), None),
        ("9223372036854775807", T.TimestampType(), None),
        ("1000", T.TimestampType(), datetime(1970, 1, 1, 0, 0, 1)),
        ("0", T.TimestampType(), datetime(1970, 1, 1)),
        ("-5000", T.TimestampType(), datetime(1969, 12, 31, 23, 59, 55)),
        ("86400000", T.TimestampType(), datetime(1970, 1, 2)),
        ("2024", T.DateType(), date(1975, 7, 18)),
        ("12345678901", T.DateType(), None),
        ("abc", T.DoubleType(), None),
        ("1.5", T.DoubleType(), 1.5),
        ("12", T.LongType(), 12),
        ("12", T.IntegerType(), 12),
        ("true", T.BooleanType(), True),
        ("x", T.StringType(), "x"),
        (None, T.LongType(), None),
    ],
)
def test_cast_text(spark, text, dtype, expected):
    df = spark.createDataFrame([(text,)], "v STRING")
    typed = df.select(cast_text(F.col("v"), dtype).alias("v"))
    if isinstance(dtype, T.TimestampType):
        typed = typed.select(F.col("v").cast("timestamp_ntz"))
    assert typed.first()[0] == expected


@pytest.mark.parametrize(
    "topic, source, expected",
    [
        ("a.b", None, "b"),
        ("x", None, "x"),
        ("dbserver1.banking_db.accounts", None, "accounts"),
        ("p.db.db.accounts", None, "accounts"),
        ("p.db.db.accounts", "cards", "cards"),
    ],
)
def test_table_of(spark, topic, source, expected):
    df = spark.createDataFrame([(topic, source)], "topic STRING, source STRING")
    assert df.select(table_of(F.col("topic"), F.col("source"))).first()[0] == expected


def test_bronze_routes_by_source_then_topic(spark):
    texts = [event("cards", "c", 1, after={"card_id": 1}), "{bad", None]
    by_source = rows_of(to_bronze(records(spark, texts)), "table_name")
    by_topic = rows_of(to_bronze(records(spark, texts), "topic"), "table_name")
    assert by_source == [("accounts",), ("accounts",), ("cards",)]
    assert by_topic == [("accounts",)] * 3
    assert route(to_bronze(records(spark, texts)), "cards").count() == 1


def test_redelivered_records_are_dropped(spark):
    once = bronze(spark, [event("accounts", "c", 1, after={"account_id": 1})])
    assert drop_redelivered(once.unionByName(once)).count() == 1


def test_malformed_and_empty_text_give_null_envelopes(spark):
    parsed = parse_envelope(bronze(spark, ["{bad", None, "{}"]))
    assert rows_of(parsed, "operation_type", "operation_timestamp_ms", "event_time") == [
        (None, None, None)
    ] * 3


def test_absurd_times_do_not_fail_the_job(spark):
    texts = [event("accounts", "c", 2**62, after={"account_id": 1})]
    rows = bronze(spark, texts)
    assert parse_envelope(rows).first()["event_time"] is None
    assert change_log(rows, "accounts").isEmpty()
    assert quarantine(rows, "accounts").first()["reason"] == "bad_time"


GOOD = {"account_id": 1, "customer_id": 2, "balance": 10.5}


def test_change_log_columns_and_missing_fields(spark):
    log = change_log(bronze(spark, [event("accounts", "c", 5, after=GOOD)]), "accounts")
    names = table_schema("accounts").fieldNames()
    assert log.columns == [
        *names,
        *[f"before_{n}" for n in names],
        "operation_type",
        "operation_timestamp_ms",
        "kafka_timestamp",
        "processing_timestamp",
        "ingestion_timestamp",
        "event_time",
        "kafka_partition",
        "kafka_offset",
    ]
    row = log.first()
    assert (row.account_id, row.customer_id, row.balance, row.currency) == (1, 2, 10.5, None)
    assert row.before_account_id is None


def test_customers_log_has_reference_width(spark):
    log = change_log(bronze(spark, [], "customers"), "customers")
    ours = ("event_time", "kafka_partition", "kafka_offset")
    assert len([c for c in log.columns if c not in ours]) == 33


def test_delete_takes_its_key_from_the_before_image(spark):
    log = change_log(bronze(spark, [event("accounts", "d", 5, before=GOOD)]), "accounts")
    row = log.first()
    assert (row.account_id, row.customer_id, row.before_customer_id) == (1, None, 2)


def test_bad_events_go_to_quarantine(spark):
    texts = [
        event("accounts", "c", 1, after=GOOD),
        "{bad",
        None,
        event("accounts", "x", 2, after=GOOD),
        event("accounts", None, 2, after=GOOD),
        event("accounts", "c", 3, after={"customer_id": 9}),
        event("accounts", "c", 4, after={**GOOD, "balance": "abc"}),
        event("accounts", "c", None, after=GOOD),
    ]
    kept, rejected = split_valid(bronze(spark, texts), "accounts")
    assert rows_of(kept, "kafka_offset", "balance") == [(0, 10.5), (6, None)]
    assert rows_of(rejected, "kafka_offset", "reason") == [
        (1, "malformed"),
        (3, "invalid_operation"),
        (4, "invalid_operation"),
        (5, "missing_key"),
        (6, "cast_failure"),
        (7, "bad_time"),
    ]


def test_rejections_are_counted_in_passing(spark):
    seen = Observation("seen")
    texts = [event("accounts", "c", 1, after=GOOD), "{bad", None, event("accounts", "x", 2, after=GOOD)]
    assert change_log(bronze(spark, texts), "accounts", observation=seen).count() == 1
    counts = {k: v for k, v in seen.get.items() if v}
    assert counts == {"events": 4, "tombstone": 1, "malformed": 1, "invalid_operation": 1}


def test_event_of_another_table_is_quarantined(spark):
    rows = to_bronze(records(spark, [event("cards", "c", 1, after=GOOD)]), "topic")
    assert change_log(rows, "accounts").isEmpty()
    assert quarantine(rows, "accounts").first()["reason"] == "wrong_table"


def test_invalid_newest_event_does_not_hide_the_older_one(spark):
    texts = [
        event("accounts", "c", 1, after=GOOD),
        event("accounts", "x", 2, after={**GOOD, "balance": 99}),
    ]
    newest = latest_per_key(change_log(bronze(spark, texts), "accounts"), "account_id")
    assert rows_of(newest, "account_id", "balance") == [(1, 10.5)]


def test_cast_failures_are_counted_by_field(spark):
    texts = [event("accounts", "u", 1, before={"balance": "x"}, after={"open_date": "later"})]
    counts = cast_failures(parsed_events(bronze(spark, texts), "accounts"), table_schema("accounts"))
    assert rows_of(counts.filter("failed > 0")) == [
        ("after", "open_date", 1),
        ("before", "balance", 1),
    ]
    assert counts.count() == 16


def test_field_changes_compares_typed_values(spark):
    schema = table_schema("customers")
    texts = [
        event(
            "customers",
            "u",
            1,
            before={"customer_id": 1, "city": "A", "date_of_birth": 19000},
            after={"customer_id": 1, "city": "B", "date_of_birth": "2022-01-08"},
        ),
        event("customers", "d", 2, before={"customer_id": 1, "city": "B"}),
    ]
    changes = field_changes(change_log(bronze(spark, texts, "customers"), "customers"), schema)
    assert rows_of(changes, "operation_type", "field", "old_value", "new_value") == [
        ("d", "city", "B", None),
        ("d", "customer_id", "1", None),
        ("u", "city", "A", "B"),
    ]


def test_money_as_decimal(spark):
    schema = table_schema("accounts", "DECIMAL(18,2)")
    log = change_log(bronze(spark, [event("accounts", "c", 5, after=GOOD)]), "accounts", schema)
    assert dict(log.dtypes)["balance"] == "decimal(18,2)"
    assert str(log.first()["balance"]) == "10.50"


def test_epochs_in_microseconds(spark):
    df = spark.createDataFrame([("1700000000000000",), ("5000",), ("2023-11-14T22:13:20Z",)], "v STRING")
    typed = df.select(F.unix_micros(cast_text(F.col("v"), T.TimestampType(), epoch="micros")))
    assert [r[0] for r in typed.collect()] == [1700000000000000, 5000, 1700000000000000]


def test_events_without_room_in_the_order_are_quarantined(spark):
    from tidemark.operators.changelog import change_log, quarantine

    good = bronze(spark, [event("accounts", "c", 5, after={"account_id": 1})], start=7)
    bad = good.withColumn("kafka_offset", F.lit(10**18)).unionByName(
        good.withColumn("kafka_partition", F.lit(10**6))
    )
    mixed = good.unionByName(bad).unionByName(good.withColumn("kafka_offset", F.lit(None).cast("bigint")))
    assert change_log(mixed, "accounts").count() == 2
    assert rows_of(quarantine(mixed, "accounts"), "reason") == [("bad_position",)] * 2
