"""Change events made from the test tables, as the Kafka records a connector would send.

Every event is derived row by row from a table (the customers' before-image also looks at the
customer's previous order), so the volume grows with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.skew import fill_from_earlier, split_hot_keys

TOPIC_PREFIX = "dbserver1.banking_db."


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, spread over the cores: making and parsing JSON costs far more than moving rows.

    A table whose files give every core its share is read as it lies."""
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return rows if dealt_evenly(rows, cores) else rows.repartition(cores)


def dealt_evenly(rows: DataFrame, cores: int) -> bool:
    """Whether a scan has a task for every core and none with more than twice a core's share of the
    rows: a file's row groups are not cut, so there may be fewer of them than tasks."""
    if rows.rdd.getNumPartitions() < cores:
        return False
    tasks = rows.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"))
    most, total = tasks.agg(F.max("n"), F.sum("n")).first()
    return total is None or most * cores <= 2 * total


def to_records(
    rows: DataFrame,
    name: str,
    key: Column,
    op: Column,
    time: Column,
    offset: Column,
    before: Column,
    after: Column,
    partitions: int,
) -> DataFrame:
    """Kafka-shaped records of change events. ``time`` is a UTC timestamp."""
    ts_ms = F.unix_millis(time)
    source = F.struct(
        F.lit("banking_db").alias("db"),
        F.lit(name).alias("table"),
        ts_ms.alias("ts_ms"),
        F.lit("false").alias("snapshot"),
    )
    envelope = F.struct(
        before.alias("before"),
        after.alias("after"),
        source.alias("source"),
        op.alias("op"),
        ts_ms.alias("ts_ms"),
    )
    return rows.select(
        key.cast("string").cast("binary").alias("key"),
        F.to_json(envelope).cast("binary").alias("value"),
        F.lit(TOPIC_PREFIX + name).alias("topic"),
        F.pmod(key, F.lit(partitions)).cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
        time.alias("timestamp"),
    )


def accounts(events: DataFrame) -> DataFrame:
    """Fixture A: one account change per event, with operations of every kind and invalid ones."""
    time = F.col("ts").cast("timestamp")
    op = F.expr(
        "CASE WHEN event_id % 97 = 0 THEN 'x' WHEN event_type = 'error' THEN 'd' "
        "WHEN event_type = 'signup' THEN 'c' WHEN event_type = 'view' THEN 'r' ELSE 'u' END"
    )
    image = F.struct(
        F.col("user_id").alias("account_id"),
        (F.col("user_id") % 50).alias("customer_id"),
        F.when(F.col("user_id") % 2 == 0, "CHECKING").otherwise("SAVINGS").alias("account_type"),
        F.col("value").alias("balance"),
        F.lit("USD").alias("currency"),
        F.col("event_type").alias("status"),
        F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("last_activity_date"),
    )
    return to_records(
        events,
        "accounts",
        key=F.col("user_id"),
        op=op,
        time=time,
        offset=F.col("event_id"),
        before=F.when(op.isin("u", "d"), image),
        after=F.when(op != "d", image),
        partitions=6,
    )


def customers(orders: DataFrame, rows_per_task: int | None = 2_000_000) -> DataFrame:
    """Fixture B: a customer's attributes change with each order; final orders delete them."""
    rows = orders.withColumn("_time", F.col("o_orderdate").cast("timestamp"))
    image = F.struct(
        F.col("o_custkey").alias("customer_id"),
        F.concat(F.lit("F"), F.col("o_custkey")).alias("first_name"),
        F.col("o_orderpriority").alias("city"),
        (F.lit(3650) + F.col("o_custkey") % 10000).alias("date_of_birth"),
        F.unix_millis("_time").alias("registration_date"),
    )
    rows = rows.select("o_custkey", "o_orderkey", "o_orderstatus", "_time", image.alias("_image"))
    rows, part, _ = split_hot_keys(rows, ["o_custkey"], "_time", rows_per_task)
    rows = fill_from_earlier(
        rows,
        ["o_custkey"],
        part,
        ["_time", "o_orderkey"],
        "_image",
        "_previous",
        include_current=False,
    )
    deleted = F.col("o_orderstatus") == "F"
    key_only = F.struct(
        F.col("o_custkey").alias("customer_id"),
        *[
            F.lit(None).cast(image_type).alias(name)
            for name, image_type in (
                ("first_name", "string"),
                ("city", "string"),
                ("date_of_birth", "bigint"),
                ("registration_date", "bigint"),
            )
        ],
    )
    return to_records(
        rows,
        "customers",
        key=F.col("o_custkey"),
        op=F.when(deleted, "d").otherwise("u"),
        time=F.col("_time"),
        offset=F.col("o_orderkey"),
        before=F.when(deleted, F.coalesce("_previous", key_only)).otherwise(F.col("_previous")),
        after=F.when(~deleted, F.col("_image")),
        partitions=6,
    )


def transactions(lineitem: DataFrame) -> DataFrame:
    """Fixture C: transactions whose ids repeat, so that later events correct earlier ones."""
    image = F.struct(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"),
        F.col("l_suppkey").alias("account_id"),
        F.col("l_returnflag").alias("transaction_type"),
        F.col("l_extendedprice").alias("amount"),
    )
    return to_records(
        lineitem,
        "atm_transactions",
        key=F.col("l_orderkey") * 10 + F.col("l_linenumber"),
        op=F.when(F.col("l_returnflag") == "A", "c").otherwise("u"),
        time=F.col("l_shipdate").cast("timestamp"),
        offset=F.col("l_partkey") * 1000000 + F.col("l_suppkey"),
        before=F.lit(None).cast("struct<transaction_id:bigint>"),
        after=image,
        partitions=12,
    )


def branches(supplier: DataFrame) -> DataFrame:
    """Fixture D: every supplier is read once as a branch, and every tenth is then deleted."""
    events = supplier.withColumn(
        "_event",
        F.explode(
            F.when(
                F.col("s_suppkey") % 10 == 0,
                F.expr("array(named_struct('op', 'r', 'ms', 1000L, 'n', 0L), "
                       "named_struct('op', 'd', 'ms', 2000L, 'n', 1L))"),
            ).otherwise(F.expr("array(named_struct('op', 'r', 'ms', 1000L, 'n', 0L))"))
        ),
    )
    image = F.struct(
        F.col("s_suppkey").alias("branch_id"),
        F.col("s_name").alias("branch_name"),
        F.col("s_nationkey").cast("string").alias("city"),
    )
    op = F.col("_event.op")
    return to_records(
        events,
        "branches",
        key=F.col("s_suppkey"),
        op=op,
        time=F.timestamp_millis("_event.ms"),
        offset=F.col("s_suppkey") * 2 + F.col("_event.n"),
        before=F.when(op == "d", image),
        after=F.when(op != "d", image),
        partitions=2,
    )


def loans(orders: DataFrame) -> DataFrame:
    """Fixture E: one loan per order, its start in epoch days and its end in ISO text."""
    day = F.to_date("o_orderdate")
    image = F.struct(
        F.col("o_orderkey").alias("loan_id"),
        F.col("o_custkey").alias("account_id"),
        F.col("o_totalprice").alias("principal_amount"),
        F.unix_date(day).alias("start_date"),
        F.date_format(day, "yyyy-MM-dd").alias("end_date"),
        F.col("o_orderstatus").alias("status"),
    )
    return to_records(
        orders,
        "loans",
        key=F.col("o_orderkey"),
        op=F.lit("c"),
        time=F.col("o_orderdate").cast("timestamp"),
        offset=F.col("o_orderkey"),
        before=F.lit(None).cast("struct<loan_id:bigint>"),
        after=image,
        partitions=4,
    )


def _single(rows: DataFrame, name: str, image: Column, key: Column, time: Column, offset: Column) -> DataFrame:
    """One event per row: every seventh key is deleted, the others are created."""
    op = F.when(key % 7 == 3, "d").otherwise("c")
    return to_records(
        rows,
        name,
        key=key,
        op=op,
        time=time,
        offset=offset,
        before=F.when(op == "d", image),
        after=F.when(op != "d", image),
        partitions=3,
    )


def _image(**columns: Column | str) -> Column:
    return F.struct(*[F.expr(c).alias(n) if isinstance(c, str) else c.alias(n) for n, c in columns.items()])


def _seconds(key: str) -> Column:
    return F.timestamp_seconds(F.col(key))


def cards(customer: DataFrame) -> DataFrame:
    image = _image(
        card_id="c_custkey",
        account_id="c_custkey % 1000",
        card_type="c_mktsegment",
        card_number_hash="sha2(c_name, 256)",
        expiration_date="20000 + c_custkey % 1000",
        issue_date="date_format(date_add(date'2020-01-01', cast(c_custkey % 365 as int)), 'yyyy-MM-dd')",
        status="'active'",
    )
    key = F.col("c_custkey")
    return _single(customer, "cards", image, key, _seconds("c_custkey"), key)


def employees(supplier: DataFrame) -> DataFrame:
    image = _image(
        employee_id="s_suppkey",
        branch_id="s_suppkey % 10",
        first_name="s_name",
        position="'clerk'",
        hire_date="10000 + s_suppkey % 5000",
    )
    key = F.col("s_suppkey")
    return _single(supplier, "employees", image, key, _seconds("s_suppkey"), key)


def transaction_types(nation: DataFrame) -> DataFrame:
    image = _image(type_id="n_nationkey", type_name="n_name", description="concat('region ', n_regionkey)")
    key = F.col("n_nationkey")
    return _single(nation, "transaction_types", image, key, _seconds("n_nationkey"), key)


def audit_logs(events: DataFrame) -> DataFrame:
    """The time of an entry comes in epoch milliseconds."""
    time = F.col("ts").cast("timestamp")
    image = _image(
        log_id="event_id",
        user_id="user_id",
        action="event_type",
        timestamp=F.unix_millis(time),
        details="props",
    )
    return _single(events, "audit_logs", image, F.col("event_id"), time, F.col("event_id"))


def products(part: DataFrame) -> DataFrame:
    image = _image(
        product_id="p_partkey",
        product_name="p_name",
        product_type="p_type",
        description="p_brand",
        interest_rate="cast(p_size as double) / 4",
        min_balance="p_retailprice",
    )
    key = F.col("p_partkey")
    return _single(part, "products", image, key, _seconds("p_partkey"), key)


def services(region: DataFrame) -> DataFrame:
    image = _image(service_id="r_regionkey", service_name="r_name", status="'open'")
    key = F.col("r_regionkey")
    return _single(region, "services", image, key, _seconds("r_regionkey"), key)


def transaction_details(lineitem: DataFrame) -> DataFrame:
    """Details whose ids repeat, as those of the transactions do."""
    rows = lineitem.withColumn("_id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    image = _image(
        detail_id="_id",
        transaction_id="_id",
        item_description="l_linestatus",
        item_amount="l_extendedprice",
        category="l_returnflag",
    )
    offset = F.col("l_partkey") * 1000000 + F.col("l_suppkey")
    return _single(
        rows, "transaction_details", image, F.col("_id"), F.col("l_shipdate").cast("timestamp"), offset
    )


def merchants(customer: DataFrame) -> DataFrame:
    image = _image(
        merchant_id="c_custkey",
        merchant_name="c_name",
        category="c_mktsegment",
        city="concat('city ', c_nationkey)",
    )
    key = F.col("c_custkey")
    return _single(customer, "merchants", image, key, _seconds("c_custkey"), key)


def with_faults(records: DataFrame) -> DataFrame:
    """The records plus faulty copies: broken text, tombstones, misfit numbers, other tables' rows.

    Which event gets which copy follows from its offset.
    """
    text = F.col("value").cast("string")
    faults = F.filter(
        F.array(
            F.struct(F.lit("as_is").alias("fault"), F.col("value").alias("value")),
            F.when(
                F.col("offset") % 50 == 1,
                F.struct(F.lit("broken").alias("fault"), F.lit("{bad").cast("binary").alias("value")),
            ),
            F.when(
                F.col("offset") % 70 == 1,
                F.struct(
                    F.lit("tombstone").alias("fault"), F.lit(None).cast("binary").alias("value")
                ),
            ),
            F.when(
                F.col("offset") % 30 == 1,
                F.struct(
                    F.lit("misfit").alias("fault"),
                    F.lit(
                        '{"after":{"account_id":1,"balance":"abc"},'
                        '"source":{"table":"accounts"},"op":"c","ts_ms":1704067200000}'
                    ).cast("binary").alias("value"),
                ),
            ),
            F.when(
                F.col("offset") % 40 == 1,
                F.struct(
                    F.lit("keyless").alias("fault"),
                    F.regexp_replace(text, '"account_id":[0-9]+,?', "")
                    .cast("binary")
                    .alias("value"),
                ),
            ),
        ),
        lambda f: f.isNotNull(),
    )
    return records.select(
        "key", "topic", "partition", "offset", "timestamp", F.inline(faults)
    )
