"""Source table schemas, the change-event envelope and key inference."""

from __future__ import annotations

from functools import cache

from pyspark.sql import types as T

# The columns of the thirteen captured tables, in declared order.
TABLE_COLUMNS = {
    "customers": """
        customer_id BIGINT NOT NULL, first_name STRING, last_name STRING, email STRING,
        phone_number STRING, address_line1 STRING, address_line2 STRING, city STRING,
        state STRING, zip_code STRING, date_of_birth DATE, gender STRING,
        registration_date TIMESTAMP, last_update_timestamp TIMESTAMP""",
    "accounts": """
        account_id BIGINT NOT NULL, customer_id BIGINT NOT NULL, account_type STRING,
        balance DOUBLE, currency STRING, open_date TIMESTAMP, status STRING,
        last_activity_date TIMESTAMP""",
    "atm_transactions": """
        transaction_id BIGINT NOT NULL, account_id BIGINT NOT NULL, atm_id BIGINT,
        transaction_type STRING, amount DOUBLE, transaction_timestamp TIMESTAMP,
        location STRING, status STRING""",
    "loans": """
        loan_id BIGINT NOT NULL, account_id BIGINT NOT NULL, loan_type STRING,
        principal_amount DOUBLE, interest_rate DOUBLE, start_date DATE, end_date DATE,
        status STRING, outstanding_balance DOUBLE""",
    "cards": """
        card_id BIGINT NOT NULL, account_id BIGINT NOT NULL, card_type STRING,
        card_number_hash STRING, expiration_date DATE, issue_date DATE, status STRING""",
    "branches": """
        branch_id BIGINT NOT NULL, branch_name STRING, address STRING, city STRING,
        state STRING, zip_code STRING, phone_number STRING""",
    "employees": """
        employee_id BIGINT NOT NULL, branch_id BIGINT, first_name STRING, last_name STRING,
        position STRING, hire_date DATE, email STRING""",
    "transaction_types": "type_id BIGINT NOT NULL, type_name STRING, description STRING",
    "audit_logs": """
        log_id BIGINT NOT NULL, user_id BIGINT, action STRING, timestamp TIMESTAMP,
        details STRING""",
    "products": """
        product_id BIGINT NOT NULL, product_name STRING, product_type STRING,
        description STRING, interest_rate DOUBLE, min_balance DOUBLE""",
    "services": """
        service_id BIGINT NOT NULL, service_name STRING, description STRING, status STRING""",
    "transaction_details": """
        detail_id BIGINT NOT NULL, transaction_id BIGINT NOT NULL, item_description STRING,
        item_amount DOUBLE, category STRING""",
    "merchants": """
        merchant_id BIGINT NOT NULL, merchant_name STRING, category STRING, city STRING,
        state STRING""",
}

# Create, update, delete, snapshot read.
OPERATIONS = ("c", "u", "d", "r")

# Total order of change events; a key's events share one Kafka partition.
EVENT_ORDER = ("operation_timestamp_ms", "kafka_partition", "kafka_offset")

TABLES = tuple(TABLE_COLUMNS)


@cache
def table_schema(table: str, money: str = "DOUBLE") -> T.StructType:
    """Declared schema of a captured table (needs a running Spark session to parse the DDL).

    ``money="DECIMAL(18,2)"`` reads amounts and rates as decimals instead of binary floats.
    """
    return T.StructType.fromDDL(TABLE_COLUMNS[table].replace("DOUBLE", money))


def key_of(schema: T.StructType) -> str | None:
    """Primary key by convention: the first column whose name ends in ``_id``."""
    return next((name for name in schema.fieldNames() if name.endswith("_id")), None)


def text_image(schema: T.StructType) -> T.StructType:
    """The same columns as text, so that one JSON pass reads the row and casting happens after."""
    return T.StructType([T.StructField(name, T.StringType()) for name in schema.fieldNames()])


def envelope_schema(image: T.DataType | None = None) -> T.StructType:
    """Change-event envelope; row images are string maps unless a narrower type is given."""
    image = image or T.MapType(T.StringType(), T.StringType())
    source = T.StructType.fromDDL("db STRING, table STRING, ts_ms BIGINT, snapshot STRING")
    return T.StructType(
        [
            T.StructField("before", image),
            T.StructField("after", image),
            T.StructField("source", source),
            T.StructField("op", T.StringType()),
            T.StructField("ts_ms", T.LongType()),
        ]
    )
