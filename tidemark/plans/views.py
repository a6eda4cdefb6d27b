"""The four reporting views over the gold tables."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemark.operators.scd import CUSTOMER_TRACKED

# View name -> (gold table, columns, row condition).
GOLD_VIEWS = {
    "vw_gold_customer_current": (
        "gold_customer_dimension",
        (
            "customer_id",
            *CUSTOMER_TRACKED,
            "registration_date",
            "timestamp_millis(effective_timestamp) AS last_updated_at",
            "effective_timestamp AS last_updated_ms",
        ),
        "__END_AT IS NULL",
    ),
    "vw_gold_daily_account_summary": (
        "gold_daily_account_balances",
        (
            "account_date",
            "account_id",
            "customer_id",
            "account_type",
            "currency",
            "end_of_day_balance",
            "daily_updates_count",
        ),
        None,
    ),
    "vw_gold_daily_transaction_summary": (
        "gold_daily_transactions_summary",
        (
            "transaction_date",
            "account_id",
            "transaction_type",
            "total_transaction_amount",
            "number_of_transactions",
        ),
        None,
    ),
    "vw_gold_branch_current": (
        "gold_branch_dimension",
        (
            "branch_id",
            "branch_name",
            "address",
            "city",
            "state",
            "zip_code",
            "phone_number",
            "timestamp_millis(last_updated_ms) AS last_updated_at",
            "last_updated_ms",
        ),
        None,
    ),
}


def create_schema(spark: SparkSession, schema: str = "gold") -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")


def view_sql(view: str, schema: str = "gold") -> str:
    table, columns, condition = GOLD_VIEWS[view]
    where = f" WHERE {condition}" if condition else ""
    return (
        f"CREATE OR REPLACE VIEW {schema}.{view} AS "
        f"SELECT {', '.join(columns)} FROM {schema}.{table}{where}"
    )


def create_gold_views(spark: SparkSession, schema: str = "gold", views=tuple(GOLD_VIEWS)) -> None:
    """Create or replace the reporting views; their gold tables must be published already."""
    for view in views:
        spark.sql(view_sql(view, schema))
