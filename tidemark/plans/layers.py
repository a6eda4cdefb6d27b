"""Bronze to silver to gold as one set of lazy frames, and their publication as tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.config import LakeConfig
from tidemark.operators.changelog import change_log
from tidemark.operators.facts import daily_account_balances, daily_transactions
from tidemark.operators.latest import latest_per_key
from tidemark.operators.quality import enforce_schema
from tidemark.operators.scd import (
    branch_dimension,
    current,
    customer_dimension_changes,
    customer_history,
)
from tidemark.plans.views import create_gold_views, create_schema
from tidemark.schemas import TABLES, key_of, table_schema
from tidemark.sources.tables import publish

GOLD_COMMENTS = {
    "gold_customer_dimension_history": "Customer versions with validity intervals (type 2)",
    "gold_customer_dimension": "Open customer versions",
    "gold_daily_account_balances": "Closing balance and updates per account and day",
    "gold_daily_transactions_summary": "Amount and count per account, type and day",
    "gold_branch_dimension": "Existing branches, last state",
}


@dataclass(frozen=True)
class Silver:
    """A captured table: every valid event, and the last event per key (deletes included)."""

    log: DataFrame
    snapshot: DataFrame


def silver_table(log: DataFrame, table: str) -> Silver:
    key = key_of(table_schema(table))
    return Silver(log, latest_per_key(log, key) if key else log)


def silver_tables(bronze: DataFrame, tables: Sequence[str] = TABLES) -> dict[str, Silver]:
    """One change log and snapshot per captured table, each from its own bronze partitions."""
    return {table: silver_table(change_log(bronze, table), table) for table in tables}


def gold_tables(
    customers: DataFrame, accounts: DataFrame, transactions: DataFrame, branches: DataFrame
) -> dict[str, DataFrame]:
    """The five gold tables from change logs (for transactions: from the snapshot)."""
    history = customer_history(customer_dimension_changes(customers))
    return {
        "gold_customer_dimension_history": history,
        "gold_customer_dimension": current(history),
        "gold_daily_account_balances": daily_account_balances(accounts),
        "gold_daily_transactions_summary": daily_transactions(transactions),
        "gold_branch_dimension": branch_dimension(branches),
    }


def refresh(
    spark: SparkSession, bronze: DataFrame, config: LakeConfig, tables: Sequence[str] = TABLES
) -> None:
    """Rebuild silver and gold tables and the views from the raw log.

    Each layer reads the stored tables of the one before, so events are parsed once.
    """
    for schema in ("silver", "gold"):
        create_schema(spark, schema)
    stored: dict[str, Silver] = {}
    for table in tables:
        log = publish(
            enforce_schema(change_log(bronze, table), table_schema(table)),
            f"silver.silver_{table}_log",
            f"{config.silver_path}/{table}_log",
            f"Every valid change of {table}",
            "silver",
            fmt=config.table_format,
        )
        snapshot = publish(
            silver_table(log, table).snapshot,
            f"silver.silver_{table}",
            f"{config.silver_path}/{table}",
            f"Last change per key of {table}",
            "silver",
            fmt=config.table_format,
        )
        stored[table] = Silver(log, snapshot)
    gold = gold_tables(
        stored["customers"].log,
        stored["accounts"].log,
        stored["atm_transactions"].snapshot,
        stored["branches"].log,
    )
    history = "gold_customer_dimension_history"
    for name, frame in gold.items():
        if name == "gold_customer_dimension":
            frame = current(spark.table(f"gold.{history}"))
        publish(
            frame,
            f"gold.{name}",
            f"{config.gold_path}/{name.removeprefix('gold_')}",
            GOLD_COMMENTS[name],
            "gold",
            fmt=config.table_format,
        )
    create_gold_views(spark)
