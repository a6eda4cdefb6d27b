"""Expectations, quarantine, reports and schema checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.images import failed_casts

Rules = dict[str, str]

# The rules of the change logs and of the three gold tables with a key rule.
VALID_OPERATION: Rules = {"valid_operation": "operation_type IN ('c','u','d','r')"}
VALID_ACCOUNT: Rules = {"valid_account_id": "account_id IS NOT NULL"}
VALID_TRANSACTION: Rules = {"valid_transaction_id": "transaction_id IS NOT NULL"}
VALID_BRANCH: Rules = {"valid_branch_id": "branch_id IS NOT NULL"}


def holds(rule: str) -> Column:
    """True where the SQL rule is true; unknown (NULL) does not count as true."""
    return F.coalesce(F.expr(rule), F.lit(False))


def expect(
    df: DataFrame,
    rules: Rules,
    action: str = "drop",
    observation: Observation | str | None = None,
) -> DataFrame:
    """Apply SQL rules to each row: ``drop`` violators, ``warn`` (keep them) or ``fail`` the job.

    With an observation (a name on streams), row and violation counts are collected in passing.
    """
    if action not in ("drop", "warn", "fail"):
        raise ValueError(f"unknown action {action!r}")
    if observation is not None:
        failures = [F.count_if(~holds(rule)).alias(name) for name, rule in rules.items()]
        df = df.observe(observation, F.count(F.lit(1)).alias("rows"), *failures)
    if action == "warn":
        return df
    for name, rule in rules.items():
        ok = holds(rule)
        if action == "fail":
            ok = ok | F.raise_error(F.lit(f"expectation {name} failed: {rule}")).cast("boolean")
        df = df.filter(ok)
    return df


def quality_report(df: DataFrame, rules: Rules, table: str) -> DataFrame:
    """``table_name, rule, passed, failed, failed_rate``: one scan, one row per rule."""
    passed = [F.count_if(holds(rule)).alias(f"_p{i}") for i, rule in enumerate(rules.values())]
    totals = df.agg(F.count(F.lit(1)).alias("_rows"), *passed)
    lines = F.array(
        *[
            F.struct(F.lit(name).alias("rule"), F.col(f"_p{i}").alias("passed"))
            for i, name in enumerate(rules)
        ]
    )
    failed = F.col("_rows") - F.col("passed")
    return totals.select("_rows", F.inline(lines)).select(
        F.lit(table).alias("table_name"),
        "rule",
        "passed",
        failed.alias("failed"),
        F.try_divide(failed.cast("double"), F.col("_rows")).alias("failed_rate"),
    )


def cast_failures(parsed: DataFrame, schema: T.StructType) -> DataFrame:
    """``image, field, failed``: how many texts of each field do not fit its declared type."""
    checks = [
        (image, name, bad)
        for image in ("before", "after")
        for name, bad in failed_casts(schema, f"{image}_image").items()
    ]
    counted = parsed.agg(*[F.count_if(bad).alias(f"_f{i}") for i, (_, _, bad) in enumerate(checks)])
    lines = F.array(
        *[
            F.struct(
                F.lit(image).alias("image"),
                F.lit(name).alias("field"),
                F.col(f"_f{i}").alias("failed"),
            )
            for i, (image, name, _) in enumerate(checks)
        ]
    )
    return counted.select(F.inline(lines))


def any_cast_failed(schema: T.StructType) -> Column:
    """True where any text of either image does not fit its declared type."""
    bad = [
        check
        for image in ("before_image", "after_image")
        for check in failed_casts(schema, image).values()
    ]
    return F.coalesce(reduce(lambda a, b: a | b, bad), F.lit(False))


class SchemaMismatch(ValueError):
    """The frame does not carry the declared columns with the declared types."""


def enforce_schema(df: DataFrame, schema: T.StructType, evolve: bool = False) -> DataFrame:
    """Declared columns first and in order, checked by type; extra columns follow.

    A missing column is an error unless ``evolve`` is set, which adds it as NULL.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    wrong = [f.name for f in schema.fields if f.name in have and have[f.name] != f.dataType]
    missing = [f.name for f in schema.fields if f.name not in have]
    if wrong or (missing and not evolve):
        raise SchemaMismatch(f"wrong type: {wrong}, missing: {missing}")
    declared = [
        F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    extra = [name for name in df.columns if name not in schema.fieldNames()]
    return df.select(*declared, *extra)
