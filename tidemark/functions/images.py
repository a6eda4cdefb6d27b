"""Typing of row images that arrive as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A bare whole number is an epoch, never a year.
WHOLE_NUMBER = r"^\s*[+-]?[0-9]+\s*$"
# Largest epoch of each unit that a timestamp can hold, in microseconds 64 bits.
MAX_EPOCH = {"millis": (2**63 - 1) // 1000, "micros": 2**63 - 1}


def cast_text(value: Column, dtype: T.DataType, epoch: str = "millis") -> Column:
    """Text to ``dtype``; NULL where it does not fit.

    Dates and timestamps may be ISO, or a whole number of any width: days since 1970 for a date,
    and ``epoch`` ("millis" or "micros") since 1970 for a timestamp.
    """
    if isinstance(dtype, T.StringType):
        return value
    if isinstance(dtype, T.DateType):
        days = F.date_from_unix_date(value.try_cast("int"))
        return F.when(value.rlike(WHOLE_NUMBER), days).otherwise(value.try_cast("date"))
    if isinstance(dtype, T.TimestampType):
        number = value.try_cast("bigint")
        fits = number.between(-MAX_EPOCH[epoch], MAX_EPOCH[epoch])
        to_instant = F.timestamp_millis if epoch == "millis" else F.timestamp_micros
        instant = to_instant(F.when(fits, number))
        return F.when(value.rlike(WHOLE_NUMBER), instant).otherwise(value.try_cast("timestamp"))
    return value.try_cast(dtype)


def cast_image(image: str, schema: T.StructType) -> dict[str, Column]:
    """Typed columns of an image column, which is a string map or a struct of strings."""
    return {f.name: cast_text(F.col(image)[f.name], f.dataType) for f in schema.fields}


def flatten_images(
    schema: T.StructType, before: str = "before_image", after: str = "after_image"
) -> list[Column]:
    """The after-image's columns, then the before-image's with the prefix ``before_``."""
    new = [c.alias(name) for name, c in cast_image(after, schema).items()]
    old = [c.alias(f"before_{name}") for name, c in cast_image(before, schema).items()]
    return new + old


def failed_casts(schema: T.StructType, image: str) -> dict[str, Column]:
    """Per field: the text is there, yet it does not fit the declared type."""
    return {
        name: F.col(image)[name].isNotNull() & typed.isNull()
        for name, typed in cast_image(image, schema).items()
    }
