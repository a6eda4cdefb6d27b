"""Picks the columns an operator needs, so that others in the input never clash with its own."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """The named input columns under an operator's own names; everything else is left behind."""
    return df.select(*[df[source].alias(name) for name, source in columns.items()])


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def text_slices(texts: pa.Array, most: int = 1_000_000) -> Iterator[tuple[int, list[str]]]:
    """A batch's texts in slices of about ``most`` bytes (one text at least), each with the position
    of its first, so that a task works on little at a time however long the texts are."""
    sizes = pa.compute.binary_length(texts).to_pylist()
    start = total = 0
    for stop, size in enumerate(sizes):
        if total and total + (size or 0) > most:
            yield start, texts.slice(start, stop - start).to_pylist()
            start, total = stop, 0
        total += size or 0
    if start < len(sizes):
        yield start, texts.slice(start).to_pylist()
    # Python workers outlive their tasks: what earlier batches have freed goes back to the system
    pa.default_memory_pool().release_unused()


def batch_slices(
    batches: Iterator[pa.RecordBatch], name: str, most: int = 8_000_000
) -> Iterator[pa.RecordBatch]:
    """Batches cut into runs of rows with about ``most`` bytes in the named column (one row at least)."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(name)).to_pylist()
        start = total = 0
        for stop, size in enumerate(sizes):
            if total and total + (size or 0) > most:
                yield batch.slice(start, stop - start)
                start, total = stop, 0
            total += size or 0
        if start < len(sizes):
            yield batch.slice(start)
        pa.default_memory_pool().release_unused()


def summed(tables: Iterator[pa.Table], keys: list[str], count: str, rows: int) -> Iterator[pa.RecordBatch]:
    """The tables' counts added up by key over about ``rows`` rows at a time, so that fewer leave a task."""

    def added(held: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        whole = pa.concat_tables(held)
        done = whole.group_by(keys, use_threads=False).aggregate([(count, "sum")])
        done = done.rename_columns([*keys, count]).select(whole.column_names)
        yield from done.to_batches(max_chunksize=100_000)

    held, total = [], 0
    for table in tables:
        held.append(table)
        total += len(table)
        if total >= rows:
            yield from added(held)
            held, total = [], 0
    if held:
        yield from added(held)
    pa.default_memory_pool().release_unused()
