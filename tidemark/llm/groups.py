"""Links within a group of fingerprints, found without listing all pairs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spanning_links(
    prints: np.ndarray,
    radius: int,
    confirm: Callable[[int, np.ndarray], np.ndarray] | None = None,
) -> list[tuple[int, int]]:
    """Positions linked so that the group's components are those of all its near pairs.

    Walks breadth-first: each position is compared once with those not reached yet, so a dense
    group costs about one comparison per member and yields one link per member reached.
    ``confirm(position, others)`` may refuse near pairs; it returns a boolean per other.
    ``prints`` are 64-bit fingerprints that differ in bits, or rows of bytes that differ in bytes.
    """
    links: list[tuple[int, int]] = []
    waiting = np.arange(len(prints))
    while waiting.size:
        frontier, waiting = [int(waiting[0])], waiting[1:]
        while frontier and waiting.size:
            at = frontier.pop()
            if prints.ndim == 2:
                near = (prints[waiting] != prints[at]).sum(axis=1) <= radius
            else:
                near = np.bitwise_count(prints[waiting] ^ prints[at]) <= radius
            if confirm is not None and near.any():
                near[near] = confirm(at, waiting[near])
            found = waiting[near]
            waiting = waiting[~near]
            links += [(at, int(other)) for other in found]
            frontier += found.tolist()
    return links


def link_members(groups: DataFrame, radius: int) -> DataFrame:
    """Spanning links ``(a, b)`` of every row's array ``members`` of 64-bit fingerprints."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            values = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            left, right, start = [], [], 0
            for end in ends:
                members, start = values[start:end], int(end)
                for a, b in spanning_links(members.view(np.uint64), radius):
                    left.append(members[a])
                    right.append(members[b])
            yield pa.RecordBatch.from_arrays(
                [pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"]
            )

    return groups.select("members").mapInArrow(walk, "a long, b long")


def in_parts(members: DataFrame, member: str) -> DataFrame:
    """Groups cut into parts, so that no task has to hold a large one.

    ``members`` has the number of ``parts`` of its group and a hashable ``member``. A group of up
    to two parts stays whole. A larger one is dealt into parts by hash and appears once for each
    pair of parts, so that any two members meet. Adds ``part``, by which (with the group) to group.
    """
    rows = members.withColumn("__parts", F.when(F.col("parts") > 2, F.col("parts")).otherwise(1).cast("int"))
    own = F.pmod(F.xxhash64(F.lit("part"), F.col(member)), F.col("__parts")).cast("int")
    rows = rows.withColumn("__own", own)
    rows = rows.withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)))
    # a part meets itself in its pairs with others
    rows = rows.where("__parts = 1 or __own <> __other")
    pair = F.struct(F.least("__own", "__other"), F.greatest("__own", "__other"))
    return rows.withColumn("part", pair).drop("__parts", "__own", "__other")
