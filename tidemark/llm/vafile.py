"""Exact top-k search by inner product over a vector-approximation file."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.tables import materialize

#: Vectors and queries that are compared at once in a task.
BLOCK, QUERIES = 16_384, 1024
LARGEST, SMALLEST = 2**63 - 1, -(2**63)


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component, null for a vector that is null or holds a component
    that is null or not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = F.transform(vector, lambda x: F.floor(scale * x.cast("double")))
    return F.when(finite, scaled)


def _dot(left: str, right: str) -> Column:
    """Inner product of whole numbers; beyond 64 bits it stays at the end of their range."""
    products = F.zip_with(left, right, lambda x, y: F.try_multiply(x, y))
    exact = F.aggregate(products, F.lit(0).cast("long"), lambda s, x: F.try_add(s, x))
    rough = F.aggregate(
        F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0),
        lambda s, x: s + x,
    )
    return F.coalesce(exact, F.when(rough > 0, F.lit(LARGEST)).otherwise(F.lit(SMALLEST)))


def distinct_vectors(vectors: DataFrame, k: int) -> DataFrame:
    """Each different vector once, with its ``k + 1`` smallest ids, ``(first, ids, cells)``.

    No result needs more of them: one may be the query's own. Spark cuts a very common vector's
    rows to that number before they are shuffled.
    """
    order = Window.partitionBy("cells").orderBy("vec_id")
    few = vectors.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    some = few.groupBy("cells").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    return some.select(F.element_at("ids", 1).alias("first"), "ids", "cells")


def approximations(distinct: DataFrame, bits: int, block: int) -> DataFrame:
    """The approximation file: each vector's cells on a grid of ``2 ** bits`` per component.

    All components of vectors of one length share a grid: ``width`` whole numbers per cell. Beside
    ``first``, ``dim``, ``width``, ``middle`` (the cell that is numbered 0) and ``approx`` (one byte
    a component, so 7 ``bits`` at most) there is the ``block``.
    """
    sized = distinct.select("first", "cells", F.size("cells").alias("dim"))
    low = F.min(F.array_min("cells")).cast("double")
    high = F.max(F.array_max("cells")).cast("double")
    width = F.greatest(F.lit(1), F.ceil((high - low + 1) / 2**bits)).cast("long").alias("width")
    grid = sized.groupBy("dim").agg(
        F.coalesce(width, F.lit(1)).alias("width"),
        F.min(F.array_min("cells")).alias("low"),
        F.ceil(F.count("*") / block).alias("blocks"),
    )
    gridded = sized.join(materialize(grid, "grid"), "dim")
    base = _floor_div(F.col("low"), F.col("width"))
    # numbered from the middle, to fit a byte
    middle = base + 2 ** (bits - 1)
    approx = F.transform("cells", lambda x: (_floor_div(x, F.col("width")) - middle).cast("tinyint"))
    number = F.pmod(F.xxhash64("first"), "blocks")
    return gridded.select(
        "first", "dim", "width", middle.alias("middle"), number.alias("block"), approx.alias("approx")
    )


def _floor_div(x: Column, by: Column) -> Column:
    return F.call_function("div", x - F.pmod(x, by), by)


def _survivors(pairs: DataFrame, k: int) -> DataFrame:
    """Per query and block the vectors that may be among the query's best ``k + 1``.

    Scans the cells for bounds of the inner product: a component lies between its cell's first
    number and ``width - 1`` more.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield bounds(batch.slice(row, 1))

    def bounds(row: pa.RecordBatch) -> pa.RecordBatch:
        dim, width, middle = (row.column(name)[0].as_py() for name in ("dim", "width", "middle"))
        queries, members = row.column("queries").flatten(), row.column("members").flatten()
        asked = _matrix(queries.field("cells"), len(queries), dim).astype(np.float64)
        cells = _matrix(members.field("approx"), len(members), dim)
        firsts = (cells.astype(np.float64) + (middle or 0)) * width
        least = asked @ firsts.T
        # a cell's last number is a better choice where the query is positive, else a worse one
        over = (width - 1) * np.maximum(asked, 0).sum(axis=1)
        under = (width - 1) * np.minimum(asked, 0).sum(axis=1)
        # sums beyond 2 ** 53 are rounded
        size = np.abs(asked).sum(axis=1) * (np.abs(firsts).max(initial=0) + width)
        slack = np.where(size < 2.0**52, 0.0, size * (dim + 2) * 2.0**-52)
        keep = min(k + 1, least.shape[1])
        sure = np.partition(least, least.shape[1] - keep, axis=1)[:, least.shape[1] - keep]
        # lower bound of the last that is sure to be in, against each upper bound
        at, which = np.nonzero(least + (over + slack)[:, None] >= (sure + under - slack)[:, None])
        value = least[at, which]
        return pa.RecordBatch.from_arrays(
            [
                queries.field("vec_id").take(pa.array(at)),
                members.field("first").take(pa.array(which)),
                pa.array(value + (under - slack)[at]),
                pa.array(value + (over + slack)[at]),
            ],
            ["query_id", "first", "lower", "upper"],
        )

    return pairs.mapInArrow(scan, "query_id long, first long, lower double, upper double")


def _matrix(lists: pa.Array, rows: int, dim: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(rows, dim)


def top_k(
    vectors: DataFrame,
    queries: Column,
    k: int = 20,
    scale: int = 64,
    bits: int = 7,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block: int = BLOCK,
    query_block: int = QUERIES,
) -> DataFrame:
    """Each query's ``k`` best other rows, ``(query_id, rank, vec_id, score)``.

    ``queries`` is the condition of rows that ask. Components are turned into floor(scale * x);
    the score is the inner product of these whole numbers, ties go to the smaller id, and there
    are fewer than ``k`` results only if there are fewer other rows.

    Vectors that are null or hold null or non-finite components take no part, nor do rows with a
    null id; vectors of different lengths are not compared. Rows that share an id are rows of
    their own, but none is a result for a query of its id. Scores beyond 64 bits stay at the end
    of their range. An empty table, or one without queries, gives an empty result.

    Equal vectors are searched once. Blocks of queries meet blocks of approximations, 1 byte per
    component. Per query, the exact vectors of the ``k + 1`` highest upper bounds are read first
    and then those whose upper bound reaches the lowest of their scores; no other can be a result.
    """
    asks = F.coalesce(queries, F.lit(False)).alias("asks")
    cells = quantised(F.col(vector_col), scale).alias("cells")
    rows = vectors.select(F.col(id_col).alias("vec_id"), cells, asks)
    rows = materialize(rows.where("vec_id is not null and cells is not null"), "quantised")
    distinct = materialize(distinct_vectors(rows, k), "distinct")
    file = materialize(approximations(distinct, bits, block), "approximations")

    asking = rows.where("asks").dropDuplicates(["vec_id", "cells"])
    asking = asking.select("vec_id", "cells", F.size("cells").alias("dim"))
    groups = asking.groupBy("dim").agg(F.ceil(F.count("*") / query_block).alias("groups"))
    groups = materialize(groups, "groups")
    dealt = asking.join(groups, "dim").withColumn("group", F.pmod(F.xxhash64("vec_id"), "groups"))
    asked = dealt.groupBy("dim", "group").agg(F.collect_list(F.struct("vec_id", "cells")).alias("queries"))
    asked = materialize(asked, "queries")

    blocks = file.groupBy("dim", "width", "middle", "block").agg(
        F.collect_list(F.struct("first", "approx")).alias("members")
    )
    blocks = blocks.join(groups, "dim")
    blocks = blocks.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)))
    pairs = blocks.join(asked, ["dim", "group"]).select("dim", "width", "middle", "members", "queries")
    found = materialize(_survivors(pairs, k), "survivors")

    # the lowest bound that k + 1 vectors reach for sure
    order = Window.partitionBy("query_id").orderBy(F.desc("lower"))
    sure = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    sure = sure.groupBy("query_id").agg(F.min("lower").alias("sure"), F.count("*").alias("n"))
    sure = materialize(sure, "sure")
    near = found.join(sure, "query_id").where((F.col("n") <= k) | (F.col("upper") >= F.col("sure")))
    by_bound = Window.partitionBy("query_id").orderBy(F.desc("upper"), "first")
    near = near.select("query_id", "first", "upper", F.row_number().over(by_bound).alias("turn"))
    near = materialize(near, "candidates")

    first_turn = F.col("turn") <= k + 1
    best = _scored(near.where(first_turn), distinct, asking)
    best = materialize(best, "first-read")
    reached = best.groupBy("query_id").agg(F.min("score").alias("reached"))
    rest = near.where(~first_turn).join(reached, "query_id")
    rest = rest.where(F.col("upper") >= F.col("reached")).drop("reached")
    scored = best.unionByName(_scored(rest, distinct, asking))

    other = scored.select("query_id", "score", F.explode("ids").alias("vec_id"))
    other = other.where("vec_id <> query_id")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    other = other.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    return other.select("query_id", "rank", "vec_id", "score")


def _scored(candidates: DataFrame, distinct: DataFrame, asking: DataFrame) -> DataFrame:
    """Exact scores of candidates, ``(query_id, score, ids)``."""
    read = candidates.join(distinct, "first")
    query = asking.select(F.col("vec_id").alias("query_id"), F.col("cells").alias("asked"))
    return read.join(query, "query_id").select("query_id", _dot("asked", "cells").alias("score"), "ids")
