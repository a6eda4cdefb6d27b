"""Mixing sources to target weights by capped water-filling. Spark expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.columns import pick, text_or_empty
from tidemark.sources.tables import materialize, scratch_dir

WORD = "[^\\x20\\x09-\\x0D]+"


def n_words(text_col: str) -> Column:
    """Number of runs without ASCII white space; none in a null text."""
    return F.regexp_count(text_or_empty(text_col), F.lit(WORD)).cast("long")


def repeating_weights(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """``(source, weight)`` with the weights dealt out in code point order, null last.

    ``sources`` has one row per source. They are sorted over many tasks, each of which numbers its
    own; only the number of rows per task is summed up in one place.
    """
    spark = sources.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_dir(spark, "ordered")
    order = [F.isnull("source"), F.col("source")]
    dealt = sources.select("source").repartitionByRange(tasks, *order)
    dealt.select("source", F.spark_partition_id().alias("task")).write.parquet(path)
    dealt = spark.read.parquet(path)
    counts = dealt.groupBy("task").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("task", F.coalesce(before, F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("task").orderBy(*order))
    place = F.col("before") + own - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    return dealt.join(counts, "task").select("source", weight.alias("weight"))


def water_level(sources: DataFrame, total: float, max_epochs: int) -> float:
    """Words per unit of weight at which the capped targets add up to ``total``.

    ``sources`` has ``source_size`` and ``weight``. A source whose share would exceed
    ``max_epochs`` times its size is clamped there and the others share the rest by weight; each
    round is one aggregation to a single row. The level only rises, so the clamped set only
    grows, and the rounds end when it stays the same.
    """
    cap = max_epochs * F.col("source_size")
    clamped, level = -1, 0.0
    while True:
        full = cap <= level * F.col("weight")
        row = sources.agg(
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0)).alias("used"),
            F.coalesce(F.sum(F.when(full, 0).otherwise(F.col("weight"))), F.lit(0)).alias("free"),
            F.count(F.when(full, 1)).alias("n"),
        ).first()
        if row["n"] == clamped or not row["free"]:
            return level
        clamped, level = row["n"], max(level, (total - row["used"]) / row["free"])


def mix(
    documents: DataFrame,
    weights: DataFrame | None = None,
    share: float = 1.0,
    max_epochs: int = 3,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The documents with how often the mix takes each.

    A source's target is its part of ``share`` times all words, by weight, but at most
    ``max_epochs`` times its own words; what is cut off goes to the other sources by weight.
    ``weights`` has one row ``(source, weight)`` per source (none: weight 0); without it the
    weights 1, 2, 3 are dealt out in order of the sources.

    Every document is repeated as often as the target holds the whole source. For the rest,
    documents are lined up by a hash of seed and id and taken one by one while the middle of the
    next one is not beyond the rest, so a source misses its target by half a document at most.
    Rows are told apart by id and text; of rows that share both, as many are taken as there is room
    for, whichever they are.

    Adds ``size``, ``source_size``, ``target`` and ``repetitions`` (zero: left out); input columns
    of these names are replaced. Null texts have size 0, null is a source like any other, null ids
    are told apart by their texts. An empty table gives an empty result.

    Only hashes, sources and sizes are shuffled. A source's documents are summed in 4,096 hash ranges
    first and only the range in which the rest ends is sorted, so a source with a third of all
    documents is spread over many tasks.
    """
    lot = _lot(seed, id_col, text_col)
    docs = documents.select(
        F.col(source_col).alias("source"), lot.alias("lot"), n_words(text_col).alias("size")
    )
    units = docs.groupBy("source", "lot").agg(
        F.sum("size").alias("size"), F.max("size").alias("each"), F.count(F.lit(1)).alias("n")
    )
    units = materialize(units, "units")
    sources = materialize(
        units.groupBy("source").agg(F.sum("size").alias("source_size")), "sizes"
    )
    if weights is None:
        weights = repeating_weights(sources)
    else:
        weights = pick(weights, source="source", weight="weight")
    same = F.col("s.source").eqNullSafe(F.col("w.source"))
    sources = sources.alias("s").join(weights.alias("w"), same, "left")
    weight = F.coalesce("w.weight", F.lit(0)).alias("weight")
    sources = materialize(sources.select("s.source", "source_size", weight), "weighted")
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level = water_level(sources, total * share, max_epochs)

    cap = (max_epochs * F.col("source_size")).cast("double")
    whole = F.floor(F.try_divide("target", "source_size"))
    sources = sources.withColumn("target", F.least(cap, F.lit(level) * F.col("weight")))
    sources = sources.withColumn("whole", F.coalesce(whole, F.lit(0)))
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    sources = sources.withColumn("rest", rest).drop("weight")
    last = _last_lots(units, sources)

    sources = sources.alias("s").join(last.alias("l"), F.col("s.source").eqNullSafe(F.col("l.source")), "left")
    sources = materialize(
        sources.select(
            F.col("s.source").alias("__source"), "source_size", "target", "whole", "last", "copies", "n"
        ),
        "targets",
    )
    added = ["source_size", "target", "repetitions", "size"]
    rows = documents.drop(*[c for c in added if c in documents.columns])
    rows = rows.withColumn("size", n_words(text_col))
    rows = rows.join(sources, rows[source_col].eqNullSafe(F.col("__source")))
    rows = rows.withColumnsRenamed({"last": "__last", "copies": "__copies", "n": "__n", "whole": "__whole"})
    split = (lot == F.col("__last")) & (F.col("__copies") < F.col("__n"))
    more = F.coalesce((lot < F.col("__last")) | ((lot == F.col("__last")) & ~split), F.lit(False)).cast("int")
    if not sources.where("copies < n and copies > 0").isEmpty():  # equal rows of which only some are taken
        split = F.coalesce(split, F.lit(False))
        numbered = _numbered(rows.where(split)).withColumn("__more", (F.col("__number") < F.col("__copies")).cast("int"))
        rows = rows.where(~split).withColumn("__more", more).unionByName(numbered.drop("__number"))
        more = F.col("__more")
    rows = rows.withColumn("repetitions", (F.col("__whole") + more).cast("int"))
    return rows.drop("__source", "__whole", "__last", "__copies", "__n", "__more")


def _lot(seed: int, id_col: str, text_col: str) -> Column:
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    text = F.md5(text_or_empty(text_col).cast("binary"))
    return F.md5(F.concat(F.lit(f"{seed}:"), name, F.lit(":"), text).cast("binary"))


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows numbered from 0 within their source, each task's own after those of the tasks before."""
    rows = materialize(rows.withColumn("__task", F.spark_partition_id()), "split")
    key = F.concat(F.isnull("__source").cast("string"), F.coalesce("__source", F.lit("")))
    counts = rows.groupBy(key.alias("__key"), "__task").agg(F.count(F.lit(1)).alias("__rows"))
    earlier = Window.partitionBy("__key").orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("__rows").over(earlier), F.lit(0))
    counts = counts.select("__key", F.col("__task").alias("__of"), before.alias("__before"))
    own = F.row_number().over(Window.partitionBy("__key", "__task").orderBy(F.lit(0)))
    rows = rows.withColumn("__key", key).withColumn("__own", own)
    counts = counts.withColumnRenamed("__key", "__group")
    rows = rows.join(counts, (F.col("__key") == F.col("__group")) & (F.col("__task") == F.col("__of")))
    return rows.withColumn("__number", F.col("__before") + F.col("__own") - 1).drop(
        "__key", "__task", "__rows", "__of", "__before", "__own", "__group"
    )


def _last_lots(units: DataFrame, sources: DataFrame) -> DataFrame:
    """Per source the last lot of which a row is taken once more, how many rows it has and how many of
    them are taken, ``(source, last, n, copies)``."""
    bucket = F.substring("lot", 1, 3).alias("bucket")
    sums = units.groupBy("source", bucket).agg(F.sum("size").alias("size"))
    so_far = Window.partitionBy("source").orderBy("bucket")
    before = F.coalesce(
        F.sum("size").over(so_far.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    sums = sums.withColumn("before", before).alias("b")
    sums = sums.join(
        sources.select("source", "rest").alias("s"), F.col("b.source").eqNullSafe(F.col("s.source"))
    )
    # the range with the largest sum before it that is still within the rest
    ends = sums.where("rest > 0 and before <= rest").groupBy("b.source", "rest").agg(
        F.max(F.struct("bucket", "before")).alias("end")
    )
    ends = materialize(ends.select("source", "rest", "end.bucket", "end.before"), "ends")
    inside = units.withColumn("bucket", bucket).alias("u").join(
        ends.alias("e"),
        F.col("u.source").eqNullSafe(F.col("e.source")) & (F.col("u.bucket") == F.col("e.bucket")),
    )
    line = Window.partitionBy("u.source").orderBy("lot")
    own = F.coalesce(F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    start = F.col("before") + own
    taken = inside.select("u.source", "lot", "rest", "each", "n", start.alias("start"))
    # the middle of a lot's first row is within the rest, and of as many more as there is room for
    room = F.floor(F.try_divide(F.col("rest") - F.col("start"), "each") + 0.5)
    copies = F.least(F.col("n"), F.coalesce(room, F.col("n"))).alias("copies")
    taken = taken.where("start + each / 2 <= rest").groupBy("source")
    taken = taken.agg(F.max(F.struct("lot", "n", copies)).alias("t")).select("source", "t.*")
    # before a range of which nothing is taken, all earlier ranges are
    last = ends.alias("e").join(taken.alias("t"), F.col("e.source").eqNullSafe(F.col("t.source")), "left")
    return last.select("e.source", F.coalesce("t.lot", "e.bucket").alias("last"), "n", "copies")


def repeated(mixed: DataFrame) -> DataFrame:
    """One row per repetition, numbered from 1; documents that are left out are gone."""
    rows = mixed.where("repetitions > 0")
    return rows.withColumn("repetition", F.explode(F.sequence(F.lit(1), "repetitions")))
