"""How far the sources of a language differ in their words, audited over the whole corpus.

Words are counted by Arrow's own kernels inside the tasks; the merged counts are dealt out as shards
of terms, each a dense matrix of terms by sources, whose exact sums of triangular discrimination
``(p - q)^2 / (p + q)`` add up to the divergence of every two sources.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.columns import batch_slices, pick, text_or_empty
from tidemark.sources.tables import materialize

#: What parts terms: everything of ASCII but letters.
SEPARATORS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Shares are whole numbers of this unit.
UNIT = 1_000_000_000
#: Cells of one shard's matrix of terms by sources, and sources whose sums one task gives out.
SHARD_CELLS, SOURCE_BLOCK = 50_000, 512


def count_terms(documents: DataFrame) -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences and documents of each term of each group.

    Each group also has a row with the empty term and zeros, so that groups without terms are known.
    Rows without any term, null ones included, add nothing else.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batch_slices(batches, "text"):
            langs = batch.column("lang").dictionary_encode()
            sources = batch.column("source").dictionary_encode()
            pairs = pa.table({"lang": langs.indices, "source": sources.indices})
            ids = langs.indices.to_numpy() * np.int64(len(sources.dictionary)) + sources.indices.to_numpy()
            words = pc.split_pattern_regex(pc.ascii_lower(batch.column("text")), SEPARATORS)
            flat, row = pc.list_flatten(words), pc.list_parent_indices(words)
            filled = pc.not_equal(flat, "")
            terms = flat.filter(filled).dictionary_encode()
            seen = pa.table({"row": row.filter(filled), "term": terms.indices})
            seen = seen.group_by(["row", "term"], use_threads=False).aggregate([([], "count_all")])
            seen = seen.append_column("group", pa.array(ids[seen["row"].to_numpy()], pa.int64()))
            counted = seen.group_by(["group", "term"], use_threads=False).aggregate(
                [("count_all", "sum"), ("count_all", "count")]
            )
            parts = np.divmod(counted["group"].to_numpy(), max(len(sources.dictionary), 1))
            yield from pa.table(
                {
                    "lang": langs.dictionary.take(pa.array(parts[0])),
                    "source": sources.dictionary.take(pa.array(parts[1])),
                    "term": terms.dictionary.take(counted["term"].combine_chunks()),
                    "n": counted["count_all_sum"],
                    "docs": counted["count_all_count"],
                },
                schema=counts_schema,
            ).to_batches()
            groups = pairs.group_by(["lang", "source"], use_threads=False).aggregate([])
            zeros = pa.array(np.zeros(len(groups), np.int64))
            yield from pa.table(
                {
                    "lang": langs.dictionary.take(groups["lang"].combine_chunks()),
                    "source": sources.dictionary.take(groups["source"].combine_chunks()),
                    "term": pa.array([""] * len(groups)),
                    "n": zeros,
                    "docs": zeros,
                },
                schema=counts_schema,
            ).to_batches()

    counts_schema = pa.schema(
        [("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())]
    )
    texts = documents.select(*[text_or_empty(c).alias(c) for c in ("text", "lang", "source")])
    counted = texts.mapInArrow(partial, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """Smoothed share of a count in whole units, one at least; decimals keep the product exact."""
    top = (count + 2).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")
    bottom = (total + 2 * terms).cast("decimal(20,0)")
    return 1 + F.call_function("div", top, bottom)


def discrimination(p: Column, q: Column) -> Column:
    """Triangular discrimination of two shares, rounded down. Squares stay below 2**63."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _sums(entries: pa.Table, sources: pa.Table) -> pa.Table:
    """Sums of the discrimination over one shard's terms, for the block's sources against all."""
    names = sources["source"].to_pylist()
    order = sorted(range(len(names)), key=lambda i: names[i].encode())
    place = {names[i]: at for at, i in enumerate(order)}
    terms = entries["term"].combine_chunks().dictionary_encode()
    cells = np.tile(sources["base"].to_numpy()[order], (len(terms.dictionary), 1))
    if len(entries):
        who = entries["source"].combine_chunks().dictionary_encode()
        column = np.array([place[x] for x in who.dictionary.to_pylist()])[who.indices.to_numpy()]
        cells[terms.indices.to_numpy(), column] = entries["p"].to_numpy()
    mine = sources["mine"].to_numpy(zero_copy_only=False)[order]
    left, right, total = [], [], []
    for at in np.flatnonzero(mine):
        rest = cells[:, at + 1 :]
        apart = rest - cells[:, at : at + 1]
        sums = (apart * apart // (rest + cells[:, at : at + 1])).sum(axis=0)
        left.append(np.full(len(sums), at))
        right.append(np.arange(at + 1, len(names)))
        total.append(sums)
    ordered = pa.array([names[i] for i in order], pa.string())
    joined = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right, total)]
    lang = sources["lang"][0].as_py()
    return pa.table(
        {
            "lang": pa.array([lang] * len(joined[0]), pa.string()),
            "source": ordered.take(pa.array(joined[0])),
            "item": ordered.take(pa.array(joined[1])),
            "value": pa.array(joined[2], pa.int64()),
        }
    )


def pair_divergence(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """``(lang, source, item, value)``: divergence of every source of a language from every other.

    ``kept`` has ``lang, source, term, p`` of the terms that occur, ``groups`` every group with its
    language's number of ``terms`` and the share ``base`` of a term that does not occur. The terms of
    a language are dealt into shards by its terms times sources, and beyond ``SOURCE_BLOCK`` sources a
    shard is worked out once for each block of them, so a task's matrix and result stay bounded.
    """
    sizes = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("width"), F.max("terms").alias("terms"))
    shards = 1 + F.call_function("div", F.col("width") * F.col("terms"), F.lit(SHARD_CELLS).cast("long"))
    blocks = 1 + F.call_function("div", F.col("width") - 1, F.lit(SOURCE_BLOCK).cast("long"))
    sizes = sizes.select("lang", shards.alias("shards"), blocks.alias("blocks"))

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))

    entries = kept.select("lang", "source", "term", "p").join(sizes, "lang")
    entries = entries.withColumn("shard", F.pmod(F.xxhash64("term"), F.col("shards")))
    entries = entries.withColumn("block", every("blocks"))
    base = groups.select("lang", "source", "base").join(sizes, "lang")
    base = base.withColumn("own", F.pmod(F.xxhash64("source"), F.col("blocks")))
    base = base.withColumn("shard", every("shards")).withColumn("block", every("blocks"))
    base = base.withColumn("mine", F.col("own") == F.col("block"))
    at = ["lang", "shard", "block"]
    partial = (
        entries.select(*at, "source", "term", "p").groupBy(*at)
        .cogroup(base.select(*at, "source", "base", "mine").groupBy(*at))
        .applyInArrow(_sums, "lang string, source string, item string, value long")
    )
    sums = partial.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    ends = F.array(
        F.struct(F.col("source").alias("a"), F.col("item").alias("b")),
        F.struct(F.col("item").alias("a"), F.col("source").alias("b")),
    )
    both = sums.select("lang", F.explode(ends).alias("end"), "value")
    return both.select("lang", F.col("end.a").alias("source"), F.col("end.b").alias("item"), "value")


def source_divergence(documents: DataFrame, min_docs: int = 10, top_terms: int = 10) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` for every (lang, source) group.

    Part ``pair`` ranks the other sources of the language by divergence, part ``term`` the terms the
    group uses more than its language does. A language keeps the terms in at least ``min_docs`` of
    its documents; a language that keeps none has pairs of value 0. Null text, lang and source are
    empty strings, repeated rows are documents of their own, an empty table gives no rows, and a
    single source has no pairs. Counts are 64 bits, products decimals. The result has a row for every
    two sources of a language, which is what is asked for; nothing else grows with that square.
    """
    counts = materialize(count_terms(pick(documents, text="text", lang="lang", source="source")), "term-counts")
    terms = counts.where("term <> ''").groupBy("lang", "term")
    terms = terms.agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"))
    terms = terms.where(F.col("docs") >= min_docs).drop("docs")
    kept = materialize(counts.drop("docs").join(terms, ["lang", "term"]), "kept-terms")

    words = kept.groupBy("lang", "source").agg(F.sum("n").alias("words"))
    langs = terms.groupBy("lang").agg(F.sum("total").alias("lang_words"), F.count(F.lit(1)).alias("terms"))
    groups = counts.where("term = ''").select("lang", "source").join(words, ["lang", "source"], "left")
    groups = groups.join(langs, "lang", "left").na.fill(0, ["words", "lang_words", "terms"])
    nothing = F.lit(0).cast("long")
    base = F.when(F.col("terms") > 0, share(nothing, F.col("words"), F.col("terms"))).otherwise(1)
    groups = materialize(groups.withColumn("base", base.cast("long")), "groups")

    kept = kept.join(groups.drop("base"), ["lang", "source"])
    kept = kept.select(
        "lang",
        "source",
        "term",
        share(F.col("n"), F.col("words"), F.col("terms")).alias("p"),
        share(F.col("total"), F.col("lang_words"), F.col("terms")).alias("q"),
    )
    above = kept.where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        discrimination(F.col("p"), F.col("q")).alias("value"),
    )
    pairs = pair_divergence(kept, groups)
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(ranked).alias("rank")
    above = above.select("*", rank).where(F.col("rank") <= top_terms)
    return above.unionByName(pairs.select("*", rank))
