"""SimHash near-duplicate groups by covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columns import pick, text_or_empty, text_slices
from tidemark.llm.components import connected_components
from tidemark.llm.groups import link_members
from tidemark.sources.tables import materialize

BITS = 64
#: Groups with more distinct fingerprints are divided by a second set of masks. Plan only.
GROUP = 2048


def fingerprints(texts: Sequence[str], shingle: int) -> np.ndarray:
    """64-bit SimHash of each text, as signed integers.

    Texts are lower-cased in A-Z and cut into words at ASCII white space. The features are the runs of
    ``shingle`` words, repeats included (a text of fewer words is one feature, one without words
    has fingerprint zero), each hashed by XXH64 with seed 42. A bit is set if it is set in more
    than half the hashes.
    """
    digest = xxhash.xxh64_digest
    out = np.zeros(len(texts), np.uint64)
    for row, text in enumerate(texts):
        words = text.encode("utf-8", "surrogatepass").lower().split()
        if not words:
            continue
        runs = zip(*[words[i:] for i in range(shingle)]) if len(words) >= shingle else [words]
        hashes = np.frombuffer(b"".join([digest(b" ".join(r), 42) for r in runs]), np.uint8)
        out[row] = majority(hashes.reshape(-1, 8))
    return out.view(np.int64)


def majority(hashes: np.ndarray) -> int:
    """The bits set in more than half of some big-endian hashes, given as rows of eight bytes."""
    counts = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 255):  # as many as a byte can count
        bits = np.unpackbits(hashes[start : start + 255], axis=1)
        counts += np.add.reduce(bits, axis=0, dtype=np.uint8)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def covering_masks(bits: list[int], radius: int) -> list[tuple[int, list[int]]]:
    """Masks such that any two words differing in at most ``radius`` of ``bits`` agree under one.

    Every bit gets a non-zero vector of ``radius + 1`` binary digits, and there is a mask for each
    such vector v: the bits whose vector has an odd product with v. For any ``radius`` bits some
    v has even products with all their vectors, so that mask leaves these bits out. About half
    the bits are in each mask. Returned with each mask are the bits it leaves out.
    """
    top = 2 ** (radius + 1)
    of = {bit: 1 + i % (top - 1) for i, bit in enumerate(bits)}
    masks = []
    for v in range(1, top):
        kept = [b for b in bits if (of[b] & v).bit_count() % 2]
        masks.append((_signed(sum(1 << b for b in kept)), [b for b in bits if b not in kept]))
    return masks


def _signed(word: int) -> int:
    return word - (1 << BITS) if word >> (BITS - 1) else word


def near_links(prints: DataFrame, radius: int, group: int = GROUP) -> DataFrame:
    """Links ``(a, b)`` whose components are those of all pairs within ``radius`` bits.

    ``prints`` has one row per distinct fingerprint ``fp``. Fingerprints are put into one table
    per mask. Groups of two are compared at once, larger ones are walked breadth-first in a task.
    A group of more than ``group`` is divided by masks of the bits its own mask leaves out; at
    most 16 bits are then free (at radius 3), so no divided group exceeds 65,536 words.
    """
    masks = covering_masks(list(range(BITS)), radius)
    key = [
        F.struct(F.lit(t).alias("t"), F.xxhash64(F.lit(t), F.col("fp").bitwiseAND(mask)).alias("key"))
        for t, (mask, _) in enumerate(masks)
    ]
    placed = prints.select("fp", F.inline(F.array(*key)))
    counted = placed.groupBy("key").agg(
        F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")
    )
    shared = materialize(counted.where("n > 1"), "shared")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    twos = shared.where("n = 2").where(near).select("a", "b")

    members = materialize(placed.join(shared.where("n > 2").select("key", "n"), "key"), "members")
    small = members.where(F.col("n") <= group).groupBy("key")
    small = small.agg(F.collect_list("fp").alias("members"))

    inner = [[m for m, _ in covering_masks(free, radius)] for _, free in masks]
    table = F.array(*[F.array(*[F.lit(m) for m in row]) for row in inner])
    large = members.where(F.col("n") > group).select(
        "fp", "key", F.posexplode(F.element_at(table, F.col("t") + 1)).alias("s", "mask")
    )
    large = large.groupBy(F.xxhash64("key", "s", F.col("fp").bitwiseAND(F.col("mask"))).alias("key"))
    large = large.agg(F.collect_set("fp").alias("members")).where(F.size("members") > 1)
    return twos.union(link_members(small, radius)).union(link_members(large, radius))


def simhash_groups(
    documents: DataFrame,
    shingle: int,
    max_distance: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    group: int = GROUP,
) -> DataFrame:
    """Every document's fingerprint and near-duplicate component.

    Returns one row per input row: ``doc_id``, ``fp`` (signed 64-bit), ``fingerprint`` (16 hex
    digits), ``component_id``, the smallest id that is reachable over links of at most
    ``max_distance`` differing bits, the document's own included, and ``root``, which is one value
    per component.

    A null text counts as empty; empty texts share fingerprint zero and are linked to each other
    like equal texts. Repeated rows are each returned. A null id is never a component's id unless
    no member has another. An empty table gives an empty result. Other columns are ignored.
    """
    docs = pick(documents, doc_id=id_col, text=text_col)
    return _grouped(docs, shingle, max_distance, group).drop("row_key")


def _row_key(id_col: str, text_col: str):
    """One value per different pair of id and text."""
    return F.xxhash64(F.isnull(id_col), F.col(id_col), F.isnull(text_col), F.col(text_col))


def _grouped(docs: DataFrame, shingle: int, max_distance: int, group: int = GROUP) -> DataFrame:
    def prints_of(texts: pa.Array) -> pa.Array:
        parts = [fingerprints(part, shingle) for _, part in text_slices(texts)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64))

    as_fp = F.arrow_udf(prints_of, "long")
    prints = docs.select(
        "doc_id",
        _row_key("doc_id", "text").alias("row_key"),
        as_fp(text_or_empty("text")).alias("fp"),
    )
    prints = materialize(prints, "prints")
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    links = near_links(distinct.select("fp"), max_distance, group)
    classes = materialize(connected_components(links), "classes")

    linked = distinct.join(classes.withColumnRenamed("node", "fp"), "fp", "left")
    root = F.coalesce("component", "fp")
    linked = materialize(linked.select("fp", "first", root.alias("root")), "linked")
    firsts = materialize(linked.groupBy("root").agg(F.min("first").alias("component_id")), "firsts")
    named = materialize(linked.join(firsts, "root").select("fp", "root", "component_id"), "named")
    return prints.join(named, "fp").select(
        "doc_id",
        "fp",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        "root",
        "row_key",
    )


def one_per_group(
    documents: DataFrame, shingle: int, max_distance: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents that remain when one of each near-duplicate group stays, with all columns.

    The row with the group's smallest id stays (rows with null ids come last); among rows of that
    id any one, the same at each run unless they have equal texts too. Rows are only brought together
    where one is repeated, and then each task sends one of them.
    """
    docs = pick(documents, doc_id=id_col, text=text_col)
    grouped = _grouped(docs, shingle, max_distance)
    rows = grouped.groupBy("root", "doc_id", "row_key").agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "row_key", "n")).alias("first")
    kept = rows.groupBy("root").agg(first)
    kept = kept.select(F.col("first.row_key").alias("__key"), (F.col("first.n") > 1).alias("__repeated"))
    keyed = documents.withColumn("__key", _row_key(id_col, text_col)).join(materialize(kept, "kept"), "__key")
    alone = keyed.where(~F.col("__repeated")).select(*documents.columns)
    repeated = keyed.where("__repeated").groupBy("__key")
    repeated = repeated.agg(F.any_value(F.struct(*documents.columns)).alias("__row")).select("__row.*")
    return alone.unionByName(repeated)
