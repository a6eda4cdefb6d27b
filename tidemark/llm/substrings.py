"""Removal of long byte strings that occur more than once, by longest-previous-factor arrays."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columns import pick, text_or_empty, text_slices
from tidemark.llm.lines import document_key
from tidemark.sources.tables import materialize

#: Bytes of the grams by which windows are dealt out, a power of two below the window.
GRAM = 64
#: Distinct contexts of one gram that a task puts in suffix order together, and bytes at once.
CONTEXTS, CHUNK = 4096, 2_000_000
#: Windows of a very long text that are looked at together.
SEGMENT = 1_000_000

_BYTE_HASH = np.random.default_rng(64).integers(0, 2**64, 256, np.uint64)


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A hash of the ``gram`` bytes from each position on (polynomial, by doubling, then mixed)."""
    h, size, factor = _BYTE_HASH[data], 1, 0x9E3779B97F4A7C15
    while size < gram:
        h = h[:-size] * np.uint64(factor) + h[size:]
        size, factor = 2 * size, factor * factor % 2**64
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def runs_of_windows(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, window: int) -> tuple:
    """Windows of each text, in runs that share the gram with the smallest hash.

    ``data`` holds texts from ``starts`` to ``ends``. Equal windows have equal grams at equal
    places, wherever they stand. Returns the first window's position, the number of windows and
    the gram's hash of every run.
    """
    if len(data) < window:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    hashes = gram_hashes(data)
    place = np.arange(len(hashes), dtype=np.uint64)
    least = (hashes & np.uint64(0xFFFFFFFF00000000)) | place  # the leftmost of equal ones
    size, grams = 1, window - GRAM + 1
    while 2 * size <= grams:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < grams:
        least = np.minimum(least[: size - grams], least[grams - size :])
    change = np.zeros(len(least) + 1, np.int8)
    whole = ends - starts >= window  # texts that hold a window
    change[starts[whole]] += 1
    np.add.at(change, ends[whole] - window + 1, -1)
    at = np.flatnonzero(np.cumsum(change[:-1]))
    where = (least[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(where) != 0) | (np.diff(at) != 1)
    firsts = np.flatnonzero(new)
    lengths = np.diff(np.append(firsts, len(at)))
    return at[firsts], lengths, hashes[where[firsts]]


def _buffers(texts: list[bytes], window: int) -> Iterator[tuple]:
    """Texts gathered into buffers, very long ones in overlapping segments: ``(bytes, rows,
    offsets in their texts, starts, ends)``."""
    parts, rows, offsets, size = [], [], [], 0
    for row, text in enumerate(texts):
        for offset in range(0, max(1, len(text) - window + 1), SEGMENT):
            part = text[offset : offset + SEGMENT + window - 1]
            if size + len(part) > SEGMENT and parts:
                yield _buffer(parts, rows, offsets)
                parts, rows, offsets, size = [], [], [], 0
            parts.append(part)
            rows.append(row)
            offsets.append(offset)
            size += len(part)
    if parts:
        yield _buffer(parts, rows, offsets)


def _buffer(parts, rows, offsets) -> tuple:
    ends = np.cumsum([len(p) for p in parts])
    starts = ends - [len(p) for p in parts]
    return b"".join(parts), np.array(rows), np.array(offsets), starts, ends


def _runs(docs: DataFrame, window: int) -> DataFrame:
    """Every run of windows: where it is, its gram, and a hash of its context, the bytes that its
    windows cover."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, part in text_slices(batch.column(2)):
                texts = [t.encode("utf-8", "surrogatepass") for t in part]
                yield from runs(batch.slice(start, len(part)), texts)

    def runs(batch: pa.RecordBatch, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        for data, rows, offsets, starts, ends in _buffers(texts, window):
            at, n, gram = runs_of_windows(np.frombuffer(data, np.uint8), starts, ends, window)
            part = np.searchsorted(starts, at, side="right") - 1
            stops = (at + n + window - 1).tolist()
            digest = xxhash.xxh3_64_intdigest
            context = [digest(data[a:b]) for a, b in zip(at.tolist(), stops)]
            row = pa.array(rows[part])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(row),
                    batch.column(1).take(row),
                    pa.array(at - starts[part] + offsets[part]),
                    pa.array(n.astype(np.int32)),
                    pa.array(gram.view(np.int64)),
                    pa.array(np.array(context, np.uint64).view(np.int64)),
                ],
                ["doc_id", "doc", "start", "n", "gram", "context"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, doc long, start long, n int, gram long, context long"
    keyed = docs.select("doc_id", document_key("doc_id", "text"), text_or_empty("text"))
    return keyed.mapInArrow(scan, schema)


def smaller_neighbours(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place of an array of different values the nearest place before it, and the nearest
    after it, with a smaller value; -1 if there is none.

    All places point to their neighbour first. A pointer to a larger value moves on to where that one
    points, as all in between is larger still, until none has to."""

    def before(values: np.ndarray) -> np.ndarray:
        to = np.arange(-1, len(values) - 1)
        open_ = np.arange(len(values))
        while open_.size:
            at = to[open_]
            open_ = open_[(at >= 0) & (values[at] > values[open_])]
            to[open_] = to[to[open_]]
        return to

    after = len(values) - 1 - before(values[::-1])[::-1]
    return before(values), np.where(after == len(values), -1, after)


def suffix_ranks(data: np.ndarray, window: int) -> list[tuple[int, np.ndarray]]:
    """Ranks of the positions by their first 8, 16, ... and ``window`` bytes, ``(size, ranks)``.

    ``data`` ends with 8 spare bytes."""
    eights = np.lib.stride_tricks.as_strided(data[:8].view(">u8"), (len(data) - 7,), (1,))
    rank = np.unique(eights.astype(np.uint64), return_inverse=True)[1]
    levels, size = [(8, rank.astype(np.int32))], 8
    while size < window:
        step = min(size, window - size)
        pairs = rank[:-step].astype(np.int64) * (len(rank) + 1) + rank[step:]
        rank = np.unique(pairs, return_inverse=True)[1]
        size += step
        levels.append((size, rank.astype(np.int32)))
    return levels


def _in_order(ranks: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows in suffix order, and for each in that order the places of its previous and next
    smaller position."""
    order = np.lexsort((windows, ranks[windows]))
    return order, *smaller_neighbours(windows[order])


def longest_previous_factors(data: np.ndarray, windows: np.ndarray, window: int) -> np.ndarray:
    """Length of the longest string that starts at each of the positions and at an earlier one of
    them, cut off at ``window``.

    In suffix order the earlier position with the longest common prefix is the previous or the next
    smaller position. Common prefixes are measured by the ranks of 8, 16, ... bytes, longest first,
    and the rest byte by byte.
    """
    levels = suffix_ranks(data, window)
    order, *sides = _in_order(levels[-1][1], windows)
    at, factors = windows[order], np.zeros(len(windows), np.int64)
    for side in sides:
        some = np.flatnonzero(side >= 0)
        here, there = at[some], at[side[some]]
        length = np.zeros(len(some), np.int64)
        for size, ranks in reversed(levels):
            fits = np.flatnonzero(length + size <= window)
            same = ranks[here[fits] + length[fits]] == ranks[there[fits] + length[fits]]
            length[fits[same]] += size
        going = np.flatnonzero(length < window)
        while going.size:  # fewer than 8 bytes, or what is left below the window
            going = going[data[here[going] + length[going]] == data[there[going] + length[going]]]
            length[going] += 1
            going = going[length[going] < window]
        factors[order[some]] = np.maximum(factors[order[some]], length)
    return factors


def repeated_windows(data: np.ndarray, windows: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Which windows have a longest previous factor of ``window`` bytes or more, and which are one.

    The decision of ``longest_previous_factors`` without the shorter lengths: the previous or the next
    smaller position has the same rank."""
    ranks = suffix_ranks(data, window)[-1][1]
    order, *sides = _in_order(ranks, windows)
    own = ranks[windows[order]]
    copy, source = np.zeros(len(windows), bool), np.zeros(len(windows), bool)
    for side in sides:
        same = np.flatnonzero((side >= 0) & (own[side] == own))
        copy[order[same]] = True
        source[order[side[same]]] = True
    return copy, source


def _covered(flags: np.ndarray) -> list[list[int]]:
    """Maximal runs ``[first, end)`` of set flags."""
    change = np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8))
    return list(map(list, zip(np.flatnonzero(change == 1).tolist(), np.flatnonzero(change == -1).tolist())))


def _in_suffix_order(groups: DataFrame, window: int, later_only: bool) -> DataFrame:
    """Windows of each context that occur in other contexts (or earlier in its own) of its gram.

    ``groups`` has the gram's contexts in ``members``, in the order of their places."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = {}, 0
            for row in range(batch.num_rows):
                for member in batch.column(0)[row].as_py():
                    key = (member["gram"], member["context"])
                    if key not in held:
                        held[key] = member["bytes"]
                        size += len(member["bytes"])
                if size > CHUNK:
                    yield solve(held)
                    held, size = {}, 0
            if held:
                yield solve(held)

    def solve(held: dict) -> pa.RecordBatch:
        texts = list(held.values())
        data = np.frombuffer(b"".join(texts) + b"\0" * 8, np.uint8)
        lengths = np.array([len(t) for t in texts])
        starts = np.cumsum(lengths) - lengths
        numbers = lengths - window + 1
        ends = np.cumsum(numbers)
        windows = np.arange(ends[-1]) + np.repeat(starts - (ends - numbers), numbers)
        copy, source = repeated_windows(data, windows, window)
        hit = copy if later_only else copy | source
        spans = [_covered(hit[e - n : e]) for e, n in zip(ends, numbers)]
        keys = np.array(list(held), np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(spans, pa.list_(pa.list_(pa.int32())))],
            ["gram", "context", "spans"],
        )

    return groups.select("members").mapInArrow(walk, "gram long, context long, spans array<array<int>>")


def _by_window(contexts: DataFrame, window: int, later_only: bool) -> DataFrame:
    """The same for grams with very many contexts: their windows are counted by their hashes, so
    that no task holds the contexts of such a gram."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            numbers = np.array([len(t) - window + 1 for t in texts], np.int64)
            row = pa.array(np.repeat(np.arange(len(texts)), numbers))
            digest = xxhash.xxh3_128_digest
            hashes = [digest(t[i : i + window]) for t, n in zip(texts, numbers) for i in range(n)]
            offsets = [i for n in numbers for i in range(n)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(row),
                    batch.column(1).take(row),
                    batch.column(3).take(row),
                    pa.array(offsets, pa.int32()),
                    pa.array(hashes, pa.binary()),
                ],
                ["gram", "context", "first", "offset", "hash"],
            )

    place = contexts.schema["first"].dataType.simpleString()
    schema = f"gram long, context long, first {place}, offset int, hash binary"
    rows = contexts.select("gram", "context", "bytes", "first").mapInArrow(split, schema)
    rows = materialize(rows, "windows")
    here = F.struct("first", "offset")
    counted = rows.groupBy("hash").agg(F.count("*").alias("n"), F.min(here).alias("least"))
    rows = rows.join(materialize(counted.where("n > 1"), "equal-windows"), "hash")
    if later_only:
        rows = rows.where(here != F.col("least"))
    spans = F.transform(F.array_sort(F.collect_set("offset")), lambda i: F.array(i, i + 1))
    return rows.groupBy("gram", "context").agg(spans.alias("spans"))


def _packed(docs: DataFrame) -> DataFrame:
    """The texts compressed, to be shuffled by document."""

    def pack(texts: pd.Series) -> pd.Series:
        return pd.Series([zlib.compress(t.encode("utf-8", "surrogatepass"), 1) for t in texts], dtype=object)

    packed = F.pandas_udf(pack, "binary")(text_or_empty("text")).alias("packed")
    return docs.select("doc_id", document_key("doc_id", "text").alias("doc"), packed)


def _fetched(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """The contexts' bytes, ``(gram, context, first, bytes)``, from the documents of their first
    occurrences."""
    item = F.struct("gram", "context", "first", "n")
    by_doc = wanted.groupBy(F.col("first.doc").alias("doc")).agg(F.collect_list(item).alias("items"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                text = zlib.decompress(batch.column(0)[row].as_py())
                items = batch.column(1).slice(row, 1).flatten()
                starts = items.field("first").field("start").to_pylist()
                stops = (s + n + window - 1 for s, n in zip(starts, items.field("n").to_pylist()))
                parts = pa.array([text[a:b] for a, b in zip(starts, stops)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [items.field("gram"), items.field("context"), items.field("first"), parts],
                    ["gram", "context", "first", "bytes"],
                )

    place = wanted.schema["first"].dataType.simpleString()
    rows = _packed(docs).join(by_doc, "doc").select("packed", "items")
    return rows.mapInArrow(cut, f"gram long, context long, first {place}, bytes binary")


def repeated_spans(
    documents: DataFrame,
    window: int = 200,
    keep_first: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
    contexts: int = CONTEXTS,
) -> DataFrame:
    """Spans ``[first, end)`` of bytes to remove, ``(doc, spans)``, possibly touching each other.

    A span is covered by strings of ``window`` bytes that also start anywhere else, in another
    document or the same one; with ``keep_first`` only by those that also start earlier, in the
    order of document id (null last), text hash and position. Matches are judged on the input and
    do not cross documents. ``doc`` identifies a document by ``document_key``; those without such
    a string do not appear. Null texts are empty. Rows that are equal in id and text are copies of
    each other: all their strings occur elsewhere, but none of them is earlier.

    Every window belongs to the run of windows that share its rarest gram, so equal windows are
    sought among the runs of one gram only. Grams that occur once are dropped by a count. Runs with
    equal contexts are copies as a whole. Only the different contexts of a gram are fetched and put
    in suffix order together; of a gram with more than ``contexts`` of them, windows are counted
    by hash instead.
    """
    docs = pick(documents, doc_id=id_col, text=text_col)
    runs = materialize(_runs(docs, window), "runs")
    grams = runs.groupBy("gram").agg(
        F.count("*").alias("n"), F.min("context").alias("low"), F.max("context").alias("high")
    )
    grams = grams.where("n > 1").select("gram", (F.col("low") != F.col("high")).alias("mixed"))
    shared = materialize(runs.join(materialize(grams, "grams"), "gram"), "shared")

    place = F.struct(F.isnull("doc_id").alias("none"), "doc_id", "doc", "start").alias("first")
    distinct = shared.groupBy("gram", "context").agg(
        F.min(place).alias("first"),
        F.count("*").alias("copies"),
        F.max("n").alias("n"),
        F.max("mixed").alias("mixed"),
    )
    distinct = materialize(distinct, "contexts")
    mixed = distinct.where("mixed").select("gram", "context", "first", "n")
    crowds = mixed.groupBy("gram").count().where(F.col("count") > contexts).select("gram")
    crowds = materialize(crowds, "crowds")
    fetched = materialize(_fetched(docs, mixed, window), "fetched")
    few = fetched.join(crowds, "gram", "left_anti").groupBy("gram").agg(
        F.array_sort(F.collect_list(F.struct("first", "gram", "context", "bytes"))).alias("members")
    )
    spans = _in_suffix_order(few, window, keep_first)
    many = _by_window(fetched.join(crowds, "gram", "left_semi"), window, keep_first)
    spans = materialize(spans.unionByName(many).where(F.size("spans") > 0), "spans")

    solved = distinct.select("gram", "context", "first", "copies").join(spans, ["gram", "context"], "left")
    whole = F.array(F.array(F.lit(0), F.col("n")))
    here = (F.col("doc") == F.col("first.doc")) & (F.col("start") == F.col("first.start"))
    all_of_it = ~here if keep_first else F.col("copies") > 1
    hits = F.when(all_of_it, whole).otherwise(F.col("spans"))
    solved = materialize(solved.where("copies > 1 or spans is not null"), "solved")
    found = shared.join(solved, ["gram", "context"]).select("doc", "start", F.explode(hits).alias("hit"))
    first = F.col("start") + F.col("hit")[0]
    span = F.struct(first.alias("first"), (F.col("start") + F.col("hit")[1] - 1 + window).alias("end"))
    found = found.select("doc", span.alias("span"))
    return found.groupBy("doc").agg(F.array_sort(F.collect_set("span")).alias("spans"))


def merged(spans) -> list[tuple[int, int]]:
    """Sorted spans with touching and overlapping ones made one."""
    out: list[tuple[int, int]] = []
    for span in spans if spans is not None else ():
        first, end = int(span["first"]), int(span["end"])
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    stops = [0, *(edge for span in spans for edge in span), len(text)]
    return b"".join(text[a:b] for a, b in zip(stops[::2], stops[1::2]))


def _cut(documents, window, keep_first, id_col, text_col, contexts):
    docs = pick(documents, doc_id=id_col, text=text_col)
    spans = materialize(repeated_spans(docs, window, keep_first, contexts=contexts), "cuts")
    return _packed(docs).join(spans, "doc", "left")


def removed(
    documents: DataFrame,
    window: int = 200,
    keep_first: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
    contexts: int = CONTEXTS,
) -> DataFrame:
    """Every document's ``kept`` bytes, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed
    runs) and ``kept_sha256``, with its ``doc_id``. See ``repeated_spans``."""

    def run(packed: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for data, found in zip(packed, spans):
            text, cuts = zlib.decompress(data), merged(found)
            kept = without(text, cuts)
            digest = hashlib.sha256(kept).hexdigest()
            out.append((kept, len(text), len(text) - len(kept), len(cuts), digest))
        return pd.DataFrame(out, columns=["kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    schema = "kept binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    done = F.pandas_udf(run, schema).asNondeterministic()("packed", "spans").alias("done")
    return _cut(documents, window, keep_first, id_col, text_col, contexts).select("doc_id", done).select(
        "doc_id", "done.*"
    )
