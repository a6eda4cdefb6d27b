"""Benchmark decontamination with a generalised suffix automaton of the test items."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.columns import pick, text_or_empty, text_slices
from tidemark.sources.tables import materialize

#: Words of benchmark items in one automaton, which every Python worker holds (about 130 MB).
#: A larger benchmark is matched block after block.
BLOCK_WORDS = 200_000
#: Longer items are cut into overlapping pieces that hold all their windows.
PIECE_WORDS = 1000
#: Ranges of hashes that blocks are filled from.
RANGES = 65_536

_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_TO_WORDS = bytes(
    b if _WORD.fullmatch(bytes([b])) is not None else 32 for b in bytes(range(256)).lower()
)

FOUND_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.list_(pa.int32()))),
        ("items", pa.list_(pa.string())),
        ("longest", pa.int32()),
    ]
)
FOUND = "n_words long, spans array<array<int>>, items array<string>, longest int"


def words_of(text: str) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and all non-ASCII characters, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()


class SuffixAutomaton:
    """Suffix automaton of several word sequences.

    After reading some words its state stands for the longest suffix of them that occurs in an
    item, and ``matches`` knows that suffix' length.
    """

    def __init__(self, items: Sequence[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        whole: dict[int, set] = {}
        inside: dict[int, set] = {}
        for item, words in items:
            state = 0
            for word in words:
                state = self._extend(state, word)
                inside.setdefault(state, set()).add(item)
            if 0 < len(words) < window:
                whole.setdefault(state, set()).add(item)
        by_length = sorted(range(len(self.link)), key=self.length.__getitem__)
        for state in reversed(by_length[1:]):  # where a string ends, its suffixes end too
            if state in inside and self.length[self.link[state]] >= window:
                inside.setdefault(self.link[state], set()).update(inside[state])
        #: Items with the window that ends here, once as many words match as a window has.
        self.windows: list[frozenset] = [frozenset()] * len(self.link)
        #: Short items that end here: those shorter than any match of the state, then those as
        #: long as its longest string.
        self.shorter: list[frozenset] = [frozenset()] * len(self.link)
        self.whole = {state: frozenset(ids) for state, ids in whole.items()}
        for state in by_length[1:]:
            above = self.link[state]
            if self.length[state] >= window:
                far = self.length[above] >= window
                self.windows[state] = self.windows[above] if far else frozenset(inside[state])
            self.shorter[state] = self.shorter[above] | self.whole.get(above, frozenset())

    def _new(self, length: int, link: int, after: dict[bytes, int]) -> int:
        self.next.append(after)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _extend(self, last: int, word: bytes) -> int:
        """The state of a known string with one more word."""
        if word in self.next[last]:
            return self._exactly(last, word)
        state = self._new(self.length[last] + 1, 0, {})
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at >= 0:
            self.link[state] = self._exactly(at, word)
        return state

    def _exactly(self, at: int, word: bytes) -> int:
        """The state whose longest string is that of ``at`` and the word; split off if need be."""
        to = self.next[at][word]
        if self.length[to] == self.length[at] + 1:
            return to
        part = self._new(self.length[at] + 1, self.link[to], dict(self.next[to]))
        self.link[to] = part
        while at >= 0 and self.next[at].get(word) == to:
            self.next[at][word] = part
            at = self.link[at]
        return part

    def matches(self, words: list[bytes]) -> tuple[list[list[int]], set, int]:
        """Hit spans ``[first, end)`` in words, items whose windows occur, longest match."""
        follow, link, length, window = self.next, self.link, self.length, self.window
        shorter, whole = self.shorter, self.whole
        spans: list[list[int]] = []
        items: set = set()
        state = matched = longest = 0
        for at, word in enumerate(words):
            to = follow[state].get(word)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = follow[state].get(word)
            if to is None:
                continue
            state = to
            matched += 1
            if matched > longest:
                longest = matched
            size = 0
            if matched >= window:
                items |= self.windows[state]
                size = window
            if shorter[state]:
                items |= shorter[state]
                size = size or max(length[s] for s in self._whole_above(state))
            if state in whole and matched == length[state]:
                items |= whole[state]
                size = max(size, matched)
            if size:
                first = at + 1 - size
                while spans and spans[-1][1] >= first:
                    first = min(first, spans.pop()[0])
                spans.append([first, at + 1])
        return spans, items, longest

    def _whole_above(self, state: int):
        state = self.link[state]
        while state > 0:
            if state in self.whole:
                yield state
            state = self.link[state]


def _pieces(item: str | None, text: str, window: int) -> list[tuple[str | None, list[bytes]]]:
    words = words_of(text)
    step = max(PIECE_WORDS, 2 * window)
    if len(words) <= step + window:
        return [(item, words)]
    starts = range(0, len(words) - window + 1, step)
    return [(item, words[s : s + step + window - 1]) for s in starts]


def _merge(spans: list[list[int]]) -> list[list[int]]:
    merged: list[list[int]] = []
    for first, end in sorted(spans):
        if merged and merged[-1][1] >= first:
            merged[-1][1] = max(end, merged[-1][1])
        else:
            merged.append([first, end])
    return merged


def _dealt(benchmark: DataFrame, window: int) -> tuple[DataFrame, int]:
    """Pieces ``(item, text, block)`` of the items ``(item, text)``, and the number of blocks.

    Equal rows count once and long items come in pieces, so that no row is large and the rows' hashes
    are spread evenly; blocks are filled in the order of hashes, range after range, up to
    ``BLOCK_WORDS`` and what the last range brings beyond.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            pieces = [p for item, text in rows for p in _pieces(item, text, window) if p[1]]
            columns = [
                pa.array([item for item, _ in pieces], pa.string()),
                pa.array([b" ".join(words).decode("utf-8", "surrogatepass") for _, words in pieces], pa.string()),
                pa.array([len(words) for _, words in pieces], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["item", "text", "words"])

    items = benchmark.select(F.col("item").cast("string"), text_or_empty("text").alias("text")).distinct()
    pieces = items.mapInArrow(cut, "item string, text string, words long").distinct()
    pieces = pieces.withColumn("range", F.pmod(F.xxhash64("item", "text"), F.lit(RANGES)))
    pieces = materialize(pieces, "benchmark")
    sums = pieces.groupBy("range").agg(F.sum("words").alias("words"))
    before = F.sum("words").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    block = F.floor(F.coalesce(before, F.lit(0)) / BLOCK_WORDS).alias("block")
    blocks = materialize(sums.select("range", block), "blocks")
    last = blocks.agg(F.max("block")).first()[0]
    return pieces.join(blocks, "range").select("item", "text", "block"), 0 if last is None else last + 1


def find_contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = 13,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    found_col: str = "found",
) -> DataFrame:
    """The documents with a column ``found``: what of the benchmark occurs in each.

    A window is ``window`` consecutive words of an item, or a whole item of fewer words. ``found``
    has ``n_words``; ``spans``, the maximal runs ``[first, end)`` of words inside occurrences of
    windows; ``items``, the sorted ids (as text) of items with occurring windows; and ``longest``,
    the longest run of words that is part of some item.

    All other columns are kept; a column called ``found_col`` is replaced. A null text has no
    words. Items with a null id are matched but not listed, items that share an id are listed
    once, items without words match nothing. An empty benchmark finds nothing.

    The benchmark is turned into automata of about ``BLOCK_WORDS`` words. If one does, documents are
    read once and not shuffled. For more they are stored once with a row number, scanned once for each
    block, and only numbers and findings are brought together.
    """
    pieces, blocks = _dealt(pick(benchmark, item=item_col, text=item_text_col), window)

    def finder(block: int) -> Callable[[Column], Column]:
        rows = pieces.where(F.col("block") == block).select("item", "text").collect()
        return _finder(rows, window)

    if blocks < 2:
        return documents.withColumn(found_col, finder(0)(text_col))
    stored = documents.drop(found_col).withColumn("__row", F.monotonically_increasing_id())
    stored = materialize(stored, "documents")
    parts = [stored.select("__row", finder(block)(F.col(text_col)).alias("f")) for block in range(blocks)]
    found = reduce(DataFrame.union, parts).groupBy("__row")
    found = found.agg(
        F.max("f.n_words").alias("n_words"),
        F.sort_array(F.flatten(F.collect_list("f.spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("f.items")))).alias("items"),
        F.max("f.longest").alias("longest"),
    )
    merge = F.udf(_merge, "array<array<int>>")
    spans = F.when(F.size("spans") > 1, merge("spans")).otherwise(F.col("spans")).alias("spans")
    found = found.select("__row", F.struct("n_words", spans, "items", "longest").alias(found_col))
    return stored.join(materialize(found, "found"), "__row").drop("__row")


def _finder(rows, window: int):
    pieces = [(item, words_of(text)) for item, text in rows]
    held: list[SuffixAutomaton] = []

    def find(texts: pa.Array) -> pa.Array:
        if not held:
            held.append(SuffixAutomaton(pieces, window))
        out = []
        for _, part in text_slices(texts):
            for text in part:
                words = words_of(text or "")
                spans, ids, longest = held[0].matches(words)
                ids.discard(None)
                out.append(
                    {"n_words": len(words), "spans": spans, "items": sorted(ids), "longest": longest}
                )
        return pa.array(out, FOUND_ARROW)

    return F.arrow_udf(find, FOUND).asNondeterministic()  # evaluated once, not once per use


def n_hit(found_col: str = "found") -> Column:
    """Words inside spans."""
    return F.aggregate(
        F.col(found_col)["spans"], F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0]
    )


def contaminated(found_col: str = "found", coverage: int = 20) -> Column:
    """Whether at least one word in ``coverage`` is hit, and any at all."""
    hit = n_hit(found_col)
    return (hit > 0) & (coverage * hit >= F.col(found_col)["n_words"])


def remove_spans(text: str, spans: list[list[int]]) -> str:
    """The text without the words of the spans and what stands between them."""
    data = text.encode("utf-8", "surrogatepass")
    words = [m.span() for m in _WORD.finditer(data)]
    kept, at = [], 0
    for first, end in spans:
        kept.append(data[at : words[first][0]])
        at = words[end - 1][1]
    kept.append(data[at:])
    return b"".join(kept).decode("utf-8", "surrogatepass")


def decontaminate(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = 13,
    coverage: int = 20,
    drop_share: float = 0.5,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The documents without benchmark passages, in the columns they came with.

    A document is contaminated if at least one word in ``coverage`` is inside a window's
    occurrence: its spans are cut out, or, if they hold ``drop_share`` of its words or more, it
    goes as a whole. All other documents stay as they are, null texts included.
    """
    found = "__found"
    rows = find_contamination(
        documents, benchmark, window, text_col, item_col, item_text_col, found
    )
    dirty = contaminated(found, coverage)
    most = dirty & (n_hit(found) >= drop_share * F.col(found)["n_words"])
    rows = rows.where(~most)
    cut = F.pandas_udf(
        lambda texts, spans: pd.Series(
            [t if s is None else remove_spans(t, s) for t, s in zip(texts, spans)], dtype=object
        ),
        "string",
    )
    spans = F.when(dirty, F.col(found)["spans"])
    return rows.withColumn(text_col, cut(text_col, spans)).drop(found)
