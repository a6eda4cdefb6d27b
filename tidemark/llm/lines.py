"""Fuzzy line deduplication: one occurrence of each group of similar lines stays."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columns import pick, text_or_empty, text_slices
from tidemark.llm.components import connected_components
from tidemark.llm.edits import edit_distance, within
from tidemark.llm.groups import in_parts, link_members, spanning_links
from tidemark.sources.tables import materialize

BITS = 64
#: What a task compares at once, at most: fingerprints, or lines and characters of lines. Plan only.
PRINTS, LINES, CHARS = 2048, 32_768, 16_000_000

#: Bytes of a line's sketch, each the least of one hash of its 5-grams; lines meet that agree in one
#: band of four bytes, and are compared if at least so many bytes agree (of 35,910 similar pairs of
#: check_s that share a band and agree in 16 or more, none agreed in fewer than 24).
SKETCH, BAND, AGREEING = 64, 4, 22
#: Bits below a band's number in the key of those that agree in it.
BAND_BITS = 40
#: Bytes whose 5-grams are hashed at once. Plan only.
SKETCHED = 200_000
#: Counters of pairs of bytes that bound an edit distance, a power of two.
PROFILE = 512
#: Lots that keys are dealt into, and keys packed or sorted at once. Plan only.
LOTS, DEALT = 4096, 500_000
#: Members of a group of sketches all pairs of which are compared at once, pairs compared at once, bytes of
#: lines verified at once, and characters of the longer lines of pairs measured at once; lines whose words
#: are looked at before others are measured with them. Plan only.
AT_ONCE, PAIRS_AT_ONCE, VERIFIED, MEASURED, TRIED = 64, 100_000, 8_000_000, 4_000_000, 16
_SEEDS = np.random.default_rng(5).integers(1, 2**31, SKETCH).astype(np.uint32) * np.uint32(2) + np.uint32(1)

#: Words skipped on either side to where two lines agree again, the fewest first, and words beyond an end.
_STEPS = sorted(((x, y) for x in range(5) for y in range(5) if x or y), key=lambda s: (max(s), -sum(s)))
_NONE, _OTHER = ["\n"] * 6, ["\n\n"] * 6

_TO_WORDS = bytes(b if b >= 128 or b == 10 or bytes([b]).isalnum() else 32 for b in range(256))


def words_only(text: str) -> bytes:
    """A text in lower case with a blank for each ASCII character that is no letter, digit or line
    end; other characters are kept."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_TO_WORDS)


def normalised(line: str) -> list[str]:
    """The words of a line as lines are compared."""
    words = words_only(line).split()
    return [word.decode("utf-8", "surrogatepass") for word in words]


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of a 64-bit hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_FIRST = np.array([(1 << 8 * i) - 1 for i in range(8)] + [2**64 - 1], np.uint64)
#: A byte's bits, each in a byte of its own.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(np.uint64).ravel()


def word_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, eight bytes at a time. ``data`` ends with eight spare bytes."""
    eights = np.lib.stride_tricks.as_strided(data[:8].view("<u8"), (len(data) - 7,), (1,))
    hashes = _mixed(lengths.astype(np.uint64))
    at = np.arange(len(starts))
    for offset in range(0, int(lengths.max(initial=0)), 8):
        at = at[lengths[at] > offset]
        part = eights[starts[at] + offset] & _FIRST[np.minimum(lengths[at] - offset, 8)]
        hashes[at] = _mixed(hashes[at] ^ part)
    return hashes


def _majorities(words: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """Per line the bits that are set in more than half of its different words' hashes."""
    keys = np.sort((lines.astype(np.uint64) << np.uint64(40)) | (words >> np.uint64(24)))
    keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    of = (keys >> np.uint64(40)).astype(np.int64)
    firsts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
    n = np.diff(np.append(firsts, len(keys)))
    bits = _BITS[_mixed(keys & np.uint64((1 << 40) - 1)).view(np.uint8).reshape(-1, 8)]
    counts = np.add.reduceat(bits, firsts, axis=0).view(np.uint8)  # right up to 255 words
    more = 2 * counts.astype(np.int64) > n[:, None]
    for i in np.flatnonzero(n > 255):
        own = bits[firsts[i] : firsts[i] + n[i]].view(np.uint8)
        more[i] = 2 * own.sum(axis=0, dtype=np.int64) > n[i]
    return np.packbits(more, axis=1).view(">i8").ravel()


def line_prints(text: bytes, simhash: bool = True) -> tuple[np.ndarray, ...]:
    """Number of words, hash, SimHash and length in characters of each line of a text that has nothing
    but words, blanks and line ends (``words_only``); further blanks do not count.

    The SimHash (zero without ``simhash``) is over a line's different words, each counting once: by
    number, the few most frequent words of a language would make all its long lines alike.
    """
    data = np.frombuffer(text + b"\n" + b" " * 8, np.uint8)
    body = data[:-8]
    apart = (body == 32) | (body == 10)
    change = np.diff(np.concatenate([[True], apart]).astype(np.int8))
    starts, ends = np.flatnonzero(change == -1), np.flatnonzero(change == 1)
    line_ends = np.flatnonzero(body == 10)
    last = np.searchsorted(starts, line_ends)
    n = np.diff(np.concatenate([[0], last]))
    hashes, prints = np.zeros(len(n), np.uint64), np.zeros(len(n), np.int64)
    sizes = np.zeros(len(n), np.int64)
    some = np.flatnonzero(n)
    if len(some):
        lengths = ends - starts
        words = word_hashes(data, starts, lengths)
        firsts = (last - n)[some]
        place = (np.arange(len(starts)) - np.repeat(firsts, n[some])).astype(np.uint64)
        placed = _mixed(words + place * np.uint64(0x9E3779B97F4A7C15))
        hashes[some] = np.add.reduceat(placed, firsts)
        characters = np.concatenate([[0], np.cumsum((body & 0xC0) != 0x80)])
        sizes[some] = np.add.reduceat(characters[ends] - characters[starts], firsts) + n[some] - 1
        if simhash:
            prints[some] = _majorities(words, np.repeat(np.arange(len(some)), n[some]))
    return n, hashes.view(np.int64), prints, sizes


def line_sketches(text: bytes, wanted: np.ndarray) -> np.ndarray:
    """MinHash sketches, a row of ``SKETCH`` bytes each, of the ``wanted`` lines (positions) of a text
    as ``line_prints`` takes it, over the 5-grams of a line's bytes with one blank between words.

    Two sketches agree in about the share of 5-grams that the lines have in common.
    """
    out = np.zeros((len(wanted), SKETCH), np.uint8)
    data = np.frombuffer(b"\n" + text + b"\n", np.uint8)
    apart = (data == 32) | (data == 10)
    # of a run of blanks the first stays, none beside a line end
    keep = ~((data == 32) & np.concatenate([[True], apart[:-1]]))
    data = data[keep]
    keep = ~((data == 32) & np.concatenate([data[1:] == 10, [True]]))
    data = data[keep]
    ends = np.flatnonzero(data == 10)
    starts, stops = ends[:-1][wanted] + 1, ends[1:][wanted]
    data = np.concatenate([data, np.full(8, 10, np.uint8)])
    eights = np.lib.stride_tricks.as_strided(data[:8].view("<u8"), (len(data) - 7,), (1,))
    stops = np.maximum(stops - 4, starts + 1)  # a shorter line has one gram
    cuts = np.cumsum(stops - starts) // SKETCHED
    for cut in np.unique(cuts):
        own = np.flatnonzero(cuts == cut)
        first, last = int(starts[own[0]]), int(stops[own[-1]])
        grams = _mixed(eights[first:last] & np.uint64((1 << 40) - 1))
        grams = np.append((grams >> np.uint64(32)).astype(np.uint32), np.uint32(0))
        places = np.column_stack([starts[own], stops[own]]).ravel() - first
        hashed, least = np.empty_like(grams), np.empty((SKETCH, len(own)), np.uint32)
        for i, seed in enumerate(_SEEDS):
            np.multiply(grams, seed, out=hashed)
            least[i] = np.minimum.reduceat(hashed, places)[::2]
        out[own] = ((least * np.uint32(0x9E3779B1)) >> np.uint32(24)).T
    return out


def _found(docs: DataFrame, min_words: int, sketched: bool, short: bool) -> DataFrame:
    """Every line of at least ``min_words`` words: its place, hash, SimHash and length, and its sketch
    if asked for. With ``short``, the other lines too that are not blank, with a hash alone."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in text_slices(batch.column(2)):
                yield rows(batch.slice(start, len(texts)), texts)

    def rows(batch: pa.RecordBatch, raw: list[str]) -> pa.RecordBatch:
        texts = [words_only(t) for t in raw]
        joined = b"\n".join(texts)
        n, hashes, prints, sizes = line_prints(joined, simhash=not sketched)
        lines = np.array([t.count(b"\n") + 1 for t in texts])
        doc = np.repeat(np.arange(len(texts)), lines)
        number = np.arange(len(doc)) - np.repeat(np.cumsum(lines) - lines, lines)
        long = n >= min_words
        taken = long | (n > 0) if short else long
        if short:  # lines of marks alone are compared as they are
            split: dict[int, list[str]] = {}
            for i in np.flatnonzero(n == 0):
                at = int(doc[i])
                line = split.setdefault(at, raw[at].split("\n"))[number[i]].strip()
                if line:
                    marks = xxhash.xxh3_64_intdigest(line.encode("utf-8", "surrogatepass"))
                    hashes[i] = np.uint64(marks).astype(np.int64)
                    taken[i] = True
        kept = np.flatnonzero(taken)
        where, alone = pa.array(doc[kept]), ~long[kept]
        columns = [
            batch.column(0).take(where),
            batch.column(1).take(where),
            pa.array(number[kept].astype(np.int32)),
            pa.array(hashes[kept]),
            pa.array(prints[kept], mask=alone),
            pa.array(sizes[kept].astype(np.int32)),
        ]
        if sketched:
            sketches = np.zeros((len(kept), SKETCH), np.uint8)
            sketches[~alone] = line_sketches(joined, np.flatnonzero(long))
            sketches = [None if a else x.tobytes() for a, x in zip(alone.tolist(), sketches)]
            columns.append(pa.array(sketches, pa.binary()))
        return pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    names = ["doc_id", "doc", "line_no", "line", "fp", "size", "sketch"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, doc long, line_no int, line long, fp long, size int"
    schema += ", sketch binary" if sketched else ""
    keyed = docs.select("doc_id", document_key("doc_id", "text"), text_or_empty("text"))
    return keyed.mapInArrow(scan, schema)


def block_masks(radius: int, agreeing: int = 2) -> list[int]:
    """Masks of ``agreeing`` of ``radius + agreeing`` blocks of bits.

    At most ``radius`` differing bits touch at most ``radius`` blocks, so the others agree."""
    edges = np.linspace(0, BITS, radius + agreeing + 1).astype(int)
    blocks = [sum(1 << b for b in range(*pair)) for pair in zip(edges, edges[1:])]
    masks = [sum(chosen) for chosen in combinations(blocks, agreeing)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def similar(a: list[str], b: list[str], least: float) -> bool:
    """Whether the edit distance of two lines, given as their words, is at most ``1 - least`` of
    the longer one."""
    most = _most_edits(*(sum(map(len, words)) + len(words) - 1 for words in (a, b)), least)
    known = _plainly_similar(a, b, most)
    return edit_distance(" ".join(a), " ".join(b)) <= most if known is None else known


def _most_edits(size: int, other: int, least: float) -> int:
    return int((1 - least) * max(size, other) + 1e-9)


def _plainly_similar(a: list[str], b: list[str], most: int) -> bool | None:
    """Whether at most ``most`` edits lead from one line's words to the other's, if lengths or changing
    runs of unequal words tell, else None."""
    if abs(sum(map(len, a)) + len(a) - sum(map(len, b)) - len(b)) > most:
        return False
    start, limit = 0, min(len(a), len(b))
    while start < limit and a[start] == b[start]:
        start += 1
    stop = 0
    while stop < limit - start and a[-1 - stop] == b[-1 - stop]:
        stop += 1
    left, right = a[start : len(a) - stop], b[start : len(b) - stop]
    if len(left) == len(right):  # replacing unequal words one by one may do
        if sum(max(len(x), len(y)) for x, y in zip(left, right) if x != y) <= most:
            return True
    return True if _changed(left, right, most) else None


def _changed(left: list[str], right: list[str], most: int) -> bool:
    """Whether at most ``most`` edits lead from one sequence of words to the other if words are replaced,
    left out or put in up to the next two that are equal, looking a few words ahead only."""
    m, n, i, j = len(left), len(right), 0, 0
    left, right = left + _NONE, right + _OTHER
    while i < m and j < n:
        if left[i] == right[j]:
            i, j = i + 1, j + 1
            continue
        for x, y in _STEPS:
            if left[i + x] == right[j + y] and left[i + x + 1] == right[j + y + 1]:
                break
        else:
            x = y = 1
        # blanks between replaced words stay, those of the others come or go with them
        gone, new = left[i : min(i + x, m)], right[j : min(j + y, n)]
        most -= sum(max(len(g), len(n)) for g, n in zip(gone, new))
        if x != y:
            most -= sum(len(w) + 1 for w in gone[len(new) :]) + sum(len(w) + 1 for w in new[len(gone) :])
        if most < 0:
            return False
        i, j = i + x, j + y
    return sum(len(w) + 1 for w in left[min(i, m) : m]) + sum(len(w) + 1 for w in right[min(j, n) : n]) <= most


def _near_prints(prints: DataFrame, radius: int, size: int) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints ``fp`` at most ``radius`` bits apart, enough
    to connect all that are connected."""
    keys = [
        F.xxhash64(F.lit(t), F.col("fp").bitwiseAND(mask)) for t, mask in enumerate(block_masks(radius))
    ]
    placed = prints.select("fp", F.explode(F.array(*keys)).alias("key"))
    shared = placed.groupBy("key").agg(
        F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")
    )
    shared = materialize(shared.where("n > 1"), "shared")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    twos = shared.where("n = 2").where(near).select("a", "b")
    members = placed.join(shared.where("n > 2").select("key", "n"), "key")
    parts = F.ceil(F.col("n") * 2 / size)
    groups = in_parts(members.withColumn("parts", parts), "fp").groupBy("key", "part")
    return twos.union(link_members(groups.agg(F.collect_list("fp").alias("members")), radius))


def _sketches(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, SKETCH)


def _lengths_fit(sizes: np.ndarray, at, others, least: float) -> np.ndarray:
    """Whether the lengths of lines allow an edit similarity of ``least``."""
    low, high = np.minimum(sizes[at], sizes[others]), np.maximum(sizes[at], sizes[others])
    return high - low <= (1 - least) * high + 1e-9


def _met_first(marks: np.ndarray, at: int, others: np.ndarray, band: int) -> np.ndarray:
    """Whether a band is the first in which a sketch agrees with each of the others."""
    bands = marks.view(np.uint32)
    return (bands[others] == bands[at]).argmax(axis=1) == band


def _members(sketches: DataFrame, least: float) -> DataFrame:
    """Which lines meet by a band: ``(line, key, n)`` with the number of lines under the ``key``, whose
    highest bits are the band.

    A line stays under a key if the next shorter or longer one there has a length that fits, as else
    none has. Where the same lines meet by several bands they do so under the first key only: no pair
    that is left to the others has one of these as its first band."""

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            lines, sizes = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
            bands = _sketches(batch.column(1)).view(np.uint32)
            for start in range(0, len(lines), DEALT // bands.shape[1]):
                held.append([x[start : start + DEALT // bands.shape[1]] for x in (lines, bands, sizes)])
                n += held[-1][1].size
                if n >= DEALT:
                    yield packed(held)
                    held, n = [], 0
        if n:
            yield packed(held)

    def packed(held: list) -> pa.RecordBatch:
        lines, bands, sizes = (np.concatenate(part) for part in zip(*held))
        n = bands.shape[1]
        keys = (bands.astype(np.int64) | np.arange(n) << BAND_BITS).ravel()
        lot = (_mixed(keys.view(np.uint64)) % np.uint64(LOTS)).astype(np.uint16)
        order = np.argsort(lot, kind="stable")
        lot = lot[order]
        firsts = np.flatnonzero(np.append(True, lot[1:] != lot[:-1]))
        columns = [pa.array(lot[firsts].astype(np.int32))]
        for values in (keys[order], lines[order // n], sizes[order // n]):
            cuts = np.append(firsts, len(values)) * values.itemsize
            buffers = [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(values)]
            columns.append(pa.Array.from_buffers(pa.binary(), len(firsts), buffers))
        return pa.RecordBatch.from_arrays(columns, ["lot", "keys", "lines", "sizes"])

    def meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # all rows of a lot follow each other
        held, n = [], 0
        for batch in batches:
            lots = batch.column(0).to_numpy()
            news = np.flatnonzero(np.diff(lots)) + 1 if len(lots) else []
            for start, stop in zip([0, *news], [*news, len(lots)]):
                part = batch.slice(start, stop - start)
                if n >= DEALT and held[-1].column(0)[0] != part.column(0)[0]:
                    yield met(held)
                    held, n = [], 0
                held.append(part)
                n += pa.compute.sum(pa.compute.binary_length(part.column(1))).as_py() // 8
        if held:
            yield met(held)

    def met(held: list) -> pa.RecordBatch:
        keys, lines, sizes = (
            np.frombuffer(b"".join(x for part in held for x in part.column(i).to_pylist()), kind)
            for i, kind in ((1, np.int64), (2, np.int64), (3, np.int32))
        )
        order = np.argsort(keys)
        same = keys[order[1:]] == keys[order[:-1]]
        order = order[np.append(same, False) | np.append(False, same)]
        order = order[np.lexsort((sizes[order], keys[order]))]
        keys, lines, sizes = keys[order], lines[order], sizes[order]
        if len(keys):
            fit = (keys[1:] == keys[:-1]) & (np.diff(sizes) <= (1 - least) * sizes[1:] + 1e-9)
            near = np.append(fit, False) | np.append(False, fit)
            keys, lines = keys[near], lines[near]
        counts = others = np.zeros(0, np.int64)
        if len(keys):
            firsts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            counts = np.diff(np.append(firsts, len(keys)))
            others = np.bitwise_xor.reduceat(_mixed(lines.view(np.uint64)), firsts).view(np.int64)
        columns = [lines, keys, np.repeat(counts, counts), np.repeat(others, counts)]
        columns = [pa.array(c, pa.int64()) for c in columns]
        return pa.RecordBatch.from_arrays(columns, ["line", "key", "n", "lines"])

    lots = sketches.select("line", "sketch", "size")
    lots = lots.mapInArrow(dealt, "lot int, keys binary, lines binary, sizes binary")
    lots = lots.repartition("lot").sortWithinPartitions("lot")
    near = lots.mapInArrow(meeting, "line long, key long, n long, lines long")
    return near.repartition("line").groupBy("line", "n", "lines").agg(F.min("key").alias("key")).drop("lines")


def _agreeing(marks: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """In how many bytes pairs of sketches agree."""
    same = (marks[left] == marks[right]).view(np.uint64).sum(axis=1)  # up to 8 in each byte
    return (same * np.uint64(0x0101010101010101)) >> np.uint64(56)


def _linked_in_groups(
    marks: np.ndarray,
    sizes: np.ndarray,
    bands: np.ndarray,
    starts: np.ndarray,
    counts: np.ndarray,
    least: float,
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Group, position and the position of a root, the same for those that are connected in a group, of
    all sketches that are linked to another of their group, by sizes of groups."""
    words = marks.view(np.uint32)

    def linked(left: np.ndarray, right: np.ndarray, band: np.ndarray) -> np.ndarray:
        near = np.flatnonzero(_lengths_fit(sizes, left, right, least))
        near = near[_agreeing(marks, left[near], right[near]) >= AGREEING]
        return near[(words[left[near]] == words[right[near]]).argmax(axis=1) == band[near]]

    for n in np.unique(counts[counts > 1]).tolist():
        same = np.flatnonzero(counts == n)
        if n > AT_ONCE:
            for row in same.tolist():
                start, band = int(starts[row]), bands[row]
                own, own_sizes = marks[start : start + n], sizes[start : start + n]

                def fits(at: int, others: np.ndarray) -> np.ndarray:
                    return _lengths_fit(own_sizes, at, others, least) & _met_first(own, at, others, band)

                root: dict[int, int] = {}
                for a, b in spanning_links(own, SKETCH - AGREEING, fits):
                    root[b] = root.setdefault(a, a)
                nodes = np.array(list(root), np.int64) + start
                yield np.full(len(nodes), row), nodes, np.array(list(root.values()), np.int64) + start
            continue
        ones, others = np.triu_indices(n, 1)
        step = max(1, PAIRS_AT_ONCE // len(ones))
        for first in range(0, len(same), step):
            rows = same[first : first + step]
            left = (starts[rows][:, None] + ones).ravel()
            right = (starts[rows][:, None] + others).ravel()
            of = np.repeat(rows, len(ones))
            near = linked(left, right, bands[of])
            # roots: the least position that is reached, step by step along the links
            left, right = left[near], right[near]
            root = np.arange(len(sizes)) if n > 2 else None
            if root is None:
                yield np.repeat(of[near], 2), np.column_stack([left, right]).ravel(), np.repeat(left, 2)
                continue
            while True:
                lower = np.minimum(root[left], root[right])
                before = root.copy()
                np.minimum.at(root, left, lower)
                np.minimum.at(root, right, lower)
                if (before == root).all():
                    break
            nodes = np.unique(np.concatenate([left, right]))
            groups = np.searchsorted(starts, nodes, side="right") - 1
            yield groups, nodes, root[nodes]


def _near_sketches(sketches: DataFrame, size: int, least: float) -> DataFrame:
    """Lines that are to be compared, ``(block, root, band, line)``.

    ``sketches`` is ``(line, sketch, size)``. Lines meet in a block for each band in which they agree,
    and are compared in the first of them, if they agree in ``AGREEING`` bytes and their lengths allow
    it. Those that are connected so within a block share a ``root``."""
    # sketches only go to lines that meet another
    members = materialize(_members(sketches, least), "members")
    members = members.join(sketches, "line")
    parts = F.ceil(F.col("n") * 2 / size)
    groups = in_parts(members.withColumn("parts", parts), "line").groupBy("key", "part")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            members = lists.flatten()
            ids = members.field("line").to_numpy(zero_copy_only=False)
            sizes = members.field("size").to_numpy(zero_copy_only=False)
            marks = _sketches(members.field("sketch"))
            bands = batch.column(1).to_numpy(zero_copy_only=False)
            counts = lists.value_lengths().to_numpy(zero_copy_only=False)
            starts = np.cumsum(counts) - counts
            rows, roots, found = [], [], []
            for row, at, root in _linked_in_groups(marks, sizes, bands, starts, counts, least):
                rows.append(row)
                found.append(ids[at])
                roots.append(ids[root])
            if not rows:
                continue
            rows = np.concatenate(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows)),
                    pa.array(np.concatenate(roots), pa.int64()),
                    pa.array(bands[rows], pa.int32()),
                    pa.array(np.concatenate(found), pa.int64()),
                ],
                ["block", "root", "band", "line"],
            )

    groups = groups.agg(F.collect_list(F.struct("line", "sketch", "size")).alias("members"))
    band = F.shiftright("key", BAND_BITS).cast("int").alias("band")
    blocks = groups.select(F.xxhash64("key", "part").alias("block"), band, "members")
    return blocks.mapInArrow(walk, "block long, root long, band int, line long")


def _similar_in_blocks(docs: DataFrame, compared: DataFrame, size: int, least: float) -> DataFrame:
    """Links ``(a, b)`` of similar lines among ``compared``, ``(line, fp, size, first)`` with a sketch
    as ``fp``, enough to connect all similar pairs that share a band and agree in ``AGREEING`` bytes.

    Every pair is compared in one block only and every link is verified there, so no group of lines
    beyond a block is ever brought together."""
    sketches = compared.select("line", F.col("fp").alias("sketch"), "size")
    meet = materialize(_near_sketches(sketches, size, least), "meeting")
    wanted = compared.join(meet.select("line").distinct(), "line")
    places = materialize(wanted.select("line", "fp", "first.doc", "first.line_no"), "places")
    texts = materialize(_fetched(docs, places).select("line", "fp", "raw"), "compared")
    groups = meet.join(texts, "line").groupBy("block", "root")
    members = F.collect_list(F.struct("line", "fp", "raw")).alias("members")
    return _verified(groups.agg(members, F.first("band").alias("band")), 0, least, banded=True)


def pair_profiles(texts: list[bytes]) -> np.ndarray:
    """How often each pair of neighbouring bytes, by hash, is in each text; counts end at 65,535."""
    profiles = np.zeros((len(texts), PROFILE), np.uint16)
    for i, text in enumerate(texts):
        data = np.frombuffer(text, np.uint8).astype(np.uint32)
        pairs = ((data[:-1] * 257 + data[1:]) * np.uint32(0x9E3779B1)) >> np.uint32(32 - PROFILE.bit_length() + 1)
        profiles[i] = np.minimum(np.bincount(pairs, minlength=PROFILE), 65_535)
    return profiles


def _joined(
    texts: list[str], left: np.ndarray, right: np.ndarray, root: np.ndarray, least: float
) -> Iterator[np.ndarray]:
    """Which of the pairs of lines are similar, enough to connect all that these connect; ``root`` says which
    positions are connected already.

    Of the pairs between two components one is measured, then two and so on, those of all
    components together."""
    known = np.arange(len(left))
    most_asked = 1
    sizes = np.array([len(t) for t in texts])
    while True:
        ones, others = root[left[known]], root[right[known]]
        low, high = np.minimum(ones, others), np.maximum(ones, others)
        known, low, high = (x[ones != others] for x in (known, low, high))
        if not known.size:
            return
        order = np.lexsort((high, low))
        low, high = low[order], high[order]
        new = np.flatnonzero(np.append(True, (low[1:] != low[:-1]) | (high[1:] != high[:-1])))
        rank = np.arange(len(order)) - np.repeat(new, np.diff(np.append(new, len(order))))
        asked = known[order[rank < most_asked]]
        known = np.setdiff1d(known, asked, assume_unique=True)
        most_asked *= 2
        # those of about the same length together, a part of them at a time
        longer = np.maximum(sizes[left[asked]], sizes[right[asked]])
        order = np.argsort(longer, kind="stable")
        cuts = np.cumsum(longer[order]) // MEASURED
        for part in np.split(asked[order], np.flatnonzero(np.diff(cuts)) + 1):
            part = part[root[left[part]] != root[right[part]]]
            pairs = [(texts[a], texts[b]) for a, b in zip(left[part].tolist(), right[part].tolist())]
            most = [_most_edits(len(a), len(b), least) for a, b in pairs]
            near = part[within(pairs, most)]
            yield near
            _connect(root, left[near], right[near])


def _connect(root: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Has ``root``, where connected positions share their least one, take up links."""
    for a, b in zip(left.tolist(), right.tolist()):
        while root[a] != a:
            a = root[a]
        while root[b] != b:
            b = root[b]
        root[max(a, b)] = min(a, b)
    while len(left) and (root[root] != root).any():
        root[:] = root[root]


def _verified(groups: DataFrame, radius: int, least: float, banded: bool = False) -> DataFrame:
    """Spanning links ``(a, b)`` between the ids of similar lines in every row's ``members``.

    Where members have sketches these decide which lines are compared (if ``banded``, in the first
    ``band`` they agree in), else SimHashes do. Before the
    edit distance is measured, lengths and pairs of bytes must allow it: an edit changes one
    character, so eight bytes of two texts and ten of their pairs at most."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pa.compute.binary_length(batch.column(0).flatten().field("raw"))
            sizes = sizes.to_numpy(zero_copy_only=False)
            ends = np.cumsum(batch.column(0).value_lengths().to_numpy(zero_copy_only=False))
            cuts = np.append(0, np.cumsum(sizes))[ends] // VERIFIED
            starts = [0, *(np.flatnonzero(np.diff(cuts)) + 1).tolist(), batch.num_rows]
            for start, stop in zip(starts, starts[1:]):
                yield links(batch.slice(start, stop - start))

    def links(batch: pa.RecordBatch) -> pa.RecordBatch:
        members = batch.column(0).flatten()
        ids = members.field("line").to_numpy(zero_copy_only=False)
        joined = [b" ".join(words_only(t).split()) for t in members.field("raw").to_pylist()]
        texts = [t.decode("utf-8", "surrogatepass") for t in joined]
        plain = np.array([t.isascii() for t in texts], bool)
        sizes = np.array([len(t) for t in texts])
        profiles = pair_profiles(joined)
        prints, most = members.field("fp"), radius
        if pa.types.is_binary(prints.type):
            prints, most = _sketches(prints), SKETCH - AGREEING
        else:
            prints = prints.to_numpy(zero_copy_only=False).view(np.uint64)
        bands = batch.column(1).to_numpy(zero_copy_only=False) if banded else None

        counts = batch.column(0).value_lengths().to_numpy(zero_copy_only=False)
        starts = np.cumsum(counts) - counts
        pairs, doubtful = [(np.zeros(0, np.int64),) * 2], [(np.zeros(0, np.int64),) * 2]
        for row, (start, n) in enumerate(zip(starts.tolist(), counts.tolist())):
            own = prints[start : start + n]

            def confirm(at: int, others: np.ndarray) -> np.ndarray:
                edits = (1 - least) * np.maximum(sizes[start + at], sizes[start + others])
                # pairs gone and pairs new: two each for an edit between single bytes
                bound = np.where(plain[start + at] & plain[start + others], 4, 10) * (edits + 1)
                out = _lengths_fit(sizes, start + at, start + others, least)
                if banded:
                    out &= _met_first(own, at, others, bands[row])
                fit = np.flatnonzero(out)
                differences = np.abs(profiles[start + others[fit]].astype(np.int32) - profiles[start + at])
                out[fit] = differences.sum(axis=1) <= bound[fit]
                unknown = []
                words = texts[start + at].split(" ")
                fit = np.flatnonzero(out).tolist()
                for tried, i in enumerate(fit):
                    if tried == TRIED and 2 * len(unknown) > TRIED and len(fit) >= 8 * TRIED:
                        # words do not tell here, so all others are measured at once
                        rest = fit[tried:]
                        pairs = [(texts[start + at], texts[start + int(others[k])]) for k in rest]
                        out[rest] = within(pairs, [_most_edits(len(a), len(b), least) for a, b in pairs])
                        break
                    other = start + int(others[i])
                    most = _most_edits(int(sizes[start + at]), int(sizes[other]), least)
                    out[i] = _plainly_similar(words, texts[other].split(" "), most) or False
                    if not out[i]:
                        unknown.append(other)
                doubtful.append((np.full(len(unknown), start + at), np.array(unknown, np.int64)))
                return out

            near = spanning_links(own, most, confirm)
            pairs.append(tuple(np.array(near, np.int64).reshape(-1, 2).T + start))
        left, right = (np.concatenate(side) for side in zip(*pairs))
        root = np.arange(len(ids))
        _connect(root, left, right)
        ones, others = (np.concatenate(side) for side in zip(*doubtful))
        near = np.concatenate([np.zeros(0, np.int64), *_joined(texts, ones, others, root, least)])
        left, right = np.append(left, ones[near]), np.append(right, others[near])
        ends = [pa.array(ids[side], pa.int64()) for side in (left, right)]
        return pa.RecordBatch.from_arrays(ends, ["a", "b"])

    columns = ["members", "band"] if banded else ["members"]
    return groups.select(*columns).mapInArrow(walk, "a long, b long")


def _similar_by_print(
    docs: DataFrame, compared: DataFrame, radius: int, least: float, prints: int, lines: int
) -> DataFrame:
    """Links ``(a, b)`` of similar lines with SimHashes ``fp`` at most ``radius`` bits apart."""
    by_print = materialize(compared.groupBy("fp").agg(F.count("*").alias("lines")), "prints")
    near = connected_components(_near_prints(by_print.select("fp"), radius, prints))
    # lines that have a neighbour by SimHash, by connected group
    shared = by_print.where("lines > 1").select("fp", F.col("fp").alias("group"))
    grouped = near.select(F.col("node").alias("fp"), F.col("component").alias("group"))
    grouped = grouped.union(shared).groupBy("fp").agg(F.min("group").alias("group"))
    wanted = compared.select("line", "fp", "size", "first").join(materialize(grouped, "grouped"), "fp")
    wanted = materialize(wanted, "wanted")
    parts = F.ceil(2 * F.greatest(F.count("*") / lines, F.sum("size") / CHARS))
    sizes = wanted.groupBy("group").agg(F.count("*").alias("n"), parts.alias("parts"))
    sizes = materialize(sizes.where("n > 1").select("group", "parts"), "sizes")
    places = wanted.select("line", "fp", "group", "first.doc", "first.line_no").join(sizes, "group")
    members = _fetched(docs, materialize(places, "places"))
    groups = in_parts(members, "line").groupBy("group", "part")
    members = groups.agg(F.collect_list(F.struct("line", "fp", "raw")).alias("members"))
    return _verified(members, radius, least)


def repeated_lines(
    documents: DataFrame,
    similarity: float = 0.8,
    radius: int = 3,
    min_words: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
    prints: int = PRINTS,
    lines: int = LINES,
    sketched: bool = False,
    short: bool = False,
) -> DataFrame:
    """Line numbers (from 0) to remove from each document, ``(doc, removed)``.

    Lines are compared in normalised form; those of fewer than ``min_words`` words are left alone, or
    with ``short`` compared for being equal only (lines without any word as they are, but for blanks
    around them; blank lines stay). Two lines are linked if they are equal (in 64 bits of hash), or if their SimHashes (of different
    words) differ in at most ``radius`` bits and their edit similarity, 1 - distance / longer length in
    characters, is ``similarity`` or more. Of all occurrences of a connected group the first
    stays, in the order of document id (null last), then text hash, then line number. ``doc``
    identifies a document by ``document_key``; documents without anything to remove do not appear.
    Rows that are equal in id and text count as one document and are treated alike. Null texts
    have no lines.

    SimHashes of lines at a similarity of 0.8 are mostly farther apart than any radius that can be
    searched. With ``sketched``, lines are instead compared if they agree in one of 16 bands of a
    MinHash of their 5-grams and in a third of it, so that the edit similarity alone decides for
    nearly all pairs, and ``radius`` is not used.

    The first scan yields hashes only. Lines that have a neighbour by SimHash or sketch are then fetched.
    By sketch, they are verified within the blocks of lines that share a band; by SimHash, in groups
    connected by SimHash alone, each line once. Groups of more than ``lines`` lines or ``CHARS``
    characters (or ``prints`` fingerprints or sketches) are compared part by part in different tasks.
    """
    docs = pick(documents, doc_id=id_col, text=text_col)
    found = materialize(_found(docs, min_words, sketched, short), "occurrences")
    place = F.struct(F.isnull("doc_id").alias("none"), "doc_id", "doc", "line_no")
    mark = "sketch" if sketched else "fp"
    distinct = found.groupBy("line").agg(
        F.min(place).alias("first"),
        F.count("*").alias("n"),
        F.min(mark).alias("fp"),
        F.min("size").alias("size"),
    )
    distinct = materialize(distinct, "lines")
    compared = distinct.where(F.col("fp").isNotNull())
    if sketched:
        verified = _similar_in_blocks(docs, compared, prints, similarity)
    else:
        verified = _similar_by_print(docs, compared, radius, similarity, prints, lines)
    classes = materialize(connected_components(verified), "classes")
    classes = classes.select(F.col("node").alias("line"), F.col("component").alias("class"))

    # the occurrence that stays, for every line that is not alone
    similar_lines = compared.join(classes, "line").select("line", "first", "class")
    repeated = distinct.where("n > 1").join(classes, "line", "left_anti")
    linked = similar_lines.union(repeated.select("line", "first", F.col("line").alias("class")))
    linked = materialize(linked, "linked")
    stays = materialize(linked.groupBy("class").agg(F.min("first").alias("stays")), "stays")
    linked = materialize(linked.join(stays, "class").select("line", "stays"), "staying")
    kept = (F.col("doc") == F.col("stays.doc")) & (F.col("line_no") == F.col("stays.line_no"))
    gone = found.select("doc", "line_no", "line").join(linked, "line").where(~kept)
    removed = gone.groupBy("doc").agg(F.array_sort(F.collect_set("line_no")).alias("removed"))
    return materialize(removed, "removed")


def _fetched(docs: DataFrame, places: DataFrame) -> DataFrame:
    """The lines at ``(doc, line_no)`` with their text ``raw``."""
    keyed = docs.select(document_key("doc_id", "text").alias("doc"), "text")
    lines = keyed.select("doc", F.posexplode(F.split("text", "\n")).alias("line_no", "raw"))
    # documents that occur in several rows bring the same line several times
    return lines.join(places, ["doc", "line_no"]).dropDuplicates(["doc", "line_no"])


def document_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """One value per different pair of id and text."""
    return F.xxhash64(F.isnull(id_col), F.col(id_col), F.isnull(text_col), F.col(text_col))


def with_removed(
    documents: DataFrame, removed: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents with a column ``__removed``, the line numbers to remove or null."""
    keyed = documents.withColumn("__doc", document_key(id_col, text_col))
    removed = removed.withColumnsRenamed({"doc": "__doc", "removed": "__removed"})
    return keyed.join(removed, "__doc", "left").drop("__doc")


def _without(text: str | None, removed) -> str | None:
    if text is None or removed is None:
        return text
    gone = set(removed)
    return "\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone)


def dedup_lines(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents without repeated lines (``repeated_lines``), in the columns they came with.

    Every row stays; a document of which no line is left has an empty text, a null text stays null.
    """
    removed = repeated_lines(documents, id_col=id_col, text_col=text_col, **options)
    rows = with_removed(documents, removed, id_col, text_col)

    def cut(texts: pa.Array, gone: pa.Array) -> pa.Array:
        parts = []
        for start, part in text_slices(texts):
            numbers = gone.slice(start, len(part)).to_pylist()
            parts.append(pa.array(map(_without, part, numbers), pa.string()))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    cut = F.arrow_udf(cut, "string")
    return rows.withColumn(text_col, cut(text_col, "__removed")).drop("__removed")
