"""Collocations of two and three words, by sampling and exact passes over everything (Toivonen).

A sample of the documents proposes words and pairs of words. The full pass counts, over all documents,
what is proposed and its negative border: every word, every pair of proposed words, every triple whose
two pairs are proposed. Should a phrase of the border be frequent, its extensions were not counted, so
a further pass counts just those, until no border fails. Most of the border is rare, so these passes
count by 64-bit hash, which can only count too much; the last one counts exactly, as text, whatever
they left as possibly frequent. Every frequent phrase is among it, whatever the sample was.

What a pass needs to know travels as bit filters of fixed size. A bit set by another phrase makes a
pass count more than it need, never less.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.columns import batch_slices, pick, summed
from tidemark.sources.tables import materialize

#: What ends a piece of text; blanks and tabs part its words.
PIECE_ENDS = r"[.,;:!?\x0A-\x0D]"
#: Bits of a filter of phrases: 8 MB, whatever the corpus.
FILTER_BITS = 1 << 26
#: Bytes of text that a task takes in at once, and rows of hashes and of texts it adds up before they leave.
SLICE, HASHES, TEXTS = 3_000_000, 2_000_000, 800_000
#: The lowest bits of a hash hold the number of words.
SIZE_BITS = 2


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64 bits over 64 bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _sized(x: np.ndarray, size: int) -> np.ndarray:
    return (x << np.uint64(SIZE_BITS)) | np.uint64(size)


def _in(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = (hashes >> np.uint64(SIZE_BITS)) & np.uint64(len(bits) * 64 - 1)
    return (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


class _Slice:
    """Words, pairs and triples of some documents. A unit is a word of a language; ``here`` are the
    places where a pair starts, ``follows`` those among them where another starts a word later."""

    def __init__(self, batch: pa.RecordBatch):
        lowered = pc.replace_substring(pc.ascii_lower(batch.column("text")), "\t", " ")
        pieces = pc.split_pattern_regex(lowered, PIECE_ENDS)
        words = pc.split_pattern(pc.list_flatten(pieces), " ")
        flat, piece = pc.list_flatten(words), pc.list_parent_indices(words)
        filled = pc.not_equal(flat, "")
        terms = flat.filter(filled).dictionary_encode()
        piece = piece.filter(filled).to_numpy()
        self.langs = batch.column("lang").dictionary_encode()
        row = pc.list_parent_indices(pieces).to_numpy()[piece]
        lang = self.langs.indices.to_numpy()[row].astype(np.int64)
        width = max(len(terms.dictionary), 1)
        keys = pa.array(lang * width + terms.indices.to_numpy()).dictionary_encode()
        self.unit = keys.indices.to_numpy().astype(np.int64)
        self.unit_lang, self.unit_word = np.divmod(keys.dictionary.to_numpy(), width)
        self.terms, self.many = terms.dictionary, np.int64(len(keys.dictionary))
        word_hash, lang_hash = (
            np.array([xxhash.xxh64_intdigest(x, 7) for x in names.to_pylist()], np.uint64)
            for names in (terms.dictionary, self.langs.dictionary)
        )
        base = _mixed(word_hash[self.unit_word] ^ _mixed(lang_hash[self.unit_lang]))
        self.word_hash = _sized(base, 1)
        self.here = np.flatnonzero(piece[:-1] == piece[1:])
        first, second = base[self.unit[self.here]], base[self.unit[self.here + 1]]
        self.pair_hash = _sized(_mixed(first * np.uint64(3) + second), 2)
        self.follows = np.flatnonzero(self.here[1:] == self.here[:-1] + 1)
        chained = self.pair_hash[self.follows] * np.uint64(5) + self.pair_hash[self.follows + 1]
        self.triple_hash = _sized(_mixed(chained), 3)

    def within(self, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which pairs and triples have only known words and known pairs, respectively."""
        word, pair = _in(known, self.word_hash)[self.unit], _in(known, self.pair_hash)
        return word[self.here] & word[self.here + 1], pair[self.follows] & pair[self.follows + 1]


def _hashes(
    part: _Slice, known: np.ndarray | None, before: np.ndarray | None
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes and counts of all words, and of pairs and triples with known parts (None: of all pairs).
    With ``before``, only of pairs and triples whose parts were not known then."""
    if before is None:
        yield part.word_hash, np.bincount(part.unit, minlength=part.many)
    if known is None:
        yield np.unique(part.pair_hash, return_counts=True)
        return
    pairs, triples = part.within(known)
    if before is not None:
        pairs, triples = (new & ~old for new, old in zip((pairs, triples), part.within(before), strict=True))
    yield np.unique(part.pair_hash[pairs], return_counts=True)
    yield np.unique(part.triple_hash[triples], return_counts=True)


def _rows(part: _Slice, size: int, units: list[np.ndarray], f: np.ndarray) -> pa.Table:
    words = [part.terms.take(pa.array(part.unit_word[x])) for x in units]
    return pa.table(
        {
            "lang": part.langs.dictionary.take(pa.array(part.unit_lang[units[0]])),
            "size": pa.array(np.full(len(f), size, np.int32)),
            "phrase": pc.binary_join_element_wise(*words, " ") if size > 1 else words[0],
            "f": pa.array(f.astype(np.int64)),
        }
    )


def _texts(part: _Slice, likely: np.ndarray, known: np.ndarray, before: np.ndarray) -> Iterator[pa.Table]:
    """Likely phrases with counts, those with parts that are known but were not before, and a row of
    size 0 with the number of all words."""
    pairs, triples = (new & ~old for new, old in zip(part.within(known), part.within(before), strict=True))
    pairs, triples = pairs | _in(likely, part.pair_hash), triples | _in(likely, part.triple_hash)
    count = np.bincount(part.unit, minlength=part.many)
    chosen = np.flatnonzero(_in(likely, part.word_hash))
    yield _rows(part, 1, [chosen], count[chosen])
    total = np.bincount(part.unit_lang, count, len(part.langs.dictionary)).astype(np.int64)
    yield pa.table(
        {
            "lang": part.langs.dictionary,
            "size": pa.array(np.zeros(len(total), np.int32)),
            "phrase": pa.array([""] * len(total)),
            "f": pa.array(total),
        }
    )
    unit, many = part.unit, part.many
    at = part.here[pairs]
    found, f = np.unique(unit[at] * many + unit[at + 1], return_counts=True)
    yield _rows(part, 2, list(np.divmod(found, many)), f)
    at = part.here[part.follows[triples]]
    heads, head = np.unique(unit[at] * many + unit[at + 1], return_inverse=True)
    found, f = np.unique(head * many + unit[at + 2], return_counts=True)
    head, last = np.divmod(found, many)
    yield _rows(part, 3, [*np.divmod(heads[head], many), last], f)


def count_hashes(
    texts: DataFrame, known: np.ndarray | None = None, before: np.ndarray | None = None
) -> DataFrame:
    """``(hash, f)`` of what ``_hashes`` finds, summed over all rows of ``texts``."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        for batch in batch_slices(batches, "text", SLICE):
            for hashes, f in _hashes(_Slice(batch), known, before):
                yield pa.table({"hash": pa.array(hashes.view(np.int64)), "f": pa.array(f.astype(np.int64))})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from summed(parts(batches), ["hash"], "f", HASHES)

    return texts.mapInArrow(count, "hash long, f long").groupBy("hash").agg(F.sum("f").alias("f"))


def count_texts(texts: DataFrame, *filters: np.ndarray) -> DataFrame:
    """``(lang, size, phrase, f)`` of what ``_texts`` finds, summed over all rows of ``texts``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = batch_slices(batches, "text", SLICE)
        parts = (table for batch in slices for table in _texts(_Slice(batch), *filters))
        yield from summed(parts, ["lang", "size", "phrase"], "f", TEXTS)

    counted = texts.mapInArrow(count, "lang string, size int, phrase string, f long")
    return counted.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))


def _with_bits(known: np.ndarray, phrases: DataFrame) -> np.ndarray:
    """The filter with the phrases' bits set too. At most a 64th of ``FILTER_BITS`` rows come to the
    driver, however many phrases there are."""
    at = F.shiftright("hash", SIZE_BITS).bitwiseAND(F.lit(FILTER_BITS - 1).cast("long"))
    bit = F.expr("shiftleft(1L, cast(at & 63 as int))")
    set_bits = phrases.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word"))
    table = set_bits.agg(F.bit_or(bit).alias("bits")).toArrow()
    grown = known.copy()
    grown[table["word"].to_numpy()] |= table["bits"].to_numpy().view(np.uint64)
    return grown


def frequent_phrases(
    documents: DataFrame,
    min_count: int = 10,
    sample: float = 0.25,
    propose_from: int = 3,
    text_col: str = "text",
    lang_col: str = "lang",
) -> tuple[DataFrame, DataFrame]:
    """Exact counts of all phrases of up to 3 words with ``min_count`` occurrences, and of all words.

    Returns ``(lang, size, phrase, f)`` and ``(lang, n)``, n being a language's words with repeats.
    ``sample`` of the documents propose what occurs ``propose_from`` times among them; both only
    decide how much is left to later passes. There are three passes over all documents at most: words
    are all counted in the first one, pairs of frequent words by the second, triples by the third.
    """
    texts = pick(documents, text=text_col, lang=lang_col)
    texts = texts.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))
    nothing = np.zeros(FILTER_BITS // 64, np.uint64)
    proposed = count_hashes(texts.sample(sample, seed=13)).where(F.col("f") >= propose_from)
    known, before, likely = _with_bits(nothing, proposed), None, nothing
    for _ in range(2):
        counted = count_hashes(texts, known, before).where(F.col("f") >= min_count)
        counted = materialize(counted, "likely-phrases")
        likely = _with_bits(likely, counted)
        before, known = known, _with_bits(known, counted.where(F.col("hash").bitwiseAND(F.lit(3)) < 3))
        if np.array_equal(before, known):
            break
    # after two passes only triples of newly known pairs are left, which the last one counts as well
    found = count_texts(texts, likely, known, before)
    found = materialize(found.where((F.col("f") >= min_count) | (F.col("size") == 0)), "phrase-counts")
    words = found.where("size = 0 and f > 0").select("lang", F.col("f").alias("n"))
    return found.where("size > 0"), words


def collocations(
    documents: DataFrame, min_count: int = 10, top: int = 2000, absorbed_percent: int = 50, **columns
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's best phrases of 2 and 3 words.

    Cutting a phrase of ``a`` occurrences into parts of ``l`` and ``r`` scores a million times
    ``a * a / (l * r)``; its worst cut counts. Phrases inside a longer one that has at least
    ``absorbed_percent`` of their occurrences are left out. Null text is empty, null language is
    ``und``, an empty table gives no rows, repeated rows count again. Counts stay below 10**15, for
    which decimals hold the products exactly.
    """
    phrases, words = frequent_phrases(documents, min_count, **columns)
    known = phrases.select("lang", "phrase", "f")
    part = F.split("phrase", " ")
    many = phrases.where("size > 1").withColumn("w", part)
    pair, triple = many.where("size = 2"), many.where("size = 3")
    head, tail = F.concat_ws(" ", F.col("w")[0], F.col("w")[1]), F.concat_ws(" ", F.col("w")[1], F.col("w")[2])

    longer = triple.select("lang", F.explode(F.array(head, tail)).alias("phrase"), F.col("f").alias("longest"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("longest").alias("longest"))
    pair = pair.join(longer, ["lang", "phrase"], "left")
    pair = pair.where(F.coalesce(100 * F.col("longest") < absorbed_percent * F.col("f"), F.lit(True)))

    def cut(k: int, left, right):
        return F.struct(F.lit(k).alias("k"), left.alias("left"), right.alias("right"))

    two = pair.withColumn("cuts", F.array(cut(1, F.col("w")[0], F.col("w")[1])))
    three = triple.withColumn("cuts", F.array(cut(1, F.col("w")[0], tail), cut(2, head, F.col("w")[2])))
    columns = ["lang", "phrase", F.col("f").alias("a"), F.explode("cuts").alias("cut")]
    cuts = two.select(*columns).unionByName(three.select(*columns))
    cuts = cuts.select("lang", "phrase", "a", "cut.k", "cut.left", "cut.right")
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    a, left, right = (F.col(c).cast("decimal(15,0)") for c in ("a", "l", "r"))
    score = F.call_function("div", a * a * F.lit(1_000_000).cast("decimal(7,0)"), left * right)
    cuts = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    scored = cuts.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")

    best = [F.desc("score"), F.desc("a"), F.col("phrase")]
    # the best of each share first, so that no task sorts a whole language
    share = F.pmod(F.xxhash64("phrase"), F.lit(256))
    place = F.row_number().over(Window.partitionBy("lang", "share").orderBy(*best))
    scored = scored.withColumn("share", share).withColumn("place", place).where(F.col("place") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long").alias("rank")
    ranked = scored.select("lang", rank, "phrase", "a", "l", "r", "score").where(F.col("rank") <= top)
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
