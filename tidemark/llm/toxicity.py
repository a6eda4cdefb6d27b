"""Toxicity scores of texts that are first restored from disguises by a noisy-channel decoder."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columns import pick, text_or_empty, text_slices
from tidemark.llm.fitting import fit_logistic, held_out, labelled_sample
from tidemark.sources.tables import materialize

#: Labelled documents of either label that the model is fitted to, at most.
SAMPLE = 10_000

# Letters that digits and marks often stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t",
}
#: Letters the character model tells apart; all others are one more.
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïñòóôõöøùúûüýÿœ"
SIZE = len(LETTERS) + 2  # 0: the edge of a word, the last: any other letter
#: Log probabilities of the channel.
STANDS_FOR, ADDED, SAME, DOUBLED = np.log(0.5), np.log(1e-4), np.log(0.98), np.log(0.02)
#: A mark between letters parts words or was added; a blank between spelled letters either.
PARTS, WITHIN, SPELLED = np.log(0.98), np.log(0.02), np.log(0.5)
#: A stand-in at the end that is seldom read as said, and one that mostly is.
SELDOM, MOSTLY = np.log(0.1), np.log(0.9)
#: Mean log probability a letter from which decoded words count as words.
PLAUSIBLE = -3.0

_CODE = {c: i + 1 for i, c in enumerate(LETTERS)}
_CODES = np.full(0x180, SIZE - 1, np.int64)
_CODES[: 0x80] = 0
for _c, _i in _CODE.items():
    _CODES[ord(_c)] = _i

# Kinds of bytes in lower-cased UTF-8: all beyond ASCII are letters here.
_LETTER, _DIGIT, _STAND_IN, _MARK, _BLANK = 1, 2, 4, 8, 16
_KIND = np.zeros(256, np.uint8)
for _b in range(256):
    _c = chr(_b)
    _KIND[_b] = (
        _LETTER * (_b >= 128 or _c.isalpha())
        | _DIGIT * _c.isdigit()
        | _STAND_IN * (_c in LEET and not _c.isdigit())
        | _MARK * (_c in ".-_*~")
        | _BLANK * (_c in " \t\n\r\v\f")
    )
_SPACED = re.compile(r"\S( \S)+\W?")
_APART = re.compile(r"[^\w@$!|+.\-*~]+")


def codes(text: str) -> np.ndarray:
    """Model letters of a lower-cased text; whatever is no letter is 0."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 0x180, _CODES[np.minimum(points, 0x17F)], SIZE - 1)


def fit_letters(documents: DataFrame, text_col: str = "text") -> np.ndarray:
    """Log probability of a letter after two others, from the words of all documents.

    Each task counts the trigrams of its documents, Spark adds the counts up; at most
    ``SIZE ** 3`` numbers reach the driver whatever the input is.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SIZE**3, np.int64)
        for batch in batches:
            for _, texts in text_slices(batch.column(0)):
                c = codes("  " + "  ".join(texts).lower() + "  ")
                grams = (c[:-2] * SIZE + c[1:-1]) * SIZE + c[2:]
                counts += np.bincount(grams, minlength=SIZE**3)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], ["gram", "n"])

    rows = documents.select(text_or_empty(text_col)).mapInArrow(count, "gram long, n long")
    found = rows.groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(SIZE**3)
    counts[found["gram"].to_numpy(np.int64)] = found["n"]
    counts = counts.reshape(SIZE, SIZE, SIZE)
    counts[0, 0, 0] = 0  # between words
    one = counts.sum(axis=(0, 1)) + 1.0
    two = counts.sum(axis=0) + 5.0 * one / one.sum()
    two /= two.sum(axis=1, keepdims=True)
    three = counts + 5.0 * two[None]
    return np.log(three / three.sum(axis=2, keepdims=True)).astype(np.float32)


def lattice(token: str, breaks: bool = False) -> list[list[tuple[str, float]]]:
    """What each part of a disguised word may stand for, with log probabilities.

    A run of one letter is that letter once or twice; a digit or mark is a letter it stands for or
    was added; blanks and other marks were added, or with ``breaks`` part words if they are inside.
    Stand-ins at the end may also be no part of the word, with ``breaks``.
    """
    steps: list[list[tuple[str, float]]] = []
    inside = len(token.rstrip("".join(LEET))) if breaks else len(token)
    for run in re.finditer(r"(.)\1*", token, re.DOTALL):
        c, n = run.group(1), len(run.group())
        if c in LEET:
            options = [(letter, STANDS_FOR) for letter in LEET[c]]
            left = ADDED
            if run.start() >= inside:
                usual = c in "!|+" or n > 2
                options = [(letter, chance + (SELDOM if usual else MOSTLY)) for letter, chance in options]
                left = MOSTLY if usual else SELDOM
            steps += [[*options, ("", left)]] if n > 2 else [[*options, ("", left)]] * n
        elif not c.isalpha():
            if breaks and steps and run.end() < inside:
                chances = (SPELLED, SPELLED) if c == " " else (PARTS, WITHIN)
                steps.append([(" ", chances[0]), ("", chances[1])])
        elif n == 1:
            steps.append([(c, 0.0)])
        else:
            steps.append([(c, SAME if n > 2 else DOUBLED), (c + c, DOUBLED if n > 2 else SAME)])
    return steps


def restore(token: str, letters: np.ndarray, breaks: bool = False) -> str:
    """The most probable word behind a disguised one (Viterbi over the last two letters), or words
    if the token may have ``breaks``."""
    paths: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
    for options in lattice(token, breaks):
        after: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (so_far, word) in paths.items():
            for text, chance in options:
                x, y, total = a, b, so_far + chance
                for c in text:
                    z = 0 if c == " " else _CODE.get(c, SIZE - 1)
                    total += letters[x, y, z]
                    x, y = y, z
                if (x, y) not in after or total > after[x, y][0]:
                    after[x, y] = (total, word + text)
        paths = after
    return max(((s + letters[a, b, 0], w) for (a, b), (s, w) in paths.items()))[1]


def plausible(words: str, letters: np.ndarray) -> bool:
    """Whether the letter model takes a text for words."""
    c = codes(f"  {words} ")
    return bool(letters[c[:-2], c[1:-1], c[2:]].mean() > PLAUSIBLE)


class Restorer:
    """Lower-cases texts and restores disguised words, remembering those it has seen."""

    def __init__(self, letters: np.ndarray):
        self.letters, self.known, self.pieces = letters, {}, {}

    def __call__(self, texts: Sequence[str | None]) -> list[str]:
        data = "\0\n".join((t or "").lower().replace("\0", " ") for t in texts)
        data = data.encode("utf-8", "surrogatepass")
        out, at = [], 0
        for start, end in suspects(data):
            out += [data[at:start], self._words(data[start:end])]
            at = end
        out.append(data[at:])
        return b"".join(out).decode("utf-8", "surrogatepass").split("\0\n")

    def _words(self, chunk: bytes) -> bytes:
        text = self.known.get(chunk)
        if text is None:
            if len(self.known) > 100_000:
                self.known.clear()
            words = chunk.decode("utf-8", "surrogatepass")
            if _SPACED.fullmatch(words):
                pieces = [" ".join(_APART.sub("", c) for c in words.split(" "))]
            else:
                pieces = _APART.split(words)
            found = " ".join(self._piece(w) for w in pieces).encode("utf-8", "surrogatepass")
            # text in which nothing was disguised stays as it is
            plain = found.translate(_LETTER_OR_BLANK).split() == chunk.translate(_LETTER_OR_BLANK).split()
            text = self.known[chunk] = chunk if plain else found
        return text

    def _piece(self, token: str) -> str:
        word = self.pieces.get(token)
        if word is None:
            if len(self.pieces) > 200_000:
                self.pieces.clear()
            word = restore(token, self.letters, breaks=True)
            # doubled letters, marks and blanks are common in plain text too
            if not any(c in LEET for c in token) and not plausible(word, self.letters):
                word = token
            self.pieces[token] = word
        return word


def suspects(data: bytes) -> list[tuple[int, int]]:
    """Where words may be disguised, as spans between blanks.

    Whatever has more than one reading: stand-ins for letters beside letters, doubled letters and
    marks between letters or stand-ins, in words with a letter; and three or more single
    characters between blanks, which make one span (with a mark after the last).
    """
    if len(data) < 3:
        return []
    x = np.frombuffer(data + b" \n \n \n ", np.uint8)
    kind = _KIND[x]
    n = len(data)

    def of(kinds: int, shift: int = 0) -> np.ndarray:
        return (kind[shift : shift + n] & kinds) != 0

    letter, other = of(_LETTER), of(_DIGIT | _STAND_IN)
    hit = (other & of(_LETTER, 1)) | (letter & of(_DIGIT | _STAND_IN, 1))
    hit |= (x[:n] == x[1 : n + 1]) & letter & (x[:n] < 128)
    hit |= (letter | other) & of(_MARK, 1) & of(_LETTER | _DIGIT | _STAND_IN, 2)

    blank = of(_BLANK) | (x[:n] == 0)
    edge = np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return []
    chosen = np.zeros(len(starts), bool)
    chosen[np.searchsorted(starts, np.flatnonzero(hit & ~blank), side="right") - 1] = True
    upto = np.concatenate([[0], np.cumsum(letter)])
    chosen &= upto[ends] > upto[starts]
    # single characters, one blank apart
    some = (kind[starts] & (_LETTER | _DIGIT | _STAND_IN)) != 0
    single = some & (ends - starts == 1)
    closed = some & (ends - starts == 2) & ((kind[starts + 1] & (_LETTER | _DIGIT | _STAND_IN)) == 0)
    joined = single[:-1] & (single | closed)[1:]
    joined &= (starts[1:] - ends[:-1] == 1) & (x[ends[:-1]] != ord("\n"))
    change = np.diff(np.concatenate([[False], joined, [False]]).astype(np.int8))
    firsts, lasts = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    long = lasts - firsts >= 2
    firsts, lasts = firsts[long], lasts[long]
    for first, last in zip(firsts, lasts):
        chosen[first : last + 1] = False
    picked = np.flatnonzero(chosen)
    spans = np.concatenate([starts[picked], starts[firsts]]), np.concatenate([ends[picked], ends[lasts]])
    order = np.argsort(spans[0])
    return list(zip(spans[0][order].tolist(), spans[1][order].tolist()))


_KEEP = np.array([(1 << 8 * i) - 1 for i in range(8)] + [2**64 - 1], np.uint64)
_LETTER_OR_BLANK = bytes(b if b >= 128 or bytes([b]).isalpha() else 32 for b in range(256))
#: Lengths in bytes of the beginnings of a word that are features beside the word itself.
_BEGINNINGS = (4, 5, 6, 7)
#: Word weights from which a word counts as evidence of some strength.
_STRENGTHS = (1.0, 2.0, 3.0, 4.0)
_EVIDENCE = 2 + 2 * len(_STRENGTHS)
#: Documents in which every feature is taken to have been seen without telling anything, and
#: documents of label 1 in which it has to be seen to have a weight.
PRIOR, SEEN = 12, 3


def word_features(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every word's features, one row per word, and the number of words per text.

    The features are the word (its first 16 bytes) and its beginnings.
    """
    parts = []
    sizes = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        words = text.encode("utf-8", "surrogatepass").translate(_LETTER_OR_BLANK).split()
        sizes[i] = len(words)
        parts += words
    out = np.empty((len(parts), 1 + len(_BEGINNINGS)), np.uint64)
    if not parts:
        return out, sizes
    lengths = np.array([len(w) for w in parts])
    data = np.frombuffer(b" ".join(parts) + b" " * 17, np.uint8)
    starts = np.cumsum(lengths + 1) - lengths - 1
    eights = np.lib.stride_tricks.as_strided(data[:8].view("<u8"), (len(data) - 7,), (1,))
    head, tail = eights[starts], eights[starts + 8]
    whole = (head & _KEEP[np.minimum(lengths, 8)]) * np.uint64(0x9E3779B97F4A7C15)
    whole ^= (tail & _KEEP[np.clip(lengths - 8, 0, 8)]) * np.uint64(0xC2B2AE3D27D4EB4F)
    begins = [head & _KEEP[np.minimum(lengths, k)] for k in _BEGINNINGS]
    for kind, value in enumerate((whole, *begins)):
        mixed = (value + np.uint64(kind + 1)) * np.uint64(0x165667B19E3779F9)
        mixed ^= mixed >> np.uint64(29)
        out[:, kind] = mixed * np.uint64(0x9E3779B97F4A7C15)
    return out, sizes


class WordWeights:
    """Log odds of features that occur more often in documents of label 1 than in those of 0.

    ``counts`` has the documents of either label with each feature, ``n`` all of either. The
    odds are as if the feature had been seen in some more documents in which it tells nothing.
    """

    def __init__(self, features: np.ndarray, counts: np.ndarray, n: np.ndarray):
        rate = (counts / n[:, None] if n.all() else 0 * counts) + PRIOR / max(1, n.sum())
        weights = np.log(rate[1]) - np.log(rate[0])
        kept = (weights > _STRENGTHS[0]) & (counts[1] >= SEEN)
        order = np.argsort(features[kept])
        self.features, self.weights = features[kept][order], weights[kept][order]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.features >> np.uint64(44)] = True

    def of(self, features: np.ndarray) -> np.ndarray:
        """The highest weight in each row, 0 if there is none."""
        out = np.zeros(len(features))
        rows, kinds = np.nonzero(self.maybe[features >> np.uint64(44)])
        if len(rows):
            asked = features[rows, kinds]
            at = np.minimum(np.searchsorted(self.features, asked), len(self.features) - 1)
            np.maximum.at(out, rows, np.where(self.features[at] == asked, self.weights[at], 0.0))
        return out

    def evidence(self, texts: Sequence[str]) -> np.ndarray:
        """Per text: its strongest word, its size, and number and share of words by strength."""
        features, sizes = word_features(texts)
        out = np.zeros((len(texts), _EVIDENCE))
        some = np.flatnonzero(sizes)
        if len(some):
            strength = self.of(features)
            firsts = (np.cumsum(sizes) - sizes)[some]
            out[some, 0] = np.maximum.reduceat(strength, firsts)
            out[some, 1] = np.log1p(sizes[some]) / 5
            for i, least in enumerate(_STRENGTHS):
                strong = np.add.reduceat((strength > least).astype(float), firsts)
                out[some, 2 + 2 * i] = np.log1p(strong)
                out[some, 3 + 2 * i] = 5 * np.sqrt(strong / sizes[some])
        return out


class ToxicityModel:
    """Character model, word weights and the logistic model of a document's evidence."""

    def __init__(self, letters: np.ndarray, words: WordWeights, logistic: np.ndarray):
        self.letters, self.words, self.logistic = letters, words, logistic

    def probability(self, restored: Sequence[str]) -> np.ndarray:
        x = np.column_stack([self.words.evidence(restored), np.ones(len(restored))])
        return 1 / (1 + np.exp(-np.clip(x @ self.logistic, -35, 35)))


def fit(
    documents: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> ToxicityModel:
    """A model of the labels; its character model is counted over all documents.

    Words are weighted by the log odds of occurring in documents of either label, among at most
    ``sample`` documents of each label (rows whose id is held out are not used). The sampled ids
    are broadcast, so no text is shuffled; the words' counts and the evidence of the sample reach the
    driver. With one label only, or none, all documents get about
    the same score.
    """
    letters = fit_letters(documents, text_col)
    chosen = labelled_sample(labels, label_col, sample, id_col)
    docs = pick(documents, doc_id=id_col, text=text_col).join(F.broadcast(chosen), "doc_id")
    half = F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)).cast("int").alias("half")
    restored = docs.select("label", half, _restored(letters)("text").alias("text"))
    restored = materialize(restored, "sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in text_slices(batch.column(2)):
                part = batch.slice(start, len(texts))
                features, sizes = word_features(texts)
                kind = part.column(0).to_numpy() * 2 + part.column(1).to_numpy()
                for k in np.unique(kind):
                    own = np.flatnonzero(kind == k)
                    ends = np.cumsum(sizes)
                    once = [np.unique(features[ends[i] - sizes[i] : ends[i]]) for i in own]
                    seen, n = np.unique(np.concatenate(once), return_counts=True)
                    kinds = pa.array(np.full(len(seen), k), pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(seen.view(np.int64)), kinds, pa.array(n)], ["feature", "kind", "n"]
                    )

    totals = np.zeros((2, 2))  # by label and half
    for row in restored.groupBy("label", "half").count().collect():
        totals[row["label"], row["half"]] = row["count"]
    rows = restored.select("label", "half", "text")
    rows = rows.mapInArrow(count, "feature long, kind int, n long").groupBy("feature")
    kinds = [F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(4)]
    found = rows.agg(*kinds).where(F.col("n2") + F.col("n3") >= SEEN).toPandas()
    features = found["feature"].to_numpy(np.int64).view(np.uint64)
    counts = found[["n0", "n1", "n2", "n3"]].to_numpy(float).T.reshape(2, 2, -1)
    words = WordWeights(features, counts.sum(axis=1), totals.sum(axis=1))
    # evidence of each half by the words of the other, so that none speaks for itself
    halves = [WordWeights(features, counts[:, 1 - h], totals[:, 1 - h]) for h in (0, 1)]

    def of_other(half: pd.Series, texts: pd.Series) -> pd.Series:
        out = np.zeros((len(texts), _EVIDENCE))
        for h in (0, 1):
            own = np.flatnonzero(half.to_numpy() == h)
            out[own] = halves[h].evidence(texts.iloc[own].tolist())
        return pd.Series(list(out))

    evidence = F.pandas_udf(of_other, "array<double>")
    rows = restored.select("label", evidence("half", "text").alias("x")).toPandas()
    x = np.array(rows["x"].tolist()).reshape(-1, _EVIDENCE)
    order = np.lexsort((*x.T, rows["label"].to_numpy()))
    x, y = np.column_stack([x, np.ones(len(x))])[order], rows["label"].to_numpy(np.int64)[order]
    n = totals.sum(axis=1)
    known = labels.where(F.col(label_col).isin(0, 1) & ~held_out(id_col))
    share = float(known.agg((F.sum(label_col) + 1) / (F.count("*") + 2)).first()[0] or 0.5)
    logistic = fit_logistic(x, y, ridge=0.1)
    if n.all():  # the sample has its own share of toxic ones
        logistic[-1] += np.log(share / (1 - share)) - np.log(n[1] / n[0])
    return ToxicityModel(letters, words, logistic)


def _restored(letters: np.ndarray):
    held: list[Restorer] = []

    def run(texts: pa.Array) -> pa.Array:
        if not held:
            held.append(Restorer(letters))
        parts = [pa.array(held[0](part), pa.string()) for _, part in text_slices(texts)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    return F.arrow_udf(run, "string")


def restored_texts(documents: DataFrame, letters: np.ndarray, text_col: str = "text") -> DataFrame:
    """The documents with a column ``restored``: lower-cased, disguised words decoded; empty for a
    null text."""
    return documents.withColumn("restored", _restored(letters)(text_col))


def score(documents: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """The documents with ``score``, the probability that the restored text is toxic.

    Null and empty texts are scored as texts without any word. All rows and columns are kept, an
    input column ``score`` is replaced."""
    held: list[Restorer] = []

    def run(texts: pa.Array) -> pa.Array:
        if not held:
            held.append(Restorer(model.letters))
        out = np.zeros(len(texts))
        for start, part in text_slices(texts):
            out[start : start + len(part)] = model.probability(held[0](part))
        return pa.array(out)

    return documents.withColumn("score", F.arrow_udf(run, "double")(text_col))
