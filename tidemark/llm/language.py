"""Language identification by Bayesian fusion of text, markup, address suffix and host priors."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columns import text_or_empty, text_slices
from tidemark.sources.tables import materialize

LANGUAGES = ("de", "en", "es", "fr")
UNDETERMINED = "und"

# Country suffixes of addresses whose pages are mostly in one language.
SUFFIX_LANGUAGE = {
    "at": "de", "au": "en", "ar": "es", "cl": "es", "co": "es", "de": "de", "es": "es",
    "fr": "fr", "ie": "en", "mx": "es", "nz": "en", "pe": "es", "uk": "en", "us": "en",
}

BUCKETS = 1 << 16
#: A text's evidence counts as that of at most so many independent trigrams.
EFFECTIVE_TRIGRAMS = 20
#: Log probability of any trigram in a text of no language.
LOG_NO_LANGUAGE = -15 * np.log(2)
#: Log odds that a text without letters is of no language.
NO_LETTERS = 20.0
#: Weight, in documents, of the wider group's shares in those of a host, domain or suffix.
SMOOTHING = 5.0

_BLANK = bytes(b if b >= 128 or bytes([b]).isalpha() else 32 for b in range(256))


def _trigrams(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte trigrams of lower-cased letters and blanks, text after text, and their number
    in each text. Words are set between single blanks, so a trigram shows where a word ends."""
    parts = []
    for text in texts:
        words = text.lower().encode("utf-8", "surrogatepass").translate(_BLANK).split()
        parts.append(b" " + b" ".join(words) + b" " if words else b"")
    sizes = np.array([max(0, len(p) - 2) for p in parts], np.int64)
    data = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint32)
    if not sizes.any():
        return np.zeros(0, np.int64), sizes
    hashed = (data[:-2] * 0x9E3779B1) + (data[1:-1] * 0x85EBCA6B) + (data[2:] * 0xC2B2AE35)
    hashed ^= hashed >> 15
    hashed *= np.uint32(0x2C1B3C6D)
    ends = np.cumsum([len(p) for p in parts])
    inside = np.ones(len(hashed), bool)
    for back in (1, 2):  # those that reach into the next text
        at = ends - back
        inside[at[(at >= 0) & (at < len(hashed))]] = False
    return (hashed >> 16)[inside].astype(np.int64), sizes


def fit_text_model(
    documents: DataFrame, text_col: str, label_col: str, languages: Sequence[str] = LANGUAGES
) -> np.ndarray:
    """Log probability of each trigram bucket per language, ``BUCKETS`` rows, from all documents.

    Each task counts its documents' trigrams per declared language; the counts of all tasks are
    added up by Spark. The result has one number per bucket and language whatever the input is.
    """
    code = {language: i for i, language in enumerate(languages)}
    k = len(languages)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(k * BUCKETS, np.int64)
        for batch in batches:
            codes = np.array([code[x] for x in batch.column(1).to_pylist()], np.int64)
            for start, texts in text_slices(batch.column(0)):
                hashed, sizes = _trigrams(texts)
                own = np.repeat(codes[start : start + len(texts)], sizes)
                counts += np.bincount(hashed + own * BUCKETS, minlength=k * BUCKETS)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], ["bucket", "n"])

    label = primary_language(F.col(label_col))
    rows = documents.select(text_or_empty(text_col), label).where(label.isin(*languages))
    summed = rows.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = summed.toPandas()  # at most one row per bucket and language
    counts = np.zeros(k * BUCKETS)
    counts[found["bucket"].to_numpy(np.int64)] = found["n"]
    counts = counts.reshape(k, BUCKETS)
    shared = (counts.sum(axis=0) + 0.01) / (counts.sum() + 0.01 * BUCKETS)
    weight = 100.0
    return np.log((counts + weight * shared) / (counts.sum(axis=1, keepdims=True) + weight)).T


def text_evidence(model: np.ndarray, text_col: str) -> Column:
    """Log likelihoods of a text under each language and, last, under none."""
    k = model.shape[1]
    table = np.ascontiguousarray(model.T.astype(np.float32))

    def score(texts: pa.Array) -> pa.Array:
        out = np.zeros((len(texts), k + 1))
        for start, part in text_slices(texts):
            hashed, sizes = _trigrams(part)
            some = np.flatnonzero(sizes)
            rows = start + some
            firsts = (np.cumsum(sizes) - sizes)[some]
            used = np.minimum(sizes, EFFECTIVE_TRIGRAMS)[some]
            for language in range(k if len(some) else 0):
                sums = np.add.reduceat(table[language][hashed], firsts, dtype=np.float64)
                out[rows, language] = sums / sizes[some] * used
            out[rows, k] = LOG_NO_LANGUAGE * used
            out[start + np.flatnonzero(sizes == 0), k] = NO_LETTERS
        return pa.FixedSizeListArray.from_arrays(out.ravel(), k + 1).cast(pa.list_(pa.float64()))

    return F.arrow_udf(score, "array<double>").asNondeterministic()(text_or_empty(text_col))


def primary_language(tag: Column) -> Column:
    """The first part of a language tag such as ``en-GB``, lower-cased."""
    return F.regexp_extract(F.lower(tag), "^\\s*([a-z]+)", 1)


def host_of(url: Column) -> Column:
    """Lower-cased host of an address, empty if it has none."""
    return F.lower(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))


def softmax(logs: Column) -> Column:
    """Probabilities in proportion to the exponentials of an array of logs."""
    top = F.array_max(logs)
    powers = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(powers, lambda x: x / F.aggregate(powers, F.lit(0.0), lambda s, y: s + y))


def _sum_of(array: str, size: int) -> Column:
    return F.array(*[F.sum(F.element_at(array, i + 1)) for i in range(size)])


def _smoothed(counts: str, wider: str) -> Column:
    """Shares of the counts with ``SMOOTHING`` documents that have the shares of the wider group."""
    total = F.aggregate(counts, F.lit(0.0), lambda s, x: s + x) + SMOOTHING
    return F.zip_with(counts, wider, lambda n, p: (n + SMOOTHING * p) / total)


def host_priors(evidence: DataFrame, size: int) -> DataFrame:
    """Smoothed shares of languages per host, ``(host, prior)``.

    ``evidence`` has ``host`` and ``shares``, a text's probabilities. Shares are summed per host;
    a host is smoothed with its domain, a domain with its suffix, a suffix with all documents.
    """
    labels = F.split("host", "\\.")
    hosts = evidence.groupBy("host").agg(_sum_of("shares", size).alias("n"))
    hosts = hosts.withColumn("suffix", F.element_at(labels, -1))
    domain = F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2))
    hosts = materialize(hosts.withColumn("domain", domain), "hosts")
    domains = hosts.groupBy("domain", "suffix").agg(_sum_of("n", size).alias("n"))
    domains = materialize(domains, "domains")
    suffixes = materialize(domains.groupBy("suffix").agg(_sum_of("n", size).alias("n")), "suffixes")
    counts = suffixes.agg(_sum_of("n", size).alias("n")).first()["n"]
    total = sum(x or 0.0 for x in counts) + size
    overall = F.array(*[F.lit(((x or 0.0) + 1) / total) for x in counts])

    suffixes = suffixes.withColumn("overall", overall)
    suffixes = suffixes.select("suffix", _smoothed("n", "overall").alias("wider"))
    domains = domains.join(suffixes, "suffix").select("domain", _smoothed("n", "wider").alias("wider"))
    hosts = hosts.join(domains, "domain").select("host", _smoothed("n", "wider").alias("prior"))
    return materialize(hosts, "priors")


def identify(
    documents: DataFrame,
    text_col: str = "text",
    declared_col: str | None = None,
    host: Column | None = None,
    languages: Sequence[str] = LANGUAGES,
    model: np.ndarray | None = None,
) -> DataFrame:
    """The documents with ``language`` and ``confidence``, its probability.

    The probability of a language is in proportion to the product of the likelihood of the text
    (a trigram model, ``fit_text_model``; by default fitted to the declared languages), of the
    declared language, of the host's suffix if it is a country's, and the host's prior. Beside
    the ``languages`` there is "und", no language, as whose model all trigrams are equally
    likely. How often a declaration is right is counted over all documents, by language, against
    the text's own probabilities, and so are the hosts' priors.

    Null, empty and letterless texts are "und". Missing or unknown declarations and missing hosts
    are no evidence. All rows and columns are kept; input columns ``language`` and ``confidence``
    are replaced. An empty table gives an empty result.

    The texts are read twice (three times to fit) and shuffled only if the table of host priors
    is too large for Spark to broadcast.
    """
    size = len(languages) + 1
    declared = F.lit("") if declared_col is None else F.coalesce(primary_language(F.col(declared_col)), F.lit(""))
    host = F.lit("") if host is None else F.coalesce(host, F.lit(""))
    if model is None:
        model = fit_text_model(documents, text_col, declared_col, languages)
    rows = documents.withColumns(
        {"__text": text_evidence(model, text_col), "__declared": declared, "__host": host}
    )
    evidence = rows.select("__declared", F.col("__host").alias("host"), "__text")
    evidence = evidence.select("__declared", "host", softmax(F.col("__text")).alias("shares"))
    evidence = materialize(evidence, "evidence")
    priors = host_priors(evidence, size)

    known = evidence.where(F.col("__declared").isin(*languages)).groupBy("__declared")
    right = {r["__declared"]: r["n"] for r in known.agg(_sum_of("shares", size).alias("n")).collect()}
    counts = np.array([right.get(x, [0.0] * size) for x in languages]) + 0.5  # declared, actual
    counts += 5 * np.eye(size)[:-1]
    likely = np.log(counts / counts.sum(axis=0))
    says = F.create_map(*[F.lit(x) for p in zip(languages, map(_array, likely)) for x in p])
    suffix = F.element_at(F.split("__host", "\\."), -1)
    at = {s: _array(_suffix_evidence(x, languages)) for s, x in SUFFIX_LANGUAGE.items() if x in languages}
    places = F.create_map(*[F.lit(x) for p in at.items() for x in p]) if at else None

    none = _array([0.0] * size)
    priors = priors.withColumnsRenamed({"host": "__host", "prior": "__prior"})
    rows = rows.drop("language", "confidence").join(priors, "__host")
    parts = [F.coalesce(F.try_element_at(says, F.col("__declared")), none)]
    if places is not None:
        parts.append(F.coalesce(F.try_element_at(places, suffix), none))
    parts.append(F.transform("__prior", lambda p: F.log(p)))
    logs = F.col("__text")
    for part in parts:
        logs = F.zip_with(logs, part, lambda x, y: x + y)
    rows = rows.withColumn("__posterior", softmax(logs))
    best = F.array_max("__posterior")
    names = F.array(*[F.lit(x) for x in (*languages, UNDETERMINED)])
    rows = rows.withColumn("confidence", best).withColumn(
        "language", F.element_at(names, F.array_position("__posterior", best).cast("int"))
    )
    return rows.drop("__text", "__declared", "__host", "__prior", "__posterior")


def _array(values) -> Column:
    return F.array(*[F.lit(float(x)) for x in values])


def _suffix_evidence(language: str, languages: Sequence[str]) -> list[float]:
    """A country's suffix is taken to be ten times as likely with its language as with others."""
    return [np.log(10.0) if x == language else 0.0 for x in (*languages, UNDETERMINED)]


def identified(documents: DataFrame, least: float = 0.5, **options) -> DataFrame:
    """The documents whose language is known with probability ``least``, in their own columns."""
    rows = identify(documents, **options)
    rows = rows.where((F.col("language") != UNDETERMINED) & (F.col("confidence") >= least))
    return rows.select(*documents.columns)


def page_text(html: Column) -> Column:
    """A page without scripts, styles, comments and tags."""
    no_code = F.regexp_replace(html, "(?is)<(script|style)\\b.*?</\\1\\s*>|<!--.*?-->", " ")
    return F.regexp_replace(no_code, "<[^>]*>", " ")


def markup_language(html: Column) -> Column:
    """The language that a page's html tag declares, empty if none."""
    return F.regexp_extract(html, "(?i)<html\\b[^>]*?\\blang\\s*=\\s*[\"']?([A-Za-z-]+)", 1)
