"""The audit of sources on small tables against plain Python; whole tables are compared with SQL."""

import re
from collections import Counter, defaultdict

import pytest
from awkward import awkward, nothing

from tidemark.llm import divergence


def plain(rows, min_docs, top):
    """The audit by its definition, rows are (text, lang, source)."""
    counts, docs, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in ((a or "", b or "", c or "") for a, b, c in rows):
        lowered = "".join(x.lower() if "A" <= x <= "Z" else x for x in text)
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
        sources[lang].add(source)
    out = set()
    for lang, names in sources.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        v = len(kept)

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * v) for t in kept}

        whole = sum((counts[lang, s] for s in names), Counter())
        q, p = shares(whole), {s: shares(counts[lang, s]) for s in names}
        for s in names:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept), o) for o in names if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // (p[s][t] + q[t]), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                ranked = list(enumerate(items, 1))[: None if part == "pair" else top]
                out |= {(lang, s, part, item, value, rank) for rank, (value, item) in ranked}
    return out


def audited(frame, **options):
    rows = divergence.source_divergence(frame, **options).select("lang", "source", "part", "item", "value", "rank")
    rows = [tuple(r) for r in rows.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_equals_its_definition(documents):
    rows = [tuple(r) for r in documents.select("text", "lang", "source").collect()]
    assert audited(documents, min_docs=3, top_terms=4) == plain(rows, 3, 4)


def test_small_shards_and_blocks_change_nothing(documents, monkeypatch):
    rows = [tuple(r) for r in documents.select("text", "lang", "source").collect()]
    monkeypatch.setattr(divergence, "SHARD_CELLS", 50)
    monkeypatch.setattr(divergence, "SOURCE_BLOCK", 2)
    assert audited(documents, min_docs=5) == plain(rows, 5, 10)


@pytest.mark.parametrize("least", [1, 100])
def test_takes_documents_as_they_come(spark, least):
    frame = awkward(spark)
    rows = [tuple(r) for r in frame.select("text", "lang", "source").collect()]
    found = audited(frame, min_docs=least)
    assert found == plain(rows, least, 10)
    if least == 100:  # no term is kept: pairs of value zero, no terms
        assert {r[2] for r in found} == {"pair"} and {r[4] for r in found} == {0}


def test_empty_table(spark):
    assert audited(nothing(spark)) == set()


def test_long_counts_stay_exact(spark):
    count = 3_000_000_000_000
    one = spark.sql(f"SELECT {count}L AS n, {2 * count + 1}L AS words, 7L AS terms")
    share = one.select(divergence.share(one.n, one.words, one.terms)).first()[0]
    assert share == 1 + 10**9 * (count + 2) // (2 * count + 1 + 14)
