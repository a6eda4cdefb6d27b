"""Collocations whatever the sample proposes, against plain Python; whole tables against SQL."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from awkward import awkward, nothing

from tidemark.llm import phrases


def plain(rows, min_count, top):
    """Collocations by their definition, rows are (text, lang)."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(x.lower() if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in (1, 2, 3):
                f[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        absorbed = {x for p, a in found.items() if len(p) == 3 for x in (p[:2], p[1:]) if 100 * a >= 50 * counts[x]}
        scored = []
        for p, a in found.items():
            if p not in absorbed:
                cuts = [(10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def mined(frame, **options):
    rows = phrases.collocations(frame, **options).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return sorted(tuple(r) for r in rows.collect())


@pytest.fixture(scope="module")
def expected(documents):
    return plain([tuple(r) for r in documents.select("text", "lang").collect()], 10, 2000)


@pytest.mark.parametrize(("sample", "least"), [(0.25, 2), (1e-9, 1), (0.02, 3), (1.0, 1)])
def test_no_sample_changes_the_result(documents, expected, sample, least):
    """From nothing proposed, where every frequent phrase is a failure of the border, to everything."""
    assert mined(documents, sample=sample, propose_from=least) == expected


def test_a_full_filter_changes_nothing(documents, expected, monkeypatch):
    monkeypatch.setattr(phrases, "FILTER_BITS", 64)
    assert mined(documents) == expected


def test_ranks_within_the_limit(documents):
    rows = [tuple(r) for r in documents.select("text", "lang").collect()]
    assert mined(documents, min_count=3, top=7) == plain(rows, 3, 7)


def test_takes_documents_as_they_come(spark):
    frame = awkward(spark)
    rows = [tuple(r) for r in frame.select("text", "lang").collect()]
    found = mined(frame, min_count=1)
    assert found == plain(rows, 1, 2000)
    assert any(r[0] == "und" for r in found) is False  # its only text is blank or null


def test_blanks_ends_and_unknown_language(spark):
    rows = [("a\tb  c. D e", None), ("a b c", None), ("a\vb", "x"), ("É é.é\x00f g", "x")]
    frame = spark.createDataFrame(rows, "text string, lang string")
    assert mined(frame, min_count=1) == plain(rows, 1, 2000)


def test_empty_table(spark):
    assert mined(nothing(spark)) == []


def test_products_past_64_bits(spark):
    a, left, right = 3 * 10**12, 4 * 10**12, 5 * 10**12
    row = spark.sql(f"SELECT {a}L a, {left}L l, {right}L r").selectExpr(
        "cast(a as decimal(15,0)) * cast(a as decimal(15,0)) * cast(1000000 as decimal(7,0))"
        " div (cast(l as decimal(15,0)) * cast(r as decimal(15,0)))"
    )
    assert row.first()[0] == 10**6 * a * a // (left * right)


def test_filters_hold_what_was_set(spark):
    hashes = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 5000, dtype=np.int64)
    frame = spark.createDataFrame([(int(h),) for h in hashes], "hash long")
    bits = phrases._with_bits(np.zeros(phrases.FILTER_BITS // 64, np.uint64), frame)
    assert phrases._in(bits, hashes.view(np.uint64)).all()
    assert phrases._in(bits, np.arange(10**6, dtype=np.uint64)).mean() < 0.01
