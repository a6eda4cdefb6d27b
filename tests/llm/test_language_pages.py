"""The registered language query over whole pages, its posterior worked out again by hand."""

import math
import re
from collections import defaultdict

import pytest

from tidemark.llm import queries

LANGUAGES = ["de", "en", "es", "fr"]
SUFFIX = {"de": "de", "at": "de", "fr": "fr", "es": "es", "uk": "en", "us": "en", "au": "en", "mx": "es"}


def trigrams(text):
    data = bytes(b if b >= 128 or bytes([b]).isalpha() else 32 for b in text.lower().encode()).split()
    data = b" " + b" ".join(data) + b" " if data else b""
    out = []
    for a, b, c in zip(data, data[1:], data[2:]):
        h = (a * 0x9E3779B1 + b * 0x85EBCA6B + c * 0xC2B2AE35) % 2**32
        h ^= h >> 15
        out.append((h * 0x2C1B3C6D % 2**32) >> 16)
    return out


def normal(logs):
    powers = [math.exp(x - max(logs)) for x in logs]
    return [p / sum(powers) for p in powers]


def plain(pages):
    """``page_id`` to (language, confidence) by Bayes' rule over all pages."""
    rows = []
    for page, url, markup in pages:
        text = re.sub(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ", markup or "")
        tag = re.search(r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", markup or "")
        host = re.search(r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", url or "")
        declared = re.match(r"[a-z]*", tag[1].lower())[0] if tag else ""
        rows.append((page, trigrams(re.sub("<[^>]*>", " ", text)), declared, host[1].lower() if host else ""))
    counts = {x: defaultdict(int) for x in LANGUAGES}
    for _, found, declared, _ in rows:
        if declared in counts:
            for t in found:
                counts[declared][t] += 1
    totals = {x: sum(counts[x].values()) for x in LANGUAGES}
    everything = sum(totals.values())

    def shared(t):
        return (sum(counts[x][t] for x in LANGUAGES) + 0.01) / (everything + 0.01 * 65536)

    texts = []
    for _, found, _, _ in rows:
        used = min(len(found), 20)
        logs = []
        for x in LANGUAGES:
            total = sum(math.log((counts[x].get(t, 0) + 100 * shared(t)) / (totals[x] + 100)) for t in found)
            logs.append(total / len(found) * used if found else 0.0)
        texts.append([*logs, -15 * math.log(2) * used if found else 20.0])
    shares = [normal(t) for t in texts]
    groups = defaultdict(lambda: [0.0] * 5)
    for (_, _, _, host), share in zip(rows, shares):
        labels = host.split(".")
        for name in {("all",), ("suffix", labels[-1]), ("domain", ".".join(labels[-2:])), ("host", host)}:
            groups[name] = [a + b for a, b in zip(groups[name], share)]

    def smooth(count, wider):
        return [(n + 5 * p) / (sum(count) + 5) for n, p in zip(count, wider)]

    overall = [(n + 1) / (sum(groups["all",]) + 5) for n in groups["all",]]
    right = {x: [0.5 + 5 * (i == j) for j in range(5)] for i, x in enumerate(LANGUAGES)}
    for (_, _, declared, _), share in zip(rows, shares):
        if declared in right:
            right[declared] = [a + b for a, b in zip(right[declared], share)]
    actual = [sum(right[x][j] for x in LANGUAGES) for j in range(5)]
    out = {}
    for (page, _, declared, host), logs in zip(rows, texts):
        labels = host.split(".")
        prior = smooth(groups["suffix", labels[-1]], overall)
        prior = smooth(groups["domain", ".".join(labels[-2:])], prior)
        prior = smooth(groups["host", host], prior)
        logs = [a + math.log(p) for a, p in zip(logs, prior)]
        if declared in right:
            logs = [a + math.log(r / n) for a, r, n in zip(logs, right[declared], actual)]
        if labels[-1] in SUFFIX:
            at = LANGUAGES.index(SUFFIX[labels[-1]])
            logs[at] += math.log(10)
        posterior = normal(logs)
        best = max(range(5), key=posterior.__getitem__)
        out[page] = ([*LANGUAGES, "und"][best], posterior[best])
    return out


def checked(spark, folder, pages):
    expected = plain(pages)
    found = {r.page_id: r for r in queries.op9_language(spark, folder).collect()}
    assert found.keys() == expected.keys()
    for page, (language, confidence) in expected.items():
        assert found[page].language == language and found[page].confidence == pytest.approx(confidence, abs=1e-3)
    return expected


def test_query_over_the_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    found = checked(spark, sf_dir, [(r.page_id, r.url, r.html) for r in rows])
    assert len({x for x, _ in found.values()}) == 4


def test_evidence_that_disagrees(spark, sf_dir, tmp_path):
    """Wrong and missing declarations, country suffixes, hosts of many pages and pages without text."""
    given = spark.read.parquet(f"{sf_dir}/pages.parquet").limit(30).collect()
    pages = [(i, f"http://news.example.{['fr', 'com', 'uk'][i % 3]}/{i}", r.html) for i, r in enumerate(given)]
    tags = ["", ' lang="fr"', " lang='en-GB'", ' lang="zz"']
    pages = [(i, url, re.sub(r'<html lang="\w+">', f"<html{tags[i % 4]}>", markup)) for i, url, markup in pages]
    pages += [(100, "http://a.de", "<p>1 2 3</p>"), (101, None, "the and of"), (102, "mailto:x", ""), (103, "http://b.es/", None)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    frame.write.parquet(f"{tmp_path}/pages.parquet")
    checked(spark, str(tmp_path), pages)
