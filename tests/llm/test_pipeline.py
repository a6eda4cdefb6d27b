"""Every stage against brute force on its own input, and the whole run."""

import re

import pytest
from pyspark.sql import functions as F
from test_decontaminate import plain_found, plain_windows
from test_lines import plain_removed
from test_simhash import plain_components, plain_print

import __spark_entry__ as registry
import corpus_pipeline
from tidemark.sources.tables import materialize


@pytest.fixture(scope="module")
def after(spark, sf_dir):
    """What goes into each stage and, last, what comes out of the last."""
    frames = [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(materialize(stage(spark, frames[-1], sf_dir), f"test-{name}"))
    return frames


def texts_of(frame):
    return sorted((r.doc_id, r.text) for r in frame.select("doc_id", "text").collect())


def test_stages_and_their_columns(after):
    assert [f.columns for f in after[1:-1]] == [after[0].columns] * 4
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "language" and len(corpus_pipeline.STAGES) == 5
    for frame in after[1:-1]:
        assert frame.where(F.col("n_chars") != F.length("text")).count() == 0


def test_language_stage_keeps_documents_of_known_languages(after):
    before, kept = texts_of(after[0]), texts_of(after[1])
    assert set(kept) <= set(before)
    assert {t for t in before if re.search(r"[^\W\d_]{3}", t[1] or "")} == set(kept)


def test_line_stage(after):
    """Against edit similarity alone: nothing else goes, and of what should go nearly all."""
    texts = texts_of(after[1])
    should = {(doc, i) for doc, gone in plain_removed(texts, short=True).items() for i in gone}
    out, went = dict(texts_of(after[2])), set()
    assert set(out) == {doc for doc, _ in texts}
    for doc, text in texts:
        left = out[doc].split("\n")
        for i, line in enumerate(text.split("\n")):
            if left and left[0] == line:
                left.pop(0)
            else:
                went.add((doc, i))
        assert not left or left == [""]
    # of equal lines in a row it cannot be seen which one went
    assert len(went) >= 0.95 * len(should) and len(went - should) <= 0.02 * len(should)


def test_near_duplicate_stage(after):
    texts = texts_of(after[2])
    roots = plain_components([plain_print(t) for _, t in texts])
    assert texts_of(after[3]) == [texts[i] for i in sorted(set(roots))]


def test_benchmark_stage(spark, sf_dir, after):
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    windows = plain_windows(items, 13)
    out = dict(texts_of(after[4]))
    for doc, text in texts_of(after[3]):
        n, hit, _ = plain_found(text, windows)
        if not hit or 20 * len(hit) < n:
            assert out[doc] == text
        elif doc in out:
            rest, still, _ = plain_found(out[doc], windows)
            assert not still and rest == n - len(hit)
        else:
            assert 2 * len(hit) >= n


def test_mixing_stage(after):
    rows = after[5].collect()
    sizes = {doc: len((text or "").split()) for doc, text in texts_of(after[4])}
    taken, largest = {}, {}
    for row in rows:
        taken[row.source] = taken.get(row.source, 0) + row.size
        assert row.size == sizes[row.doc_id] and 1 <= row.repetition <= 3
    for row in after[4].select("doc_id", "source").collect():
        largest[row.source] = max(largest.get(row.source, 0), sizes[row.doc_id])
    for row in {(r.source, r.target) for r in rows}:
        assert abs(taken[row[0]] - row[1]) <= largest[row[0]] / 2 + 1e-6


def test_run_gives_the_same(spark, sf_dir, after):
    run = registry.queries()["pipeline"](spark, sf_dir)
    columns = ["doc_id", "text", "repetition"]
    assert run.select(columns).exceptAll(after[5].select(columns)).isEmpty()
    assert run.count() == after[5].count()


def test_registered():
    names = registry.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and "pipeline" not in registry.oracle_sql()
