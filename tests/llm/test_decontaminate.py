import hashlib
import random
import re

from awkward import awkward, nothing
from pyspark.sql import functions as F

from tidemark.llm import decontaminate as d
from tidemark.llm import queries


def plain_words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain_windows(items, window):
    windows = {}
    for item, text in items:
        words = plain_words(text)
        for start in range(max(0 if not words else 1, len(words) - window + 1)):
            windows.setdefault(tuple(words[start : start + window]), set()).add(item)
    return windows


def plain_found(text, windows):
    words, hit, items = plain_words(text), set(), set()
    for size in {len(w) for w in windows}:
        for start in range(len(words) - size + 1):
            found = windows.get(tuple(words[start : start + size]))
            if found:
                hit.update(range(start, start + size))
                items |= found
    return len(words), hit, items


def test_query_equals_looking_up_every_window(spark, sf_dir, texts):
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    windows = plain_windows(items, 13)
    expected = {}
    for doc, text in texts:
        n, hit, ids = plain_found(text, windows)
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        expected[doc] = (doc, n, len(hit), len(ids), digest, bool(hit) and 20 * len(hit) >= n)
    found = {r.doc_id: tuple(r) for r in queries.op4_decontamination(spark, sf_dir).collect()}
    assert found == expected
    assert any(e[-1] for e in expected.values())


def test_automaton_finds_what_brute_force_finds():
    chance = random.Random(5)
    for _ in range(300):
        items = [
            (str(i), " ".join(chance.choice("abc") for _ in range(chance.randint(0, 9))))
            for i in range(chance.randint(0, 6))
        ]
        text = " ".join(chance.choice("abcd") for _ in range(chance.randint(0, 40)))
        window = chance.randint(1, 5)
        automaton = d.SuffixAutomaton([(i, d.words_of(t)) for i, t in items], window)
        spans, ids, longest = automaton.matches(d.words_of(text))
        n, hit, expected = plain_found(text, plain_windows(items, window))
        assert ids == expected
        assert {p for a, b in spans for p in range(a, b)} == hit
        assert all(x[1] < y[0] for x, y in zip(spans, spans[1:]))
        runs = {tuple(w[a:b]) for _, t in items for w in [t.split()] for a in range(len(w)) for b in range(a + 1, len(w) + 1)}
        words = text.split()
        assert longest == max((len(r) for r in runs if any(tuple(words[i : i + len(r)]) == r for i in range(n))), default=0)


def test_blocks_and_pieces_change_nothing(spark, monkeypatch):
    chance = random.Random(6)
    long = " ".join(f"w{chance.randint(0, 500)}" for _ in range(3000))
    items = [(1, long), (2, "one short item"), (3, None), (4, ""), (None, "no id at all here"), (2, "second text of two")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    words = long.split()
    docs = [
        (1, "x " + " ".join(words[990:1030]) + " y one short item z"),
        (2, "second text of two, no id at all here"),
        (3, " ".join(words[5:17])),
    ]
    documents = spark.createDataFrame(docs, "doc_id long, text string")
    whole = d.find_contamination(documents, benchmark).orderBy("doc_id").collect()
    monkeypatch.setattr(d, "BLOCK_WORDS", 700)
    monkeypatch.setattr(d, "PIECE_WORDS", 50)
    parts = d.find_contamination(documents, benchmark).orderBy("doc_id").collect()
    assert [(r.found.n_words, r.found.spans, r.found["items"]) for r in whole] == [
        (r.found.n_words, r.found.spans, r.found["items"]) for r in parts
    ]
    assert whole[0].found.spans == [[1, 41], [42, 45]] and whole[0].found["items"] == ["1", "2"]
    assert whole[1].found.spans == [[0, 9]] and whole[1].found["items"] == ["2"]
    assert whole[2].found.spans == []


def test_removal(spark):
    item = " ".join(f"b{i}" for i in range(20))
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    prose = " ".join(f"p{i}" for i in range(100))
    docs = [
        (1, f"{prose} {item.upper()}, {prose}."),
        (2, item),
        (3, " ".join([prose] * 10) + " " + item),
        (4, prose),
        (5, None),
    ]
    documents = spark.createDataFrame(docs, "doc_id long, text string")
    kept = {r.doc_id: r.text for r in d.decontaminate(documents, benchmark).collect()}
    assert kept == {1: f"{prose} , {prose}.", 3: docs[2][1], 4: prose, 5: None}


def test_awkward_rows(spark):
    documents = awkward(spark)
    benchmark = spark.createDataFrame([(7, "quick brown fox")], "item_id long, text string")
    rows = d.find_contamination(documents, benchmark).select("doc_id", "found.*", d.n_hit().alias("hit"))
    found = rows.collect()
    assert len(found) == 12
    assert sum(r.hit for r in found) == 6
    kept = d.decontaminate(documents, benchmark)
    assert kept.columns == documents.columns and kept.count() == 12
    assert kept.where(F.col("text").contains("quick")).count() == 0
    assert d.find_contamination(nothing(spark), benchmark).count() == 0
    empty = d.find_contamination(documents, benchmark.where("false")).select("found.*").collect()
    assert {r.longest for r in empty} == {0}


def test_equal_and_long_items_keep_every_block_within_its_bound(spark, monkeypatch):
    """A third of the benchmark is one row over and over, and one item is longer than a block."""
    chance = random.Random(8)
    monkeypatch.setattr(d, "BLOCK_WORDS", 2000)
    monkeypatch.setattr(d, "PIECE_WORDS", 100)

    def prose(n):
        return " ".join(f"w{chance.randint(0, 900)}" for _ in range(n))

    same_text, long = prose(60), prose(5000)
    items = [(9000, same_text)] * 200 + [(i, prose(40)) for i in range(400)] + [(9001, long)]
    benchmark = spark.createDataFrame(items, "item string, text string")
    pieces, blocks = d._dealt(benchmark, 13)
    sizes = [sum(len(d.words_of(r.text)) for r in pieces.where(f"block = {b}").collect()) for b in range(blocks)]
    assert blocks > 8 and max(sizes) <= 2000 + 2 * 112 and min(sizes) > 0
    assert pieces.where("item = 9000").count() == 1
    docs = [(1, same_text), (2, prose(30) + " " + " ".join(long.split()[2000:2400])), (2, "nothing"), (None, None)]
    documents = spark.createDataFrame(docs, "doc_id long, text string")
    parts = d.find_contamination(documents, benchmark, item_col="item").orderBy("doc_id", "text").collect()
    monkeypatch.setattr(d, "BLOCK_WORDS", 10**6)
    whole = d.find_contamination(documents, benchmark, item_col="item").orderBy("doc_id", "text").collect()
    assert [(r.doc_id, r.text, r.found.spans, r.found["items"]) for r in parts] == [
        (r.doc_id, r.text, r.found.spans, r.found["items"]) for r in whole
    ]
    assert [len(r.found.spans) for r in parts] == [0, 1, 0, 1]
