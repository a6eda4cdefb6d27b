"""Quality and toxicity scores on held-out labels, and the fitting they share."""

import zlib

import numpy as np
import pytest
from awkward import awkward, nothing
from pyspark.sql import functions as F

from tidemark.llm import fitting, quality, toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def area(rows, label):
    """Share of pairs of a row of label 1 and one of label 0 in which the former scores higher."""
    ones = np.array([r.score for r in rows if r[label] == 1])
    zeros = np.array([r.score for r in rows if r[label] == 0])
    return np.mean((ones[:, None] > zeros) + 0.5 * (ones[:, None] == zeros))


def test_folds_and_samples(spark):
    rows = [(i, i % 2) for i in range(1000)] + [(2000, 0), (2000, 1), (2001, None), (None, 1), (3, 1)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    out = labels.select("doc_id", fitting.held_out().alias("out")).collect()
    assert all(r.out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    sample = fitting.labelled_sample(labels, "quality", 100).collect()
    assert sorted(r.label for r in sample) == [0] * 100 + [1] * 100
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 for r in sample)
    assert {r.doc_id for r in sample}.isdisjoint({2000, 2001, None})
    again = fitting.labelled_sample(labels.repartition(9), "quality", 100).collect()
    assert {tuple(r) for r in again} == {tuple(r) for r in sample}


def test_logistic_recovers_odds():
    chance = np.random.default_rng(0)
    x = chance.normal(size=(20_000, 3))
    y = chance.random(20_000) < 1 / (1 + np.exp(-x @ [1.0, -2.0, 0.0]))
    assert np.abs(fitting.fit_logistic(x, y, ridge=0.01) - [1.0, -2.0, 0.0]).max() < 0.1
    wins = np.where((chance.random(20_000) < 1 / (1 + np.exp(-x @ [1.0, -2.0, 0.0])))[:, None], x, -x)
    assert np.abs(fitting.fit_logistic(wins, ridge=0.01) - [1.0, -2.0, 0.0]).max() < 0.1


def test_quality_of_held_out_documents(labelled):
    documents, labels = labelled
    scored = quality.score(documents, quality.fit(documents, labels))
    rows = scored.join(labels, "doc_id").where(fitting.held_out()).select("score", "quality").collect()
    assert len(rows) > 50 and area(rows, "quality") > 0.95
    assert all(0 <= r.score <= 1 for r in rows)
    # the same at each run, whatever the partitions
    again = quality.score(documents, quality.fit(documents.repartition(5), labels.repartition(3)))
    assert scored.select("doc_id", "score").exceptAll(again.select("doc_id", "score")).isEmpty()


def test_best_share(labelled):
    documents, labels = labelled
    scored = quality.score(documents, quality.fit(documents, labels))
    n = documents.count()
    assert abs(quality.best(scored, 0.3).count() - 0.3 * n) < 0.02 * n


def test_labels_are_not_read_from_held_out_rows(labelled):
    documents, labels = labelled
    flipped = F.when(fitting.held_out(), 1 - F.col("quality")).otherwise(F.col("quality"))
    one = quality.fit(documents, labels)
    two = quality.fit(documents, labels.withColumn("quality", flipped.cast("int")))
    assert (one.weights == two.weights).all() and one.offset == two.offset


def test_toxicity_of_held_out_documents(spark):
    documents, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(documents, labels)
    rows = toxicity.score(documents, model).join(labels, "doc_id").where(fitting.held_out())
    rows = rows.select("score", "toxic").collect()
    assert len(rows) > 50 and area(rows, "toxic") > 0.9


DISGUISED = ["1d10t", "!d!ot", "i d i o t", "i.d.i.o.t", "iiiddddiiiooott", "iiddiioott", "id-io-t", "ID10T"]


@pytest.fixture(scope="module")
def letters(spark):
    rows = [("what an idiot said the other person to that silly clown and the moron",)] * 50
    rows += [("the worthless and pathetic report of a disgusting person",)] * 20
    return toxicity.fit_letters(spark.createDataFrame(rows, "text string"))


@pytest.mark.parametrize("word", DISGUISED)
def test_disguises_are_undone(letters, word):
    restored = toxicity.Restorer(letters)([f"You {word}, go", None, word])
    assert restored[0].startswith("you idiot") and restored[0].endswith(" go")
    assert restored[1:] == ["", "idiot"]


def test_plain_words_stay(letters):
    text = "The 4 committees agree: see all! (a or b) 10 100 x - y. Moron*** and scum$$$ 'till"
    assert toxicity.Restorer(letters)([text]) == [text.lower()]


def test_decoding_is_the_most_probable_path(letters):
    for token in ("m0r0n", "cl0wn", "w0rthl355", "p@th3t1c", "aab", "1!1"):
        paths = [("", 0.0)]
        for options in toxicity.lattice(token):
            paths = [(w + text, s + chance) for w, s in paths for text, chance in options]

        def total(word, chance):
            codes = [0, 0, *(toxicity._CODE[c] for c in word), 0]
            return chance + sum(float(letters[a, b, c]) for a, b, c in zip(codes, codes[1:], codes[2:]))

        best = max(total(*p) for p in paths)
        found = toxicity.restore(token, letters)
        assert max(total(w, s) for w, s in paths if w == found) == pytest.approx(best, abs=1e-4)


def test_letter_counts_cover_all_documents(spark):
    rows = [("ab" if i % 2 else "ac",) for i in range(1000)] + [(None,), ("",)]
    some = toxicity.fit_letters(spark.createDataFrame(rows[:10], "text string"))
    many = toxicity.fit_letters(spark.createDataFrame(rows, "text string"))
    a, b = toxicity._CODE["a"], toxicity._CODE["b"]
    assert -0.75 < many[0, a, b] < -0.69 and some[0, a, b] < many[0, a, b]


def test_disguised_insults_score_like_plain_ones(spark):
    clean = [(i, f"the people of town {'abcdefghij'[i % 10]} went home after a long day", 0) for i in range(400)]
    toxic = [(1000 + i, f"the people of town {'abcdefghij'[i % 10]} said you idiot go home", 1) for i in range(100)]
    rows = spark.createDataFrame(clean + toxic, "doc_id long, text string, toxic int")
    model = toxicity.fit(rows, rows)
    asked = [(0, "they said you 1d10t go home"), (1, "they went home after a long day"), (2, "what an i d i o t")]
    found = toxicity.score(spark.createDataFrame(asked, "doc_id long, text string"), model).collect()
    scores = {r.doc_id: r.score for r in found}
    assert scores[0] > 0.5 and scores[2] > 0.5 and scores[1] < 0.1


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_awkward_rows(spark, labelled, module, label):
    documents = awkward(spark)
    rows = [(4, 1), (5, 0), (5, 0), (6, 1), (7, None), (None, 1), (8, 7)]
    labels = spark.createDataFrame(rows, f"doc_id long, {label} int")
    for some in (labels, labels.where(f"{label} = 1"), labels.where("false")):
        model = module.fit(documents, some, label_col=label)
        scored = module.score(documents, model)
        found = scored.collect()
        assert len(found) == 12 and all(0 <= r.score <= 1 for r in found)
        assert module.score(nothing(spark), model).count() == 0
    assert module.fit(nothing(spark), labels, label_col=label) is not None
