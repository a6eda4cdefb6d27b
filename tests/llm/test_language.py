import pytest
from awkward import awkward, nothing
from pyspark.sql import functions as F

from tidemark.llm import language


@pytest.fixture(scope="module")
def model(documents):
    return language.fit_text_model(documents, "text", "lang")


def test_texts_alone_are_told_apart(documents, model):
    held_out = documents.where("doc_id % 4 = 0 and n_chars > 200")
    fitted = language.fit_text_model(documents.where("doc_id % 4 <> 0"), "text", "lang")
    found = language.identify(held_out, "text", model=fitted).select("lang", "language").collect()
    assert sum(r.lang == r.language for r in found) >= 0.97 * len(found) > 10


def test_model_counts_every_document(spark, documents, model):
    again = language.fit_text_model(documents.repartition(7), "text", "lang")
    assert (again == model).all()
    assert model.shape == (language.BUCKETS, len(language.LANGUAGES))


def test_evidence_is_fused(spark, model):
    rows = [  # text of little use, declared language, host
        (1, "de la", "fr-FR", "a.example.com"),
        (2, "la", " ES", "b.example.net"),
        (3, "la", None, "x.example.fr"),
        (4, "la", None, "x.example.es"),
        (5, "de la", None, None),
    ]
    same = [(100 + i, "les deux aux une que pour dans est avec", None, "h.example.org") for i in range(30)]
    last = [(200, "de", None, "h.example.org")]
    pages = spark.createDataFrame(rows + same + last, "id long, text string, declared string, host string")
    found = language.identify(pages, "text", "declared", F.col("host"), model=model)
    found = {r.id: r for r in found.collect()}
    assert found[1].language == "fr" and found[2].language == "es"
    assert found[3].language == "fr" and found[4].language == "es"
    assert found[200].language == "fr"  # as all other pages of that host


def test_smoothing_falls_back_by_level(spark):
    rows = [("a.x.de", [1.0, 0.0])] * 40 + [("b.x.de", [0.0, 1.0]), ("c.y.com", [0.0, 1.0])]
    evidence = spark.createDataFrame(rows, "host string, shares array<double>")
    prior = {r.host: r.prior for r in language.host_priors(evidence, 2).collect()}
    assert prior["a.x.de"][0] > 0.95
    assert prior["c.y.com"][0] < prior["b.x.de"][0] < prior["a.x.de"][0]
    assert all(abs(sum(p) - 1) < 1e-9 for p in prior.values())


def test_addresses_and_markup(spark):
    row = spark.createDataFrame(
        [("https://user@Www.Example.co.uk:80/de/?a=b#c", '<HTML class="x" Lang=\'de-AT\'><script>var a="</p>";</script>'
          "<p>Guten<!-- no --> Tag</p></html>")], "url string, html string",
    )
    found = row.select(
        language.host_of(F.col("url")).alias("host"),
        language.markup_language(F.col("html")).alias("lang"),
        F.trim(language.page_text(F.col("html"))).alias("text"),
    ).first()
    assert found.host == "www.example.co.uk" and found.lang == "de-AT"
    assert found.text.split() == ["Guten", "Tag"]


def test_clean_documents_stay_and_gibberish_goes(spark, documents, model):
    kept = language.identified(documents, declared_col="lang", host=F.col("source"), model=model)
    assert kept.columns == documents.columns
    assert kept.where("n_chars > 20").count() == documents.where("n_chars > 20").count()
    junk = spark.createDataFrame([(1, "qzxv kjwq zxqv wvkq pqzx jjkq wxyz qqzv kkjx zzqw", "en")], "doc_id long, text string, lang string")
    assert language.identified(junk, declared_col="lang", model=model).count() == 0


def test_awkward_rows(spark, model):
    documents = awkward(spark)
    found = language.identify(documents, "text", "lang", F.col("source"), model=model)
    rows = found.collect()
    assert len(rows) == 12
    assert {r.language for r in rows if not (r.text or "").strip()} == {"und"}
    assert all(0 <= r.confidence <= 1 for r in rows)
    own = language.identify(documents, "text", "lang")  # fitted to itself
    assert own.count() == 12
    assert language.identify(nothing(spark), "text", "lang").count() == 0
