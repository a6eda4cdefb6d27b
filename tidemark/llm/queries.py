"""The registered queries of this subpackage and the SQL that computes the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    decontaminate,
    divergence,
    language,
    licenses,
    lines,
    maintext,
    mixing,
    phrases,
    quality,
    simhash,
    substrings,
    toxicity,
    vafile,
)
from tidemark.llm.fitting import held_out


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document: shingles of 3 words, at most 3 bits apart."""
    groups = simhash.simhash_groups(_table(spark, sf_dir, "documents"), 3, 3)
    return groups.select("doc_id", "fingerprint", "component_id")


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the strings of 200 bytes that start anywhere else too."""
    done = substrings.removed(_table(spark, sf_dir, "documents"), window=200)
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op3_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines to remove from every document, so that one of each group of similar lines stays."""
    documents = _table(spark, sf_dir, "documents")
    n_lines = F.size(F.split("text", "\n")).cast("long").alias("n_lines")
    rows = documents.select("doc_id", lines.document_key().alias("doc"), n_lines)
    rows = rows.join(lines.repeated_lines(documents, sketched=True, short=True), "doc", "left")
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return rows.select(
        "doc_id", "n_lines", F.size(removed).cast("long").alias("n_removed"), removed.alias("removed")
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of the benchmark occurs in every document, by windows of 13 words."""
    found = decontaminate.find_contamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), window=13
    )
    return found.select(
        "doc_id",
        F.col("found.n_words"),
        decontaminate.n_hit().alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ",").cast("binary"), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by a pairwise model of the labels; good from a score of 0.3."""
    documents = _table(spark, sf_dir, "documents")
    scored = quality.score(documents, quality.fit(documents, _table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        quality.predicted(F.col("score"), 0.3).alias("predicted"),
    )


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document: weights 1, 2, 3 by source, at most 3 epochs."""
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    taken = F.col("size") * F.col("repetitions")
    return mixed.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences named or quoted in every document."""
    found = licenses.scan(_table(spark, sf_dir, "documents"))
    return found.withColumn("licenses", F.array_join("licenses", ","))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document after its disguised words are restored; toxic from 0.5."""
    documents = _table(spark, sf_dir, "documents")
    scored = toxicity.score(documents, toxicity.fit(documents, _table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        quality.predicted(F.col("score"), 0.5).alias("predicted"),
    )


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page from its text, markup, address suffix and host."""
    pages = _table(spark, sf_dir, "pages").select(
        "page_id",
        language.page_text(F.col("html")).alias("text"),
        language.markup_language(F.col("html")).alias("declared"),
        language.host_of(F.col("url")).alias("host"),
    )
    found = language.identify(pages, "text", "declared", F.col("host"))
    return found.select("page_id", "host", "declared", "language", "confidence")


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best other vectors by inner product for every vector whose id is divisible by 20."""
    return vafile.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op11_maintext(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article of every page, whole, without what surrounds it."""
    done = maintext.extract(_table(spark, sf_dir, "pages"), "html")
    return done.select("page_id", "url", "text", "n_chars")


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far every source differs from the others of its language, and by which terms."""
    return divergence.source_divergence(_table(spark, sf_dir, "documents"), min_docs=10, top_terms=10)


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best collocations of every language, of 2 and 3 words and 10 occurrences or more."""
    return phrases.collocations(_table(spark, sf_dir, "documents"), min_count=10, top=2000, absorbed_percent=50)


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_substrings": op2_substrings,
    "op3_lines": op3_lines,
    "op4_decontamination": op4_decontamination,
    "op5_quality": op5_quality,
    "op6_mixing": op6_mixing,
    "op7_licenses": op7_licenses,
    "op8_toxicity": op8_toxicity,
    "op9_language": op9_language,
    "op10_topk": op10_topk,
    "op11_maintext": op11_maintext,
    "op12_divergence": op12_divergence,
    "op13_phrases": op13_phrases,
}

OP6_SQL = """
WITH docs AS (
  SELECT doc_id, source,
         md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS lot,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 AS weight
  FROM docs GROUP BY source
), ordered AS (  -- sources by how soon the rising level reaches their cap
  SELECT *, row_number() OVER fill AS place,
         coalesce(sum(3 * source_size) OVER (fill ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
         sum(weight) OVER (fill ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free,
         sum(source_size) OVER () AS total
  FROM sources WINDOW fill AS (ORDER BY 3 * source_size / weight, source)
), level AS (
  SELECT CAST(total - used AS DOUBLE) / CAST(free AS DOUBLE) AS level FROM ordered
  WHERE 3 * source_size > CAST(total - used AS DOUBLE) / CAST(free AS DOUBLE) * weight
  ORDER BY place LIMIT 1
), targets AS (
  SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), (SELECT level FROM level) * weight) AS target
  FROM sources
), lined AS (
  SELECT d.doc_id, d.size, source_size, target, floor(target / source_size) AS whole,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY lot
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size / 2 AS middle
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN middle <= target - whole * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM lined
"""

OP10_SQL = """
WITH cells AS (
  SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS c
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         CAST(list_dot_product(CAST(q.c AS DOUBLE[]), CAST(v.c AS DOUBLE[])) AS BIGINT) AS score
  FROM cells q JOIN cells v ON q.vec_id <> v.vec_id AND len(q.c) = len(v.c)
  WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""

OP12_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), words AS (
  SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), counted AS (
  SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n, count(DISTINCT doc) AS docs
  FROM words GROUP BY lang, source, term
), terms AS (
  SELECT lang, term, sum(n) AS total FROM counted GROUP BY lang, term HAVING sum(docs) >= 10
), langs AS (
  SELECT lang, sum(total) AS lang_words, count(*) AS v FROM terms GROUP BY lang
), groups AS (
  SELECT g.lang, g.source, coalesce(sum(c.n) FILTER (t.term IS NOT NULL), 0) AS words
  FROM (SELECT DISTINCT lang, source FROM docs) g
  LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source
  LEFT JOIN terms t ON t.lang = c.lang AND t.term = c.term
  GROUP BY g.lang, g.source
), shares AS (
  SELECT g.lang, g.source, t.term, coalesce(c.n, 0) AS n,
         CAST(1 + (1000000000 * (coalesce(c.n, 0) + 2)) // (g.words + 2 * l.v) AS BIGINT) AS p,
         CAST(1 + (1000000000 * (t.total + 2)) // (l.lang_words + 2 * l.v) AS BIGINT) AS q
  FROM groups g JOIN langs l ON l.lang = g.lang JOIN terms t ON t.lang = g.lang
  LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = t.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
), results AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(p.value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // (p + q) AS BIGINT) FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM results
)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

OP13_SQL = r"""
WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), pieces AS (
  SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), starts AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
), phrases AS (
  SELECT lang, 1 AS size, w[i] AS phrase FROM starts
  UNION ALL SELECT lang, 2, array_to_string(w[i : i + 1], ' ') FROM starts WHERE i + 1 <= len(w)
  UNION ALL SELECT lang, 3, array_to_string(w[i : i + 2], ' ') FROM starts WHERE i + 2 <= len(w)
), counted AS (
  SELECT lang, size, phrase, count(*) AS f FROM phrases GROUP BY lang, size, phrase
), totals AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counted WHERE size = 1 GROUP BY lang
), many AS (
  SELECT *, string_split(phrase, ' ') AS w FROM counted WHERE size > 1 AND f >= 10
), longer AS (
  SELECT lang, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase, f FROM many WHERE size = 3
), kept AS (
  SELECT m.* FROM many m
  WHERE NOT EXISTS (SELECT 1 FROM longer x WHERE x.lang = m.lang AND x.phrase = m.phrase AND 100 * x.f >= 50 * m.f)
), cuts AS (
  SELECT lang, phrase, f AS a, 1 AS k, w[1] AS head, array_to_string(w[2:], ' ') AS tail FROM kept
  UNION ALL SELECT lang, phrase, f, 2, w[1] || ' ' || w[2], w[3] FROM kept WHERE size = 3
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r,
         CAST(1000000 * CAST(c.a AS HUGEINT) * c.a // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts c JOIN counted x ON x.lang = c.lang AND x.phrase = c.head JOIN counted y ON y.lang = c.lang AND y.phrase = c.tail
), worst AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scored
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM worst WHERE place = 1
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLES: dict[str, str] = {
    "op6_mixing": OP6_SQL,
    "op7_licenses": licenses.sql(),
    "op10_topk": OP10_SQL,
    "op12_divergence": OP12_SQL,
    "op13_phrases": OP13_SQL,
}
