import duckdb
from awkward import awkward, nothing

from tidemark.llm import licenses

MIT = """/*
 * MIT License
 *
 * Copyright (c) 2020 Someone
 *
 * Permission is hereby granted, free of charge, to any person obtaining a copy of this
 * software and associated documentation files (the "Software"), to deal in the Software
 * without restriction, including without limitation the rights to use, copy, modify, merge,
 * publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons
 * to whom the Software is furnished to do so, subject to the following conditions:
 *
 * The above copyright notice and this permission notice shall be included in all copies or
 * substantial portions of the Software.
 *
 * THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
 * INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR
 * PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE
 * FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
 * OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
 * DEALINGS IN THE SOFTWARE.
 */"""


def text_of(names, sep=" "):
    return sep.join(licenses.SENTENCES[name][0] for name in names)


def found(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r.licenses for r in licenses.scan(frame).collect()}


def test_every_rule_matches_its_own_sentences(spark):
    texts = [text_of(sequence, sep) for sep in ("\n", "\n\n") for _, sequence in licenses.RULES]
    names = [name for name, _ in licenses.RULES] * 2
    assert found(spark, texts) == {i: [name] for i, name in enumerate(names)}


def test_order_gaps_and_consumption(spark):
    bsd3 = ["bsd-use", "bsd-source", "bsd-binary", "bsd-name", "bsd-as-is"]
    texts = [
        MIT,
        text_of(bsd3),  # not also the shorter rule
        text_of([bsd3[0], bsd3[2], bsd3[1], bsd3[4]]),  # wrong order
        text_of(bsd3[:3]) + " Something of our own. " + text_of(bsd3[4:]),
        text_of(bsd3) + "\n" + text_of([*bsd3[:3], bsd3[4]]) + "\nAll rights reserved.",
        "Prose. Released under the MIT License. More prose",
        "prose Released under the MIT License.",
        "LICENSED under the apache license,\tversion 2.0",
    ]
    assert found(spark, texts) == {
        0: ["MIT"],
        1: ["BSD-3-Clause"],
        2: [],
        3: ["BSD-2-Clause"],
        4: ["BSD-2-Clause", "BSD-3-Clause", "all-rights-reserved"],
        5: ["MIT"],
        6: [],
        7: ["Apache-2.0"],
    }


def test_normal_form_is_the_same_in_spark(spark):
    texts = [t for _, ts in licenses.SENTENCES.items() for t in ts] + [" .A-B.. ", "Ünï 2.0;", "İ", ""]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = frame.select("t", licenses.normalised(frame.t).alias("n")).collect()
    assert [r.n for r in rows] == [licenses.normal_form(r.t) for r in rows]


def test_sql_finds_the_same(spark):
    texts = [MIT, text_of(["gpl-free", "gpl3-later", "gpl-hope", "gpl-details"]), "x", None, ""]
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    connection.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    theirs = {r[0]: r[1] for r in connection.execute(licenses.sql()).fetchall()}
    assert theirs == {i: ",".join(names) for i, names in found(spark, texts).items()}


def test_spark_expressions_only(spark, documents):
    plan = licenses.scan(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_awkward_rows(spark):
    rows = licenses.scan(awkward(spark)).collect()
    assert len(rows) == 12 and {tuple(r.licenses) for r in rows} == {()}
    assert licenses.scan(nothing(spark)).count() == 0
