"""Licence recognition by sentences: known sentences, then ordered rules over them. Spark
expressions only."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columns import pick, text_or_empty
from tidemark.llm.lines import document_key

# Sentences of public licences and of their usual notices, as they are written.
SENTENCES = {
    "mit-title": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "mit-grant": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions:"
    ],
    "mit-include": [
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."
    ],
    "mit-as-is": [
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING "
        "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT."
    ],
    "mit-liability": [
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ],
    "mit-notice": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the MIT License.",
        "This software is released under the MIT License.",
    ],
    "bsd-use": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met:"
    ],
    "bsd-source": [
        "Redistributions of source code must retain the above copyright notice, this list of conditions "
        "and the following disclaimer.",
    ],
    "bsd-binary": [
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
        "and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution."
    ],
    "bsd-name": [
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
        "or promote products derived from this software without specific prior written permission."
    ],
    "bsd-as-is": [
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR "
        "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
        "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."
    ],
    "bsd-notice": ["Licensed under the BSD License.", "Released under the BSD License."],
    "apache-notice": [
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License, Version 2.0.",
        "This project is licensed under the Apache License, Version 2.0.",
    ],
    "apache-header": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); ",
        "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements.",
    ],
    "apache-comply": ["you may not use this file except in compliance with the License."],
    "apache-required": [
        "Unless required by applicable law or agreed to in writing, software distributed under the License "
        "is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express "
        "or implied."
    ],
    "apache-see": [
        "See the License for the specific language governing permissions and limitations under the License."
    ],
    "gpl3-notice": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
        "Released under the GNU General Public License, version 3.",
    ],
    "gpl2-notice": [
        "This work is licensed under the GNU General Public License, version 2.",
        "Licensed under the GNU General Public License, version 2.",
    ],
    "gpl-free": ["This program is free software:"],
    "gpl3-later": [
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version."
    ],
    "gpl2-terms": [
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation;"
    ],
    "gpl2-later": ["either version 2 of the License, or (at your option) any later version."],
    "gpl-hope": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;"],
    "gpl-details": ["See the GNU General Public License for more details."],
    "mpl2-subject": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v.",  # 2.0
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "isc-grant": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
        "in all copies."
    ],
    "unlicense": ["This is free and unencumbered software released into the public domain."],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "lgpl-free": ["This library is free software;", "This library is free software:"],
    "lgpl21-terms": [
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License "
        "as published by the Free Software Foundation;"
    ],
    "lgpl21-later": ["either version 2.1 of the License, or (at your option) any later version."],
    "lgpl3-later": [
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version."
    ],
    "lgpl3-notice": [
        "Licensed under the GNU Lesser General Public License, version 3.",
        "Released under the GNU Lesser General Public License, version 3.",
    ],
    "agpl3-later": [
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version."
    ],
    "agpl3-notice": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "Released under the GNU Affero General Public License, version 3.",
    ],
    "zlib-as-is": ["This software is provided 'as-is', without any express or implied warranty."],
    "zlib-liability": [
        "In no event will the authors be held liable for any damages arising from the use of this software."
    ],
    "zlib-grant": [
        "Permission is granted to anyone to use this software for any purpose, including commercial "
        "applications, and to alter it and redistribute it freely, subject to the following restrictions:"
    ],
    "boost-grant": [
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the "
        "software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, "
        "display, distribute, execute, and transmit the Software, and to prepare derivative works of the "
        "Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the "
        "following:"
    ],
    "boost-notice": [
        "Distributed under the Boost Software License, Version 1.0.",
        "Licensed under the Boost Software License, Version 1.0.",
    ],
    "cc0": [
        "To the extent possible under law, the author(s) have dedicated all copyright and related and "
        "neighboring rights to this software to the public domain worldwide.",
        "Licensed under CC0 1.0.",
        "This work is licensed under CC0 1.0 Universal.",
    ],
    "epl2": [
        "This program and the accompanying materials are made available under the terms of the Eclipse "
        "Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
        "Licensed under the Eclipse Public License, version 2.0.",
    ],
    "0bsd-grant": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted."
    ],
    "cc-by-nd": [
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ],
    "cc-by-nc-sa": [
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 "
        "International License.",
    ],
    "all-rights": ["All rights reserved."],
}

# The sentences, in order, by which a licence is known.
RULES = [
    ("MIT", ["mit-title", "mit-grant", "mit-include", "mit-as-is", "mit-liability"]),
    ("MIT", ["mit-grant", "mit-include", "mit-as-is", "mit-liability"]),
    ("BSD-3-Clause", ["bsd-use", "bsd-source", "bsd-binary", "bsd-name", "bsd-as-is"]),
    ("BSD-2-Clause", ["bsd-use", "bsd-source", "bsd-binary", "bsd-as-is"]),
    ("Apache-2.0", ["apache-header", "apache-comply", "apache-required", "apache-see"]),
    ("Apache-2.0", ["apache-header", "apache-comply"]),
    ("GPL-2.0-or-later", ["gpl-free", "gpl2-terms", "gpl2-later", "gpl-hope", "gpl-details"]),
    ("GPL-2.0-or-later", ["gpl-free", "gpl2-terms", "gpl2-later"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl3-later", "gpl-hope", "gpl-details"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl3-later"]),
    ("LGPL-2.1-or-later", ["lgpl-free", "lgpl21-terms", "lgpl21-later"]),
    ("LGPL-3.0-or-later", ["lgpl-free", "lgpl3-later"]),
    ("AGPL-3.0-or-later", ["gpl-free", "agpl3-later"]),
    ("Zlib", ["zlib-as-is", "zlib-liability", "zlib-grant"]),
    ("MIT", ["mit-notice"]),
    ("MIT", ["mit-title"]),
    ("BSD", ["bsd-notice"]),
    ("Apache-2.0", ["apache-notice"]),
    ("GPL-3.0-only", ["gpl3-notice"]),
    ("GPL-2.0-only", ["gpl2-notice"]),
    ("MPL-2.0", ["mpl2-subject"]),
    ("ISC", ["isc-grant"]),
    ("Unlicense", ["unlicense"]),
    ("CC-BY-NC-4.0", ["cc-by-nc"]),
    ("CC-BY-SA-4.0", ["cc-by-sa"]),
    ("CC-BY-4.0", ["cc-by"]),
    ("LGPL-3.0-only", ["lgpl3-notice"]),
    ("AGPL-3.0-only", ["agpl3-notice"]),
    ("BSL-1.0", ["boost-grant"]),
    ("BSL-1.0", ["boost-notice"]),
    ("CC0-1.0", ["cc0"]),
    ("EPL-2.0", ["epl2"]),
    ("0BSD", ["0bsd-grant"]),
    ("CC-BY-ND-4.0", ["cc-by-nd"]),
    ("CC-BY-NC-SA-4.0", ["cc-by-nc-sa"]),
    ("all-rights-reserved", ["all-rights"]),
]

#: What stands between paragraphs: a line of nothing, or of a comment mark.
PARAGRAPH = "\\n[ \\t]*[*#/;-]*[ \\t]*\\n"
#: What joins wrapped lines: a line end and the comment mark of the next line.
LINE_END = "\\n[ \\t]*[*#/;-]*[ \\t]*"
#: What ends a sentence, a blank after it included.
SENTENCE_END = "([.!?;:])[ \\t\\r\\n]+"


def normal_form(sentence: str) -> str:
    """Lower-cased ASCII letters, digits and inner full stops, with one blank for the rest."""
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in sentence)
    return re.sub(r"[^a-z0-9.]+", " ", lowered).strip(" .")


def normalised(sentence: Column) -> Column:
    """``normal_form`` as a Spark expression."""
    lowered = F.translate(sentence, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.btrim(F.regexp_replace(lowered, "[^a-z0-9.]+", " "), F.lit(" ."))


def known_sentences() -> list[tuple[str, str]]:
    """``(normal form, identifier)`` of all known sentences."""
    return [(normal_form(text), name) for name, texts in SENTENCES.items() for text in texts]


def recognised(documents: DataFrame) -> DataFrame:
    """Known sentences of ``(doc, text)``: ``(doc, view, place, name)``.

    A text is cut into sentences twice: with its lines joined, as licences are wrapped (view 0),
    and line by line, as notices stand on lines of their own (view 1). The table of known sentences
    is fixed and small, and broadcast.
    """
    spark = documents.sparkSession
    known = spark.createDataFrame(known_sentences(), "sentence string, name string")
    joined = F.regexp_replace(F.regexp_replace("text", PARAGRAPH, ". "), LINE_END, " ")
    views = [(0, joined), (1, F.col("text"))]
    frames = []
    for view, text in views:
        cut = F.split(F.regexp_replace(text, SENTENCE_END, "$1\n"), "\n")
        rows = documents.select("doc", F.posexplode(cut).alias("place", "sentence"))
        sentence = normalised(F.col("sentence")).alias("sentence")
        rows = rows.select("doc", F.lit(view).alias("view"), "place", sentence)
        frames.append(rows.join(F.broadcast(known), "sentence").drop("sentence"))
    return frames[0].union(frames[1])


def matched(names: Column) -> Column:
    """Licences whose rules match an ordered array of identifiers.

    The rules are tried in order. One matches where its identifiers follow each other (other
    sentences in between have no identifier and do not count); what it matches is taken out, so a
    shorter rule does not match it again.
    """
    rules = F.array(
        *[F.struct(F.lit(f"|{'|'.join(seq)}|").alias("seq"), F.lit(n).alias("name")) for n, seq in RULES]
    )
    start = F.struct(
        F.concat(F.lit("|"), F.array_join(names, "|"), F.lit("|")).alias("left"),
        F.array().cast("array<string>").alias("found"),
    )

    def step(state: Column, rule: Column) -> Column:
        hit = state["left"].contains(rule["seq"])
        left = F.when(hit, F.replace(state["left"], rule["seq"], F.lit("|;|"))).otherwise(state["left"])
        found = F.when(hit, F.concat(state["found"], F.array(rule["name"]))).otherwise(state["found"])
        return F.struct(left.alias("left"), found.alias("found"))

    return F.aggregate(rules, start, step)["found"]


def scan(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's licences, ``(doc_id, licenses, n_sentences)``.

    ``licenses`` is the sorted array of names found in either view, empty if there are none;
    ``n_sentences`` is the number of known sentences in the view that has more. One row per input
    row; null and empty texts have none. Rows equal in id and text get equal results.

    Texts are not shuffled: only known sentences leave the scan.
    """
    docs = pick(documents, doc_id=id_col, text=text_col)
    key = document_key("doc_id", "text").alias("doc")
    keyed = docs.select("doc_id", key, text_or_empty("text").alias("text"))
    # documents that occur in several rows bring the same sentence several times
    found = recognised(keyed.select("doc", "text")).dropDuplicates(["doc", "view", "place"])
    names = F.array_sort(F.collect_list(F.struct("place", "name"))).alias("names")
    by_view = found.groupBy("doc", "view").agg(names)
    by_view = by_view.select("doc", F.size("names").alias("n"), matched(F.col("names.name")).alias("found"))
    by_doc = by_view.groupBy("doc").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("found")))).alias("licenses"),
        F.max("n").cast("long").alias("n_sentences"),
    )
    rows = keyed.select("doc_id", "doc").join(by_doc, "doc", "left")
    return rows.select(
        "doc_id",
        F.coalesce("licenses", F.array().cast("array<string>")).alias("licenses"),
        F.coalesce("n_sentences", F.lit(0).cast("long")).alias("n_sentences"),
    )


def sql() -> str:
    """What ``scan`` computes over ``documents`` in the SQL of DuckDB, licences joined by commas."""

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    known = ", ".join(f"({quoted(text)}, {quoted(name)})" for text, name in known_sentences())
    steps, found = [], []
    for i, (name, seq) in enumerate(RULES, 1):
        pattern = quoted(f"|{'|'.join(seq)}|")
        steps.append(
            f"s{i} AS (SELECT *, contains(left{i - 1}, {pattern}) AS hit{i}, "
            f"replace(left{i - 1}, {pattern}, '|;|') AS left{i} FROM s{i - 1})"
        )
        found.append(f"CASE WHEN hit{i} THEN {quoted(name)} END")
    cut = "unnest(generate_series(1, len(parts))) AS place, unnest(parts) AS sentence"
    end = SENTENCE_END
    return f"""
WITH known(sentence, name) AS (VALUES {known}),
views AS (
  SELECT doc_id, 0 AS view, string_split(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''),
         '{PARAGRAPH}', '. ', 'g'), '{LINE_END}', ' ', 'g'), '{end}', '\\1' || chr(10), 'g'), chr(10)) AS parts FROM documents
  UNION ALL
  SELECT doc_id, 1, string_split(regexp_replace(coalesce(text, ''), '{end}', '\\1' || chr(10), 'g'), chr(10)) FROM documents
),
sentences AS (SELECT doc_id, view, {cut} FROM views),
named AS (
  SELECT doc_id, view, place, name FROM sentences s JOIN known k
  ON k.sentence = trim(regexp_replace(translate(s.sentence, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
     'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9.]+', ' ', 'g'), ' .')
),
s0 AS (
  SELECT doc_id, view, count(*) AS n, '|' || string_agg(name, '|' ORDER BY place) || '|' AS left0
  FROM named GROUP BY doc_id, view
),
{", ".join(steps)},
by_doc AS (
  SELECT doc_id, max(n) AS n_sentences,
         list_sort(list_distinct(flatten(list([x FOR x IN [{", ".join(found)}] IF x IS NOT NULL])))) AS licenses
  FROM s{len(RULES)} GROUP BY doc_id
)
SELECT d.doc_id, coalesce(array_to_string(licenses, ','), '') AS licenses,
       CAST(coalesce(n_sentences, 0) AS BIGINT) AS n_sentences
FROM documents d LEFT JOIN by_doc USING (doc_id)
"""
