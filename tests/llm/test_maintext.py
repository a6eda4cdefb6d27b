"""Main text of pages: known templates, hand-written layouts, broken markup and the decoding."""

import html
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import maintext
from tidemark.llm.boosting import BoostedTrees
from tidemark.llm.dom import Forest, features
from tidemark.llm.maintext import BOTH, MAIN, NONE


@pytest.fixture(scope="module")
def model():
    return maintext.fit()


def extracted(model, page):
    return maintext.main_texts([page], model)[0]


def article_of(page):
    inside = re.search(r"<article>(.*)</article>", page, re.S)[1]
    inside = re.sub(r"</?(p|h1|br)>", " ", inside)
    return " ".join(html.unescape(re.sub(r"<[^>]*>", "", inside)).split())


def test_whole_pages_of_the_table(spark, sf_dir, model):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = maintext.extract(pages).select("page_id", "html", "text", "n_chars").collect()
    assert len(rows) == pages.count()
    assert sum(r.text == article_of(r.html) for r in rows) >= 0.98 * len(rows)
    assert all(r.n_chars == len(r.text) for r in rows)


PROSE = (
    "The river rose in the night, and by morning the lower fields were under water. "
    "Nobody had expected it so early in the year."
)
MORE = "Help came at noon, when the first boats reached the mill. It took three days until the roads were dry."
LAYOUTS = {
    "semantic": f"""<body><header><a href="/">The Valley Post</a><nav><ul><li><a href="/a">News</a><li><a href="/b">Sport</a>
      </ul></nav></header><main><article><h1>High water</h1><p>{PROSE}</p><p>{MORE}</p></article></main>
      <aside><h3>Popular</h3><ul><li><a href="/1">Ten recipes</a></li><li><a href="/2">Old bridges</a></li></ul></aside>
      <footer>&copy; 2024 The Valley Post <a href="/i">Imprint</a></footer></body>""",
    "names": f"""<div id="header"><h2>Valley Post</h2></div><div class="nav-menu"><a href="/a">News</a> <a href="/b">Sport</a></div>
      <div id="content"><div class="post"><h1>High water</h1><p>{PROSE}</p><div class="advertisement">Buy boots now! Only today.</div>
      <p>{MORE}</p></div></div><div class="sidebar"><div class="widget">Follow our page for more.</div></div>
      <div class="comments"><h3>Comments</h3><div class="comment"><p>I was there, it was dreadful.</p></div></div>
      <div id="footer">All rights reserved.</div>""",
    "notice": f"""<div class="cookie-consent"><p>We use cookies to improve this site. You can refuse them.</p><button>Ok</button></div>
      <nav><a href="/">Home</a></nav><article><h1>High water</h1><p>{PROSE}</p><p>{MORE}</p></article>
      <form action="/s"><label>Your mail</label><input><p>Get our letter every week.</p></form>""",
}


@pytest.mark.parametrize("name", sorted(LAYOUTS))
def test_layouts(model, name):
    assert extracted(model, f"<!DOCTYPE html><html>{LAYOUTS[name]}</html>") == f"High water {PROSE} {MORE}"


def test_generated_pages_of_another_seed(model):
    forest, state = maintext._labelled(maintext.example_pages(200, 4321))
    found = maintext.decode(forest, model.log_probabilities(features(forest)))
    runs = np.array([bool(x) for x in forest.text])
    assert (found[runs] == state[runs]).mean() > 0.98


def test_white_space_references_and_breaks(model):
    page = (
        f"<nav><a href=/>Home</a></nav><article><h1>A &amp; B</h1><p>one\n two&nbsp;three<br>four <b>bo</b>ld &lt;x&gt; "
        f"{PROSE}</p><script>var a = '<p>no</p>';</script><!-- no <p>no</p> --><p>{MORE}</p></article>"
    )
    assert extracted(model, page) == f"A & B one two three four bold <x> {PROSE} {MORE}"


def test_broken_markup_keeps_the_text():
    def texts(page):
        forest = Forest()
        forest.add(page)
        return [x for x in forest.text if x]

    assert texts("plain < text > 3") == ["plain < text > 3"]
    assert texts("<p>a<p>b</div></p><li>c<li>d") == ["a", "b", "c", "d"]
    assert texts('<p title="x>y">a</p>') == ["a"]
    assert texts('<p title="x>a</p><p>b</p>') == ["a", "b"]  # a quote without end
    assert texts("<p>a<script>b") == ["a"] and texts("<p>a<!-- b") == ["a"]
    assert texts("<p>a<select>b") == ["a b"]
    assert texts("<table><tr><td>a<td>b<tr><td>c</table>d") == ["a", "b", "c", "d"]
    assert texts("") == [] and texts("<") == ["<"] and texts("<p") == ["<p"]


@pytest.mark.parametrize(
    "piece", ["<div>", "</b>", "<p>a", "<a href='", '<a x="', "<!--", "<script>", "<", "<select>", "<td>x", "</p>", "&am"]
)
def test_time_follows_length(piece):
    """A page of one thing over and over costs about twice as much when it is twice as long."""

    def seconds(times):
        started = time.perf_counter()
        forest = Forest()
        forest.add(piece * times)
        features(forest)
        return time.perf_counter() - started

    seconds(1000)
    assert seconds(40_000) < 8 * seconds(20_000) + 0.5


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32 - 1))
def test_decoding_is_the_best_without_contradictions(seed):
    """On small random trees, against all assignments."""
    draw = np.random.default_rng(seed)
    forest = Forest()
    forest.add("".join(draw.choice(["<div>", "</div>", "<p>x</p>", "y"], size=5)))
    log_p = np.log(draw.dirichlet([1, 1, 1], len(forest.parent)))
    found = maintext.decode(forest, log_p)
    filled = np.array([x is not None for x in forest.text])
    has_text = [filled[i : forest.end[i]].any() for i in range(len(filled))]

    def allowed(states):
        for node, parent in enumerate(forest.parent):
            if filled[node] and states[node] == BOTH:
                return False
            if parent >= 0 and states[parent] != BOTH and states[node] != states[parent]:
                return False
        return True

    def value(states):
        return sum(log_p[i, s] for i, s in enumerate(states) if has_text[i])

    assert allowed(found)
    many = len(found)
    if many <= 8:
        best = max(value(s) for s in np.ndindex(*([3] * many)) if allowed(s))
        assert value(found) == pytest.approx(best)


def test_trees_learn_rare_marks():
    draw = np.random.default_rng(2)
    x = draw.random((4000, 6)).astype(np.float32)
    x[:, 5] = draw.random(4000) < 0.02
    label = np.where(x[:, 5] > 0, BOTH, np.where(x[:, 0] > 0.5, MAIN, NONE))
    model = BoostedTrees(rounds=30).fit(x, label)
    assert (model.log_probabilities(x).argmax(axis=1) == label).mean() > 0.99


def test_takes_pages_as_they_come(spark, model):
    long = "<article>" + f"<p>{PROSE}</p>" * 3000 + "</article>"
    rows = [(1, None, "a", 1), (1, None, "a", 1), (2, "", None, 2), (None, "<p></p>", "b", 3), (3, long, "c", None), (4, "\x00 &#0;", "d", 5)]
    frame = spark.createDataFrame(rows, "page_id long, html string, text string, n_chars int")
    found = maintext.extract(frame).collect()
    assert len(found) == len(rows)
    by_id = {r.page_id: r for r in found}
    assert by_id[1].text == by_id[2].text == by_id[None].text == "" and by_id[1].n_chars == 0
    assert by_id[3].text == " ".join([PROSE] * 3000)
    assert maintext.extract(frame.where("false")).collect() == []
