"""Main text of web pages: boosted trees judge DOM nodes, a decoding over the tree agrees them.

Each node holds main text only, none, or both. The trees give each node's probabilities; decoding
picks the likeliest states for the whole tree under which no node contradicts one above it: all
inside a node of main text is main text, nothing inside a node without any is.
"""

from __future__ import annotations

import random
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.boosting import BoostedTrees
from tidemark.llm.columns import text_slices
from tidemark.llm.dom import Forest, features

NONE, MAIN, BOTH = 0, 1, 2
#: Marks main text in training pages; a private-use character, so that no other text has it.
MARK = "\ue000"


class _Layouts:
    """Random pages whose main text is known, in many layouts; the model's labelled examples."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def words(self, least: int, most: int) -> str:
        r = self.r
        made = ["".join(r.choice("bcdfghlmnprstvwz") + r.choice("aeiouäé") for _ in range(r.randint(1, 4))) for _ in range(r.randint(least, most))]
        return " ".join(made).capitalize()

    def sentences(self, least: int, most: int) -> str:
        made = []
        for _ in range(self.r.randint(least, most)):
            words = self.words(1, 18)
            if self.r.random() < 0.4:
                words = words.replace(" ", ", ", 1)
            made.append(words + self.r.choice("....?!"))
        if self.r.random() < 0.2:
            made.insert(self.r.randint(0, len(made)), self.odd())
        return " ".join(made)

    def odd(self) -> str:
        """What is no plain prose, but stands in texts of any kind."""
        r = self.r
        number = lambda most: str(r.randint(1, 10**most))
        return r.choice(
            [
                lambda: f"{number(16)} {self.words(1, 3)}",
                lambda: f"{self.words(1, 1)}.{number(2)}@{self.words(1, 1)}.example.com",
                lambda: ".".join(number(2) for _ in range(4)),
                lambda: f"+{number(1)} ({number(3)}) {number(3)}-{number(4)}",
                lambda: self.words(2, 12).replace(" ", r.choice([" | ", "%%% ", " *** ", " # ", "; ", "&amp; "])),
                lambda: f"https://{self.words(1, 1)}.example/{number(3)}",
                lambda: f"{self.words(1, 3)} {self.words(1, 2).upper()} {number(1)}.{number(1)}.",
                lambda: self.words(1, 40),
                lambda: f"{self.words(1, 2)}: {number(2)}, {self.words(1, 2)}: {number(2)}",
                lambda: self.words(3, 20).upper(),
            ]
        )()

    def links(self, least: int, most: int) -> list[str]:
        return [f'<a href="/{self.words(1, 1)}">{self.words(1, 3)}</a>' for _ in range(self.r.randint(least, most))]

    def listed(self, items: list[str]) -> str:
        form = self.r.random()
        if form < 0.6:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return ("<p>" + " | ".join(items) + "</p>") if form < 0.8 else "".join(f"<div>{x}</div>" for x in items)

    def block(self, inner: str, tags: str, names: str) -> str:
        """A block of a telling tag, of a telling name, or of neither."""
        r = self.r
        tag = r.choice(tags.split()) if r.random() < self.tagged else "div"
        if r.random() < self.named:
            name = r.choice(names.split())
            name = r.choice([name, f"{name}-{r.choice(['box', 'area', 'wrap', '1'])}", f"site-{name}", f"block {name}"])
        else:
            name = f"{r.choice('xcuk')}{r.randint(1, 99)}"
        how = r.choice(["class", "class", "class", "id"])
        return f'<{tag} {how}="{name}">{inner}</{tag}>' if r.random() < 0.9 else f"<{tag}>{inner}</{tag}>"

    def heading(self, text: str) -> str:
        tag = self.r.choice(["h2", "h3", "h4", "strong", "p"])
        return f"<{tag}>{text}</{tag}>"

    def menu(self) -> str:
        return self.block(self.listed(self.links(3, 14)), "nav", "menu nav navigation navbar breadcrumb")

    def header(self) -> str:
        r, inner = self.r, f'<a href="/">{self.words(1, 3)}</a>'
        inner = r.choice([inner, f"<h1>{inner}</h1>", f"<p>{self.words(1, 3)}</p>", f"<h1>{self.words(1, 5)}</h1><p>{self.words(2, 8)}</p>"])
        inner += self.menu() if r.random() < 0.4 else ""
        return self.block(inner + (self.form() if r.random() < 0.3 else ""), "header", "header masthead top branding")

    def footer(self) -> str:
        r = self.r
        inner = [f"&copy; {r.randint(1999, 2030)} {self.words(1, 4)}", f"&copy; {self.words(1, 1)}.example &middot; {self.sentences(1, 2)}", self.sentences(1, 3)]
        inner = r.choice(["{}", "<p>{}</p>", "<div><p>{}</p></div>"]).format(r.choice(inner))
        return self.block(inner + (self.listed(self.links(1, 8)) if r.random() < 0.5 else ""), "footer", "footer foot copyright bottom")

    def form(self) -> str:
        fields = "".join(f'<label>{self.words(1, 3)}</label><input name="f">' for _ in range(self.r.randint(1, 3)))
        said = f"<p>{self.sentences(1, 2)}</p>" if self.r.random() < 0.5 else self.heading(self.words(1, 4))
        return f"<form>{said}{fields}<button>{self.words(1, 2)}</button></form>"

    def sidebar(self) -> str:
        parts = [
            lambda: self.heading(self.words(1, 4)) + self.listed(self.links(2, 9)),
            lambda: self.heading(self.words(1, 4)) + f"<p>{self.sentences(1, 3)}</p>",
            lambda: f"<p>{self.sentences(1, 2)}</p>",
            self.form,
            self.advert,
        ]
        chosen = "".join(self.block(self.r.choice(parts)(), "div section", "widget box") for _ in range(self.r.randint(1, 4)))
        return self.block(chosen, "aside", "sidebar side aside rail widgets")

    def advert(self) -> str:
        inner = self.r.choice([self.sentences(1, 2), f"<p>{self.sentences(1, 3)}</p>", f"{self.words(2, 6)} {''.join(self.links(1, 1))}"])
        return self.block(inner, "div aside", "ad ads advert sponsored promo advertisement")

    def notice(self) -> str:
        inner = self.r.choice([self.sentences(1, 3), f"<p>{self.sentences(1, 3)}</p>"])
        return self.block(inner + self.r.choice(["", "<button>Ok</button>", "".join(self.links(1, 2))]), "div dialog aside section", "cookie-notice cookie consent notice alert popup gdpr message")

    def comments(self) -> str:
        tag, made = self.r.choice(["div", "li", "article", "p"]), ""
        for _ in range(self.r.randint(1, 6)):
            who = f"<b>{self.words(1, 2)}</b> " if tag == "p" else f"<div>{self.words(1, 2)} {self.r.randint(1, 30)}.{self.r.randint(1, 12)}.</div>"
            said = self.sentences(1, 5)
            name = ' class="comment"' if self.r.random() < self.named else ""
            made += f"<{tag}{name}>{who}{said if tag == 'p' else f'<p>{said}</p>'}</{tag}>"
        made = f"<ol>{made}</ol>" if tag == "li" else made
        return self.block(self.heading(self.words(1, 3)) + made + (self.form() if self.r.random() < 0.4 else ""), "section div", "comments discussion replies comment-list respond")

    def share(self) -> str:
        return self.block(self.listed(self.links(2, 5)), "div ul", "share social tools")

    def related(self) -> str:
        parts = [f"{x}<p>{self.sentences(1, 1)}</p>" if self.r.random() < 0.4 else x for x in self.links(2, 6)]
        return self.block(self.heading(self.words(1, 3)) + self.listed(parts), "aside section div", "related recommended more popular")

    def main_text(self) -> str:
        """The article's blocks, each marked."""
        r = self.r
        title = self.words(2, 12) if r.random() < 0.8 else self.sentences(1, 1)
        made = [f"<h1>{MARK}{title}</h1>" if r.random() < 0.8 else f"<h2>{MARK}{title}</h2>"] if r.random() < 0.85 else []
        if r.random() < 0.15:
            made.append(f"<p>{MARK}{self.words(1, 3)}, {r.randint(1, 28)}.{r.randint(1, 12)}.{r.randint(1999, 2030)}</p>")
        for _ in range(r.choice([1, 1, 2, 3, 4, 6, 9, 14, 40])):
            form = r.random()
            said = MARK + self.sentences(1, r.choice([1, 2, 4, 8, 30]))
            if r.random() < 0.25:
                said = said.replace(" ", f" {''.join(self.links(1, 1))} ", 1)
            if form < 0.1:
                made.append(f"<p>{MARK}{self.odd()}</p>")
            elif form < 0.62:
                made.append(f"<p>{said}</p>")
            elif form < 0.72:
                made.append(f"<p><b>{said}<br><p>{MARK}{self.sentences(1, 4)}</p>")
            elif form < 0.78:
                made.append("<ul>" + "".join(f"<li>{MARK}{self.sentences(1, 2)}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
            elif form < 0.83:
                made.append(f"<blockquote><p>{said}</p></blockquote>")
            elif form < 0.88:
                made.append(f"<h3>{MARK}{self.words(1, 6)}</h3>")
            elif form < 0.91:
                cells = lambda: "".join(f"<td>{MARK}{self.words(1, 4)}</td>" for _ in range(3))
                made.append("<table>" + "".join(f"<tr>{cells()}</tr>" for _ in range(r.randint(2, 4))) + "</table>")
            elif form < 0.94:
                made.append(f"<figure><img src=x><figcaption>{MARK}{self.sentences(1, 1)}</figcaption></figure>")
            else:
                made.append(f"<div>{said}</div>")
        between = [self.advert, self.advert, self.related, self.share, self.notice]
        for _ in range(r.choice([0, 0, 0, 1, 2])):
            made.insert(r.randint(0, len(made)), r.choice(between)())
        if r.random() < 0.1:
            made.append(self.comments())
        wrapped = self.block("".join(made), "article main section", "content article post entry story main text")
        return self.block(wrapped, "main section", "content main page body") if r.random() < 0.3 else wrapped

    def page(self) -> str:
        r = self.r
        self.tagged, self.named = r.choice([(1, 1), (1, 0.3), (0.9, 0.6), (0, 1), (0.2, 0.8), (0, 0)])
        head = [f for f, p in ((self.header, 0.5), (self.menu, 0.8), (self.notice, 0.3), (self.advert, 0.4)) if r.random() < p]
        tail = [f for f, p in ((self.comments, 0.3), (self.related, 0.25), (self.advert, 0.2), (self.sidebar, 0.4)) if r.random() < p]
        tail += [f for f, p in ((self.form, 0.15), (self.footer, 0.85), (self.notice, 0.15)) if r.random() < p]
        if r.random() < 0.25:
            head.append(self.sidebar)
        r.shuffle(head)
        head, main, tail = "".join(f() for f in head), self.main_text(), "".join(f() for f in tail)
        if r.random() < 0.2:
            main = f"<table><tr><td>{head}</td><td>{main}</td><td>{tail}</td></tr></table>"
        elif r.random() < 0.4:
            main = head + self.block(main + (tail if r.random() < 0.4 else ""), "div", "wrapper container layout") + tail
        else:
            main = head + main + tail
        if r.random() < 0.5:
            main = main.replace("</p>", "") if r.random() < 0.1 else main
        return f"<!DOCTYPE html><html><head><title>x</title><style>p{{}}</style></head><body>{main}</body></html>"


def example_pages(pages: int, seed: int) -> list[str]:
    layouts = _Layouts(seed)
    return [layouts.page() for _ in range(pages)]


def _labelled(htmls: list[str]) -> tuple[Forest, np.ndarray]:
    """The pages' forest without marks, and each node's state; -1 without text."""
    forest = Forest()
    for html in htmls:
        forest.add(html)
    main = np.array([(x or "").count(MARK) > 0 for x in forest.text], float)
    other = np.array([bool(x) for x in forest.text], float) - main
    forest.text = [x if x is None else x.replace(MARK, "") for x in forest.text]
    end = np.array(forest.end)
    sums = [np.concatenate([[0], np.cumsum(x)]) for x in (main, other)]
    has_main, has_other = (s[end] - s[: len(end)] > 0 for s in sums)
    state = np.where(has_main & has_other, BOTH, np.where(has_main, MAIN, np.where(has_other, NONE, -1)))
    return forest, state


@lru_cache(maxsize=2)
def fit(pages: int = 1200, seed: int = 11) -> BoostedTrees:
    """The model, fitted to ``pages`` generated example pages; the same for the same arguments."""
    forest, state = _labelled(example_pages(pages, seed))
    known = state >= 0
    return BoostedTrees().fit(features(forest)[known], state[known])


def decode(forest: Forest, log_p: np.ndarray) -> np.ndarray:
    """The likeliest state of each node of the forest among assignments without contradiction.

    From the leaves up, each state's best score: children of a node of one state have that state,
    children of a mixed node their own best one. Then from the roots down, level by level.
    """
    parent, depth = np.array(forest.parent), np.array(forest.depth)
    score = log_p.copy()
    runs = np.array([x is not None for x in forest.text])
    end = np.array(forest.end)
    sums = np.concatenate([[0], np.cumsum(runs)])
    score[sums[end] == sums[: len(end)]] = 0.0  # no text, no say
    score[runs, BOTH] = -np.inf
    levels = np.argsort(depth, kind="stable")
    levels = np.split(levels, np.flatnonzero(np.diff(depth[levels])) + 1)
    for level in reversed(levels[1:]):
        up = parent[level]
        for state in (NONE, MAIN):
            np.add.at(score[:, state], up, score[level, state])
        np.add.at(score[:, BOTH], up, score[level].max(axis=1))
    state = score.argmax(axis=1)
    for level in levels[1:]:
        above = state[parent[level]]
        state[level] = np.where(above == BOTH, state[level], above)
    return state


def main_texts(htmls: list[str | None], model: BoostedTrees) -> list[str]:
    """Main text of each page; empty for an empty or null page or one without main text."""
    forest = Forest()
    for html in htmls:
        forest.add(html or "")
    state = decode(forest, model.log_probabilities(features(forest)))
    parts: list[list[str]] = [[] for _ in htmls]
    for node in np.flatnonzero(state == MAIN):
        if forest.text[node]:
            parts[forest.page[node]].append(forest.text[node])
    return [" ".join(x) for x in parts]


def main_text(html: Column, model: BoostedTrees | None = None) -> Column:
    """Main text of a column of pages, whole, as described at ``main_texts``."""
    model = model or fit()

    def run(pages: pa.Array) -> pa.Array:
        done: list[str] = []
        for _, part in text_slices(pages):
            done += main_texts(part, model)
        return pa.array(done, pa.string())

    return F.arrow_udf(run, "string").asNondeterministic()(html)  # evaluated once, not once per use


def extract(pages: DataFrame, html_col: str = "html", model: BoostedTrees | None = None) -> DataFrame:
    """The pages with their main ``text`` and its number of code points ``n_chars``, which take the
    place of input columns of these names. Null and empty pages have the empty text; every row,
    repeated ones too, is a page of its own, and an empty table gives no rows."""
    done = pages.withColumn("text", main_text(pages[html_col], model))
    return done.withColumn("n_chars", F.length("text").cast("long"))
