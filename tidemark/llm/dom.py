"""Web pages as forests of block nodes with text runs as leaves, and features of each node."""

from __future__ import annotations

import re
from html import unescape

import numpy as np

# Elements by what a parser does with them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Contents are never text of the page. Unclosed, the first line swallows the rest of the page.
TO_THE_END = frozenset("script style".split())
SKIPPED = TO_THE_END | frozenset(
    "title textarea noscript template svg iframe select button object canvas video audio noembed noframes xmp".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup legend li main menu nav ol optgroup p pre search section summary "
    "table tbody td tfoot th thead tr ul".split()
)
CLOSED_BY_SIBLING = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("td", "th", "tr")}
#: Kinds of blocks a feature tells apart.
KINDS = [
    "article main", "nav menu dir", "footer", "header hgroup", "aside", "form fieldset search", "h1", "h2 h3 h4 h5 h6",
    "p", "ul ol dl", "li dt dd", "table tbody thead tfoot tr", "td th caption", "section", "div center body", "figure figcaption",
    "blockquote pre", "dialog details summary", "#text",
]
#: What words in class, id, role and label attributes hint at.
HINTS = [
    "article content post entry story body main text blog document paragraph prose hentry page read",
    "nav menu navigation breadcrumb breadcrumbs navbar topnav menubar tabs pager pagination toc links skip",
    "header masthead banner top logo brand branding topbar hero",
    "footer foot bottom copyright legal imprint colophon contentinfo",
    "sidebar side aside rail widget widgets complementary column secondary right left",
    "ad ads advert advertisement advertising sponsor sponsored promo promotion promoted adsense adbox dfp teaser campaign",
    "comment comments reply replies discussion disqus respond thread commentlist feedback reader review reviews",
    "cookie cookies consent gdpr notice notices alert popup modal overlay warning message privacy banner notification disclaimer",
    "form search login signin signup subscribe subscription newsletter register input contact",
    "share sharing social follow twitter facebook like buttons tools toolbar actions",
    "related recommended recommendations more popular trending latest also similar read-next next previous outbrain",
]
_KIND = {name: i for i, names in enumerate(KINDS) for name in names.split()}
_HINT = {word: 1 << i for i, words in reversed(list(enumerate(HINTS))) for word in words.split()}
HIDDEN, CONTROLS = 1 << len(HINTS), frozenset("input button select textarea".split())

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_SIMPLE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>")
_LIKE_A_TAG = re.compile("</?[a-zA-Z]")
_NAMES = re.compile(r"""(?<![\w-])(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_CONCEALED = re.compile(r"""(?<![\w-])hidden(?![\w-])|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)


def _hints(attributes: str) -> int:
    found = 0
    for names in _NAMES.findall(attributes):
        for word in _WORD.findall("".join(names)):
            found |= _HINT.get(word.lower(), 0)
    return found | (HIDDEN if _CONCEALED.search(attributes) else 0)


class Forest:
    """Nodes of many pages in preorder. A text run ends where a block begins or ends."""

    def __init__(self):
        self.page, self.parent, self.end, self.depth, self.kind, self.hints = [], [], [], [], [], []
        self.text, self.linked, self.controls, self.links = [], [], [], []
        self.pages = 0

    def add(self, html: str) -> None:
        """Takes in a page whole, in time proportional to its length, however broken it is.

        Inline elements are no nodes. End tags without an open block are ignored; a block's end closes
        what is open in it. A page without a markup is one run of text.
        """
        stack = [self._open(-1, "body", 0)]
        names, count = ["body"], {"body": 1}
        run: list[str] = []
        linked = links = at = start = 0
        in_link, tag_at, absent = False, _TAG, set()

        def flush():
            nonlocal linked, links
            text = " ".join("".join(run).split())
            if text:
                node = self._open(stack[-1], "#text", 0)
                self.text[node], self.linked[node], self.links[node] = text, min(linked, len(text)), links
                self.end[node] = node + 1
            run.clear()
            linked = links = 0

        def close():
            nonlocal in_link
            flush()
            self.end[stack.pop()] = len(self.parent)
            count[names.pop()] -= 1
            in_link = False

        def said(stop: int):
            nonlocal linked
            if stop > start:
                words = unescape(html[start:stop])
                run.append(words)
                linked += len(words.strip()) if in_link else 0

        while (at := html.find("<", at)) >= 0:
            after = html[at + 1 : at + 2]
            if after in ("!", "?"):
                said(at)
                comment = html.startswith("<!--", at)
                stop = html.find("-->" if comment else ">", at + 2)
                at = start = len(html) if stop < 0 else stop + (3 if comment else 1)
                continue
            tag = tag_at.match(html, at)
            if tag is None and _LIKE_A_TAG.match(html, at):
                if html.find(">", at) < 0:  # no tag can end any more
                    break
                tag_at = _SIMPLE_TAG  # a quote that never ends: from here on quotes mean nothing
                tag = _SIMPLE_TAG.match(html, at)
            if tag is None:
                at += 1
                continue
            said(at)
            closing, name, attributes = tag[1], tag[2].lower(), tag[3]
            at = start = tag.end()
            if name in CONTROLS and not closing:
                self.controls[stack[-1]] += 1
            if name in SKIPPED:
                if not closing and name not in absent:
                    stop = re.compile(f"</{name}(?=[\\s/>])", re.I).search(html, at)
                    if stop is not None:
                        stop = html.find(">", stop.end())
                        at = start = len(html) if stop < 0 else stop + 1
                    elif name in TO_THE_END:
                        at = start = len(html)
                    else:
                        absent.add(name)
                run.append(" " if name != "svg" else "")
            elif name == "a":
                in_link = not closing
                links += not closing
            elif name in ("br", "hr", "img"):
                run.append(" ")
                if name == "hr":
                    flush()
            elif name in ("body", "html", "head"):
                if not closing and name == "body":
                    flush()
                    self.hints[stack[0]] |= _hints(attributes)
            elif name in BLOCKS and closing:
                if count.get(name):
                    while names[-1] != name:
                        close()
                    close()
                else:
                    flush()
            elif name in BLOCKS:
                flush()
                in_link = False
                if names[-1] == "p":
                    close()
                while names[-1] in CLOSED_BY_SIBLING.get(name, ()):
                    done = names[-1]
                    close()
                    if done == name:
                        break
                stack.append(self._open(stack[-1], name, _hints(attributes) if attributes else 0))
                names.append(name)
                count[name] = count.get(name, 0) + 1
        said(len(html))
        while stack:
            close()
        self.pages += 1

    def _open(self, parent: int, name: str, hints: int) -> int:
        self.page.append(self.pages)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.kind.append(_KIND.get(name, _KIND["div"]))
        self.hints.append(hints)
        self.text.append(None)
        for counts in (self.end, self.linked, self.controls, self.links):
            counts.append(0)
        return len(self.parent) - 1


def _within(values: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Sums over each node's subtree, itself included."""
    sums = np.concatenate([[0.0], np.cumsum(values, dtype=float)])
    return sums[end] - sums[: len(end)]


def features(forest: Forest) -> np.ndarray:
    """One row of numbers per node: its text, its place, its kind and names, its surroundings."""
    parent, end, depth, kind, hints, page = (
        np.array(x, np.int64)
        for x in (forest.parent, forest.end, forest.depth, forest.kind, forest.hints, forest.page)
    )
    many, texts = len(parent), [x or "" for x in forest.text]
    up = np.maximum(parent, 0)
    length = np.array([len(x) for x in texts], float)
    is_run = np.array([x is not None for x in forest.text], float)

    def inside(values) -> np.ndarray:
        return _within(np.asarray(values, float), end)

    chars, runs, nodes = inside(length), inside(is_run), inside(1 - is_run)
    per = 100.0 / np.maximum(chars, 1)
    stops = inside([x.count(".") + x.count("!") + x.count("?") for x in texts]) * per
    commas = inside([x.count(",") for x in texts]) * per
    signs = inside([x.count("\xa9") + x.count("\xbb") for x in texts])
    linked = inside(forest.linked) / np.maximum(chars, 1)
    long_text = inside(length * (length >= 80)) / np.maximum(chars, 1)
    ended = inside([x[-1:] in ".!?" and len(x) > 0 for x in texts]) / np.maximum(runs, 1)
    roots = np.flatnonzero(parent < 0)
    whole = chars[roots[page]]
    before = np.concatenate([[0.0], np.cumsum(length)])[:many]
    before = before - before[roots[page]]

    # place among siblings and the sibling before, walking each parent's children in order
    order = np.lexsort((np.arange(many), parent))
    first = np.concatenate([[True], parent[order][1:] != parent[order][:-1]])
    group = np.cumsum(first) - 1
    number = np.arange(many) - np.flatnonzero(first)[group]
    size = np.bincount(group)[group]
    index, siblings, earlier, later = np.zeros(many), np.ones(many), np.full(many, -1), np.full(many, -1)
    index[order], siblings[order] = number, size
    earlier[order[1:]] = np.where(first[1:], -1, order[:-1])
    later[order[:-1]] = np.where(first[1:], -1, order[1:])
    mean = np.zeros(many)
    mean[order] = (np.bincount(group, chars[order]) / np.bincount(group))[group]
    linked_siblings = np.zeros(many)
    linked_siblings[order] = (np.bincount(group, linked[order]) / np.bincount(group))[group]
    rows = [
        np.log1p(chars), chars / np.maximum(whole, 1), np.log1p(whole), linked, np.log1p(inside(forest.links)),
        np.log1p(chars / (nodes + 1)), np.log1p(runs), np.log1p(chars / np.maximum(runs, 1)), long_text, stops, commas,
        signs, ended, np.log1p(inside(forest.controls)), depth, index / siblings, np.log1p(siblings),
        chars / np.maximum(chars[up], 1), np.log1p(mean), linked_siblings, before / np.maximum(whole, 1),
        (before + chars) / np.maximum(whole, 1), linked[up], np.log1p(chars[up]),
    ]
    for other in (earlier, later):
        there = other >= 0
        rows += [np.where(there, x[other], -1.0) for x in (np.log1p(chars), linked, kind.astype(float))]
    rows += [kind == i for i in range(len(KINDS))]
    # kinds and names of what a node lies in, and the share of its text that lies in named blocks
    above = hints.copy()
    kinds_above = np.zeros(many, np.int64)
    telling = [_KIND[x] for x in ("article", "nav", "footer", "header", "aside", "form", "table", "ul", "blockquote")]
    levels = np.argsort(depth, kind="stable")
    for level in np.split(levels, np.flatnonzero(np.diff(depth[levels])) + 1):
        inner = level[parent[level] >= 0]
        above[inner] |= above[parent[inner]]
        kinds_above[inner] = kinds_above[parent[inner]] | (1 << kind[parent[inner]])
    for bit in range(len(HINTS) + 1):
        own = (hints >> bit) & 1
        rows += [own, (above >> bit) & 1]
        if bit < len(HINTS):
            covered = length * ((above >> bit) & 1)
            rows.append(inside(covered) / np.maximum(chars, 1))
    rows += [(kinds_above >> k) & 1 for k in telling]
    for k in telling[:6]:
        under = length * (((kinds_above >> k) & 1) | (kind == k))
        rows.append(inside(under) / np.maximum(chars, 1))
    return np.stack([np.asarray(x, np.float32) for x in rows], axis=1)
