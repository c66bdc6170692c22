"""Main text of web pages: gradient-boosted trees over DOM-node features, decoded as a tree.

A page becomes a tree of elements. Each element has features of itself (tag, words of
class, id and role, alone or in a longer name, depth), of its subtree (text, links, density, sentences), of its
siblings and of its ancestors. Trees give the probability that an element belongs to
the main text. Decoding takes the most likely choice in which no element is kept inside
a dropped one: bottom up, an element is kept only if keeping it, with the best choice
for its children, beats dropping the whole subtree.

The trees are trained on pages written here from a few layouts with known labels.
Rows are judged alone, where they are read; the model is a few kilobytes.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from labelworks.llm.boosting import Trees, fit
from labelworks.session import on_executors

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|data-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noframes".split())  # their content is no markup
IN_HEAD = frozenset("base basefont bgsound link meta title noscript noframes style script template".split())  # any other tag ends an open head
DROPPED = frozenset("head script style template textarea title select button iframe xmp noframes".split())  # scripts, styles, templates, controls
JUDGED = frozenset("noscript canvas audio video object svg dialog".split())  # not blocks, but the trees decide on them
BLOCK = frozenset(
    "html body address article aside blockquote center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
_ENDS_P = BLOCK - {"html", "body", "dd", "dt", "li", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
_ENDS_SAME = {"li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}), "option": ({"option"}, {"select"})}
_SCOPE = frozenset("table td th button article section aside nav header footer main div blockquote li".split())
GROUPS = [
    {"article", "main"}, {"nav", "menu"}, {"aside"}, {"header"}, {"footer"}, {"p", "pre", "blockquote"}, {"h1", "h2", "h3", "h4", "h5", "h6"}, {"div", "section", "center"}, {"ul", "ol", "dl"},
    {"li", "dd", "dt"}, {"table", "tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"a"}, {"figure", "figcaption"}, {"html", "body"}, {"form"}, {"noscript", "canvas", "audio", "video"}, {"object", "svg"}, {"dialog"},
]
GOOD = frozenset("content article post entry main story text body page prose".split())
BAD = [
    frozenset("nav navigation menu breadcrumb breadcrumbs tabs toc pagination pager".split()),
    frozenset("header masthead banner topbar logo footer foot copyright bottom colophon".split()),
    frozenset("sidebar side aside widget related recommended popular trending tags meta".split()),
    frozenset("ad ads advert adverts advertisement sponsor sponsored promo promoted".split()),
    frozenset("cookie cookies consent notice alert popup modal overlay gdpr subscribe newsletter signup login search".split()),
    frozenset("comment comments reply replies discussion disqus respond share social sharing".split()),
]
# Names that begin so say what a page or an element has, not what it is.
LAYOUT = frozenset("has no with without hide show is not".split())
_KIND = {tag: i for i, group in enumerate(GROUPS) for tag in group}


class Pages:
    """The elements of several pages in page order, one after another, and their texts.
    ``data-label`` is read on generated pages alone: on others it means something else."""

    def __init__(self, generated: bool = True):
        self.generated = generated
        self.parent, self.end, self.kind, self.depth, self.good, self.bad, self.asked, self.label = [], [], [], [], [], [], [], []
        self.text: list[tuple[int, int, str]] = []  # element, block, characters
        self.first: list[int] = []

    def add(self, page: str) -> None:
        self.first.append(len(self.parent))
        stack: list[tuple[str, int]] = []
        block, at, dropped, raw = len(self.text), 0, 0, ""

        def open_(tag: str, attributes: str) -> None:
            good, bad, label = 0, 0, -1
            if attributes and len(attributes) > 3:
                for name, *value in _ATTRIBUTE.findall(attributes):
                    value = "".join(value)
                    if name.lower() == "data-label":
                        if self.generated:
                            label = int(value)
                        continue
                    if tag == "body":
                        continue  # its names are those of the page's layout
                    for name in value.split():
                        tokens = [t.lower() for t in _TOKEN.findall(name)]
                        if len(tokens) > 1 and tokens[0] in LAYOUT:
                            continue
                        good |= not GOOD.isdisjoint(tokens)
                        for i, words in enumerate(BAD):
                            # a name that is the word, or has it among others
                            bad |= (not words.isdisjoint(tokens)) << (i if len(tokens) == 1 else i + len(BAD))
            self.asked.append(tag in BLOCK or tag in JUDGED or good > 0 or bad > 0)
            self.parent.append(stack[-1][1] if stack else -1)
            self.kind.append(_KIND.get(tag, -1))
            self.depth.append(len(stack))
            self.good.append(good)
            self.bad.append(bad)
            self.label.append(label)
            self.end.append(0)
            stack.append((tag, len(self.parent) - 1))

        def close(n: int) -> None:
            nonlocal dropped
            while len(stack) > n:
                tag, node = stack.pop()
                self.end[node] = len(self.parent)
                dropped -= tag in DROPPED

        def said(text: str) -> None:
            if stack[-1][0] == "head" and text and not text.isspace():
                close(len(stack) - 1)
            if not dropped and text:
                self.text.append((stack[-1][1], block, entities.unescape(text) if "&" in text else text))

        open_("html", "")
        for match in _TAG.finditer(page):
            if match.start() < at:
                continue
            if not raw:
                said(page[at : match.start()])
            slash, name, attributes = match.groups()
            tag = name.lower() if name else ""
            if raw:
                if not (slash and tag == raw):
                    continue
                raw = ""
            at = match.end()
            if not tag:
                continue
            if tag in BLOCK:
                block += 1
            if slash:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == tag:
                        close(i)
                        break
                    if tag == "p" and stack[i][0] in _SCOPE:
                        break
                continue
            if tag == "html":
                continue
            if tag == "body" or (stack[-1][0] == "head" and tag not in IN_HEAD):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == "head":
                        close(i)
                        break
                    if stack[i][0] == "template":
                        break
            if tag in _ENDS_P:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == "p":
                        close(i)
                        break
                    if stack[i][0] in _SCOPE:
                        break
            if tag in _ENDS_SAME:
                same, scope = _ENDS_SAME[tag]
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] in same:
                        close(i)
                        break
                    if stack[i][0] in scope:
                        break
            if tag in VOID:
                said(" ")
            else:
                open_(tag, attributes)
                dropped += tag in DROPPED
                if tag in RAW:
                    raw = tag
        if not raw:
            said(page[at:])
        close(0)

    def features(self) -> np.ndarray:
        parent, end, kind = np.array(self.parent), np.array(self.end), np.array(self.kind)
        n, own = len(parent), np.arange(len(parent))
        root = parent < 0
        up = np.where(root, own, parent)
        page = np.cumsum(root) - 1
        top = np.flatnonzero(root)[page]
        node = np.array([t[0] for t in self.text], np.int64)
        length = np.array([len(" ".join(t[2].split())) for t in self.text], np.float64)
        marks = np.array([sum(map(t[2].count, ".,;:!?")) for t in self.text], np.float64)
        below = lambda x: np.concatenate([[0], np.cumsum(x)])[end] - np.concatenate([[0], np.cumsum(x)])[own]
        here = np.bincount(node, length, n)
        link = kind == _KIND["a"]
        opened = np.zeros(n + 1, np.int64)  # in how many links an element stands
        np.add.at(opened, own[link], 1)
        np.add.at(opened, end[link], -1)
        in_link = np.cumsum(opened)[:-1] > 0
        text, links, tags, sentences = below(here), below(np.where(in_link, here, 0)), end - own, below(np.bincount(node, marks, n))
        paragraphs, anchors, items = below(kind == _KIND["p"]), below(link), below(kind == _KIND["li"])
        flags = np.stack([kind == i for i in range(len(GROUPS))] + [np.array(self.good) > 0] + [np.array(self.bad) >> i & 1 for i in range(2 * len(BAD))], 1).astype(np.float64)
        plain = flags[:, len(GROUPS) + 1 : len(GROUPS) + 1 + len(BAD)]
        good, bad = (flags[:, 0] + flags[:, len(GROUPS)]) > 0, (flags[:, 1:5].sum(1) + plain.sum(1)) > 0

        def above(mark: np.ndarray) -> np.ndarray:
            opened = np.zeros(n + 1, np.int64)
            np.add.at(opened, own[mark] + 1, 1)
            np.add.at(opened, end[mark], -1)
            return np.cumsum(opened)[:n]

        siblings = np.bincount(up[~root], minlength=n)[up]
        alike = np.unique(up * 64 + kind + 1, return_inverse=True)[1]
        order = own - np.concatenate([[0], np.flatnonzero(root)])[page + 1]
        columns = [
            np.array(self.depth), np.log1p(text), np.log1p(tags), text / tags, links / np.maximum(text, 1), sentences / np.maximum(text, 1) * 100, np.log1p(sentences), np.log1p(paragraphs), np.log1p(anchors), np.log1p(items),
            text / np.maximum(text[top], 1), text / np.maximum(text[up], 1), siblings, np.bincount(alike)[alike], np.bincount(up, text, n)[up] / np.maximum(siblings, 1), order / np.maximum(tags[top], 1), above(good), above(bad),
        ]
        return np.concatenate([np.stack(columns, 1).astype(np.float64), flags], 1)

    def decoded(self, model: Trees) -> np.ndarray:
        """Which elements are kept."""
        asked, n = np.array(self.asked), len(self.parent)
        p = model.probability(self.features()[asked]).clip(1e-6, 1 - 1e-6)
        yes, no = np.zeros(n), np.zeros(n)
        yes[asked], no[asked] = np.log(p), np.log1p(-p)
        total = np.concatenate([[0], np.cumsum(no)])
        drop = (total[self.end] - total[:-1]).tolist()
        best, parent = yes.tolist(), self.parent
        for i in range(n - 1, -1, -1):
            if parent[i] >= 0:
                best[parent[i]] += max(best[i], drop[i])
        kept = np.zeros(n, bool)
        for i in range(n):
            # an element that is not asked goes with its parent
            kept[i] = (parent[i] < 0 or kept[parent[i]]) and (parent[i] < 0 or not asked[i] or best[i] > drop[i])
        return kept

    def texts(self, kept: np.ndarray) -> list[str]:
        edges = [*self.first[1:], len(self.parent)]
        out, page, blocks = [], 0, {}
        for node, block, text in [*self.text, (len(self.parent), -1, "")]:
            while page < len(edges) and node >= edges[page]:
                lines = (" ".join("".join(parts).split()) for parts in blocks.values())
                out.append("\n".join(line for line in lines if line))
                page, blocks = page + 1, {}
            if page < len(edges) and kept[node]:
                blocks.setdefault(block, []).append(text)
        return out


def labelled_page(rng: random.Random) -> str:
    """A page of random words in one of many layouts; ``data-label`` marks what is main text."""
    word = lambda: "".join(rng.choice(["th", "an", "er", "in", "on", "re", "es", "la", "de", "sch", "ung", "que", "ción", "é"]) for _ in range(rng.randint(1, 4)))
    words = lambda a, b: " ".join(word() for _ in range(rng.randint(a, b)))
    sentence = lambda a=4, b=18: words(a, b).capitalize() + rng.choice([".", ".", "!", "?", ", " + words(2, 8) + "."])
    prose = lambda a, b: " ".join(sentence() for _ in range(rng.randint(a, b)))
    links = lambda a, b: "".join(f'<li><a href="/{word()}">{words(1, 3)}</a></li>' for _ in range(rng.randint(a, b)))
    named = lambda *names: rng.choice([f' class="{rng.choice(names)}"', f' id="{rng.choice(names)}"', f' class="{word()} {rng.choice(names)}-{word()}"', f' class="{word()}-{rng.choice(names)}"'])
    unsaid = sorted(set().union(*BAD))  # words that also stand in names of main text
    borrowed = lambda: (lambda w: rng.choice([f"{word()}-{w}", f"{w}-{word()}", f"{w}-{word()}", f"{rng.choice(sorted(GOOD))}-{w}", f"{w}-{rng.choice(sorted(GOOD))}"]))(rng.choice(unsaid))
    layout = lambda: f"{rng.choice(sorted(LAYOUT))}-{rng.choice(unsaid)}"
    maybe = lambda p: rng.choice([f' class="{borrowed()}"', f' id="{borrowed()}"', f' class="{word()} {borrowed()}"', f' class="{borrowed()} {layout()}"']) if rng.random() < p else ""
    region = lambda tags, attributes, inside: (lambda t: f'<{t}{attributes} data-label="0">{inside}</{t}>')(rng.choice(tags))
    boilerplate = {
        "nav": lambda: region(["nav", "nav", "div", "ul"], rng.choice(["", named("nav", "menu", "navigation", "breadcrumb")]), f"<ul>{links(3, 9)}</ul>"),
        "header": lambda: region(["header", "header", "div"], named("header", "masthead", "banner"), rng.choice([f"<h1>{words(1, 4)}</h1>", f"<p>{sentence()}</p>", f"<a href='/'>{words(1, 3)}</a> {words(2, 6)}"])),
        "footer": lambda: region(["footer", "footer", "div"], rng.choice([named("footer", "copyright"), named("footer", "bottom")]), f"&copy; {words(1, 3)} &middot; {prose(1, 3)}"),
        "bare footer": lambda: f'<footer data-label="0">{rng.choice(["&copy; ", ""])}{prose(1, 3)}</footer>',
        "bare header": lambda: f'<header data-label="0">{words(1, 6)}</header>',
        "side": lambda: region(["aside", "aside", "div", "section"], named("sidebar", "widget", "related", "side"), f"<h3>{words(1, 3)}</h3>" + rng.choice([f"<ul>{links(2, 6)}</ul>", f"<p>{prose(1, 4)}</p>"])),
        "bare side": lambda: f'<aside data-label="0"><p>{prose(1, 4)}</p></aside>',
        "ad": lambda: region(["div", "div", "aside", "section", "p"], named("ad", "ads", "advert", "sponsored", "promo"), rng.choice([prose(1, 5), f"<a href='/x'>{sentence()}</a>", f"<p>{prose(1, 3)}</p>"])),
        "notice": lambda: region(["div", "div", "section", "p"], named("cookie", "consent", "notice", "alert", "newsletter", "popup"), rng.choice([prose(1, 4), f"<p>{prose(1, 3)}</p><button>{word()}</button>"])),
        "comments": lambda: region(["section", "div", "ul", "aside"], named("comments", "comment", "replies", "discussion"), "".join(f"<div{named('comment', 'reply')}><b>{word()}</b><p>{prose(1, 6)}</p></div>" for _ in range(rng.randint(1, 6)))),
        "share": lambda: region(["div", "ul", "section"], named("share", "social"), f"<ul>{links(2, 4)}</ul>"),
        "fallback": lambda: region(["noscript", "canvas", "audio", "video"], "", rng.choice([f"<p>{sentence()}</p>", sentence(), prose(1, 3)])),
        "dialog": lambda: region(["dialog"], rng.choice(["", named("consent", "popup", "modal")]), f"<p>{prose(1, 3)}</p><button>{word()}</button>"),
        "form": lambda: region(["form"], rng.choice(["", "", named("search", "login", "newsletter")]), rng.choice([f"<p>{sentence()}</p>", f"<p>{sentence()}</p>", f"<label>{words(1, 3)}</label>", f"<p>{prose(1, 3)}</p>", sentence()]) + f'<input name="q"><button>{word()}</button>'),
    }
    some = lambda names, p: "".join(boilerplate[n]() for n in names if rng.random() < p)

    def part() -> str:
        kind = rng.random()
        if kind < 0.1:  # main text under names that elsewhere are those of boilerplate, and plain lists of links
            inside = f"<h2>{words(1, 5)}</h2>" + "".join(f"<p>{prose(1, 6)}</p>" for _ in range(rng.randint(1, 4)))
            t = rng.choice(["section", "section", "div"])
            rows = "".join(f"<tr><td>{words(1, 4)}</td><td>{words(1, 6)}</td></tr>" for _ in range(rng.randint(1, 6)))
            return rng.choice([f"<{t}{maybe(0.8)}>{inside}</{t}>", f"<{t}{maybe(0.8)}>{inside}</{t}>", f"<table{maybe(0.7)}>{rows}</table>", f"<p{maybe(0.9)}>{prose(1, 5)}</p>", f"<ul>{links(2, 10)}</ul>", f"<ol{maybe(0.5)}>{''.join(f'<li>{sentence()}</li>' for _ in range(rng.randint(2, 6)))}</ol>", f"<figure><svg><text>{words(1, 4)}</text></svg><figcaption>{sentence()}</figcaption></figure>", f"<object><p>{prose(1, 3)}</p></object>"])
        if kind < 0.15:
            return f"<p>{word().capitalize()}.</p>"
        if kind < 0.62:
            return f"<p>{prose(1, 7)}" + rng.choice(["</p>", "</p>", ""])
        if kind < 0.72:
            return f"<p><b>{prose(1, 3)}<br>"
        return rng.choice([f"<h2>{words(1, 6)}</h2>", f"<ul>{''.join(f'<li>{sentence()}</li>' for _ in range(rng.randint(2, 5)))}</ul>", f"<blockquote><p>{prose(1, 3)}</p></blockquote>", f"<p>{sentence()} <a href='/x'>{words(1, 4)}</a> {sentence()}</p>", f"<table><tr><td>{words(1, 4)}</td><td>{words(1, 4)}</td></tr></table>", f"<pre>{words(3, 20)}</pre>", f"<div><p>{prose(1, 4)}</p></div>", f"<figure><figcaption>{sentence()}</figcaption></figure>", f"<p>{word()}</p>"])

    inner = "".join(part() + some(["ad", "share", "side", "fallback"], 0.04) for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 14, 25])))
    title = rng.choice([f"<h1>{words(1, 9)}</h1>", f"<h1>{words(1, 9)}</h1>", ""])
    head, tail = rng.choice([("<article>", "</article>")] * 4 + [("<main>", "</main>"), (f"<div{named('content', 'post', 'entry', 'story', 'article')}>", "</div>"), (f"<section{named('content', 'article')}>", "</section>"), ("<div>", "</div>"), (f"<main><article{named('post')}>", "</article></main>")])
    inside = some(["comments", "share", "form"], 0.08)
    if "class" not in head and "id=" not in head:
        alone = f' class="{rng.choice(unsaid)}"' if head != "<div>" and rng.random() < 0.08 else ""
        head = head.replace(">", f"{alone or maybe(0.4)}>", 1)
    elif rng.random() < 0.4:
        head = re.sub(r'(class|id)="([^"]*)"', lambda m: f'{m[1]}="{m[2]} {rng.choice([borrowed, layout])()}"', head, count=1)
    body = head.replace(">", ' data-label="1">', 1) + title + inner + inside + tail
    before = some(["header", "bare header", "nav", "notice", "ad", "form"], 0.45) + some(["fallback", "dialog"], 0.06)
    after = some(["side", "bare side", "comments", "ad", "notice", "share", "form"], 0.3) + some(["footer"], 0.4) + some(["bare footer"], 0.5)
    middle = f"{before}{body}{after}"
    if rng.random() < 0.3:
        middle = f'<div{rng.choice(["", named("page", "wrapper", "container"), maybe(1), f" class={layout()}"])}>{middle}</div>'
    if rng.random() < 0.1:
        middle = f'<form method="post" action="/{word()}"{rng.choice(["", named("page", "form")])}><input type="hidden" name="s">{middle}</form>'
    return f'<!DOCTYPE html><html lang="en"><head><title>{words(1, 8)}</title><style>p{{}}</style><script>var t="</p>";</script></head><body{rng.choice(["", "", f' class="{layout()} {borrowed()}"', f' class="{word()}"'])}>{middle}</body></html>'


@cache
def default_model(pages: int = 1000, seed: int = 11) -> Trees:
    """Trees trained on ``pages`` labelled pages (the bound on the fitting rows)."""
    rng, table = random.Random(seed), Pages()
    for _ in range(pages):
        table.add(labelled_page(rng))
    label = np.array(table.label)
    for i, p in enumerate(table.parent):
        if label[i] < 0 and p >= 0:
            label[i] = label[p]  # as the marked element it stands in
    for i in range(len(label) - 1, -1, -1):
        if label[i] == 1 and table.parent[i] >= 0 and label[table.parent[i]] < 0:
            label[table.parent[i]] = 1  # what holds main text is kept
    asked = np.array(table.asked)
    return fit(table.features()[asked], (label[asked] == 1).astype(np.float64), rounds=120, depth=5)


def main_texts(pages: list[str | None], model: Trees) -> list[str]:
    table = Pages(generated=False)
    for page in pages:
        table.add(page or "")
    return table.texts(table.decoded(model)) if pages else []


AT_ONCE = 1 << 20


def extract(pages: DataFrame, model: Trees | None = None, html_col: str = "html") -> DataFrame:
    """The table with ``text string, n_chars long`` added (columns of these names are
    replaced): the main text, blocks joined by line breaks, and its code points. A null or
    empty page, or one without main text, has an empty text."""
    trees = model or default_model()
    rest = pages.drop("text", "n_chars") if html_col not in ("text", "n_chars") else pages
    at = rest.columns.index(html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[str] = []
            held: list[str | None] = []
            size = 0
            for page in batch.column(at):
                held.append(page.as_py())
                size += len(held[-1] or "")
                if size > AT_ONCE:
                    out += main_texts(held, trees)
                    held, size = [], 0
            out += main_texts(held, trees)
            columns = [*batch.columns, pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "text", "n_chars"])

    return on_executors(rest).mapInArrow(run, T.StructType([*rest.schema.fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]))
