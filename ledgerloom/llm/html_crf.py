"""Main text of web pages by a linear-chain conditional random field.

A page is cut into leaf blocks: the runs of text between block-level tags,
each with its open ancestors.  Every block has features of its ancestors
(tags, roles, what class and id names speak of, the innermost of these) and of
its text (length, links, punctuation).  A two-label linear-chain CRF with
these state features and label transitions is fitted to labelled pages by
forward-backward gradients; Viterbi decoding labels the blocks of a page
jointly, and the blocks labelled as main text are the result.

The labelled pages are written by ``labelled_pages``: a set of common layouts
with invented words, their main text marked by comments that only training
reads.

Text rules: character references are decoded, white space inside a block
becomes one space, ends are trimmed, empty blocks vanish, blocks are joined by
one line feed.  ``br`` is white space.  Comments, scripts, styles and other
raw or hidden elements never give text; a tag cut off by the end of the page
is dropped.

Defined results: null and empty html give the empty text; null ``page_id`` and
``url`` are kept; repeated rows are extracted each; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_right
from collections import Counter
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, pick, prepare

#: Elements that end the block before and after them (fixed list of HTML).
BLOCK = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search
section select summary table tbody td tfoot th thead tr ul""".split())
VOID = {"hr", "br", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
#: Elements whose whole content is no text of the page.
RAW = "script|style|template|textarea|title"
#: Open elements that a new element closes.
SCOPES = ("ul", "ol", "dl", "table", "select", "div", "section", "article")
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
#: What container tags, roles, class and id words speak of (fixed lists).
SPEAKS = {
    "nav": "nav menu navbar navigation breadcrumb breadcrumbs toolbar pager pagination tabs",
    "head": "header masthead banner topbar brand logo",
    "foot": "footer copyright legal contentinfo colophon imprint",
    "side": "aside sidebar widget related recommended popular trending complementary rail more",
    "ad": "ad ads advert adverts advertisement sponsor sponsored promo promotion teaser",
    "notice": "cookie cookies consent notice alert gdpr popup modal dialog overlay warning",
    "form": "form login signup subscribe newsletter search contact fieldset poll",
    "comment": "comment comments reply replies respond disqus discussion responses feedback",
    "share": "share sharing social follow byline author meta tags",
    "main": "article main content post entry story",
}
_GROUP = {w: g for g, words in SPEAKS.items() for w in words.split()}
#: What stands behind a tag's name: a quote opens a value behind ``=`` only, so
#: an apostrophe in an unquoted value ends nothing.  Nothing is tried twice.
_INSIDE = r"(?>[^>=]+|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*+"
_TOKEN = re.compile(
    r"<!--(?P<comment>.*?)(?:-->|\Z)|<(?P<raw>" + RAW + r")\b" + _INSIDE + r"(?<!/)>(?:.*?</(?P=raw)\s*>|.*\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>" + _INSIDE + r")>|<[!?][^>]*>|</[^>]*>"
    r"|<(?:/?[a-zA-Z]|!|\?)[^>]*\Z", re.S | re.I)
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")


def _speaks(tag: str, attrs: str) -> list[str]:
    groups = [_GROUP[tag]] if tag in _GROUP else []
    if attrs and ("=" in attrs):
        for m in _ATTR.finditer(attrs):
            for word in _PART.findall(m[2] or m[3] or m[4] or ""):
                group = _GROUP.get(word.lower())
                if group and group not in groups:
                    groups.append(group)
    return groups


class _Open:
    """The open elements, with what a block is told about them: kept up to
    date at every start and end, so a block costs the same at any depth."""

    def __init__(self):
        self.stack: list[tuple[str, list[str]]] = []
        self.places: dict[str, list[int]] = {}          # tag -> where it is open
        self.about: Counter = Counter()                 # what is spoken of -> how often
        self.speaking: list[list[str]] = []             # of the elements that speak of something
        self.seen = None

    def start(self, tag: str, attrs: str) -> None:
        while self.stack and self.stack[-1][0] == "p":
            self.cut(len(self.stack) - 1)
        if tag in CLOSES:
            scope = max((self.places[t][-1] for t in SCOPES if self.places.get(t)), default=-1)
            inside = [p[i] for t in CLOSES[tag] if (p := self.places.get(t)) and (i := bisect_right(p, scope)) < len(p)]
            if inside:
                self.cut(min(inside))
        groups = _speaks(tag, attrs)
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, groups))
        self.about.update(groups)
        if groups:
            self.speaking.append(groups)
        self.seen = None

    def end(self, tag: str) -> None:
        if self.places.get(tag):
            self.cut(self.places[tag][-1])

    def cut(self, place: int) -> None:
        """Close the element at ``place`` and all inside it."""
        while len(self.stack) > place:
            tag, groups = self.stack.pop()
            self.places[tag].pop()
            if groups:
                self.about.subtract(groups)
                self.speaking.pop()
        self.seen = None

    def context(self) -> tuple:
        """(tags, what they speak of, that of the innermost, innermost tag)."""
        if self.seen is None:
            self.seen = (frozenset(t for t, p in self.places.items() if p), frozenset(g for g, n in self.about.items() if n > 0),
                         self.speaking[-1] if self.speaking else (), self.stack[-1][0] if self.stack else "none")
        return self.seen


def blocks(html: str, marks: bool = True) -> list[tuple[str, tuple, float, bool]]:
    """(text, context of the open elements, share of linked characters,
    marked) of the leaf blocks in page order.  ``marks``: comments that
    enclose main text are read (of labelled pages only)."""
    out, tree, parts = [], _Open(), []
    linked = total = 0
    in_link = marked = False
    at = 0

    def close() -> None:
        nonlocal linked, total, in_link
        if parts:
            text = _SPACE.sub(" ", "".join(parts)).strip()
            if text:
                out.append((text, tree.context(), linked / max(total, 1), marked))
            parts.clear()
        linked = total = 0
        in_link = False

    def add(raw: str) -> None:
        nonlocal linked, total
        text = unescape(raw) if "&" in raw else raw
        parts.append(text)
        total += len(text)
        if in_link:
            linked += len(text)

    for m in _TOKEN.finditer(html):
        if m.start() > at:
            add(html[at:m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            if marks and m["comment"] in ("main", "/main"):
                close()
                marked = m["comment"] == "main"
            continue
        tag = tag.lower()
        if tag == "br":
            parts.append(" ")
        elif tag == "a":
            in_link = not m["end"]
        elif tag in BLOCK or tag in _GROUP:
            close()
            if m["end"]:
                tree.end(tag)
            elif tag not in VOID and not m["attrs"].endswith("/"):
                tree.start(tag, m["attrs"])
    if at < len(html):
        add(html[at:])
    close()
    return out


def block_features(page: list) -> list[list[str]]:
    """Feature names of every block of a page."""
    out = []
    for i, (text, (tags, groups, inner, last), links, _) in enumerate(page):
        names = {f"in:{t}" for t in tags if t not in ("html", "body")}
        names |= {f"about:{g}" for g in groups}
        names |= {f"inner:{g}" for g in inner} or {"inner:none"}
        names.add("aside:yes" if groups - {"main"} else "aside:no")
        if "main" in groups:
            names.add("main:last" if "main" in inner and len(inner) == 1 else "main:outer")
        words = text.count(" ") + 1
        names.add(f"words:{'1' if words < 3 else '3' if words < 6 else '6' if words < 16 else '16'}")
        names.add(f"links:{'none' if links == 0 else 'some' if links < 0.5 else 'most'}")
        names.add("stop" if text[-1] in ".!?…\"'»”:" else "open")
        names.add(f"tag:{last}")
        if "©" in text:
            names.add("sign")
        if i == 0:
            names.add("first")
        if i == len(page) - 1:
            names.add("last")
        out.append(sorted(names))
    return out


class ChainCRF:
    """Two labels (0: other, 1: main text), state features and transitions."""

    def __init__(self, names: dict[str, int], state: np.ndarray, move: np.ndarray, start: np.ndarray):
        self.names, self.state, self.move, self.start = names, state, move, start

    def scores(self, features: list[list[str]]) -> np.ndarray:
        known = self.names
        return np.array([self.state[[known[f] for f in fs if f in known]].sum(axis=0) for fs in features])

    def viterbi(self, features: list[list[str]]) -> list[int]:
        """The most likely label of every block, jointly."""
        (s00, s01), (s10, s11) = self.move.tolist()
        rows = self.scores(features).tolist()
        a, b = rows[0][0] + self.start[0], rows[0][1] + self.start[1]
        back = []
        for x, y in rows[1:]:
            from0, from1 = a + s00 >= b + s10, a + s01 >= b + s11
            back.append((0 if from0 else 1, 0 if from1 else 1))
            a, b = (a + s00 if from0 else b + s10) + x, (a + s01 if from1 else b + s11) + y
        label = 0 if a >= b else 1
        path = [label]
        for step in reversed(back):
            label = step[label]
            path.append(label)
        return path[::-1]


def fit(pages: list[tuple[list[list[str]], list[int]]], epochs: int = 60, penalty: float = 0.002) -> ChainCRF:
    """Maximise the penalised conditional likelihood with Adam."""
    names = {f: i for i, f in enumerate(sorted({f for fs, _ in pages for x in fs for f in x}))}
    coded = [([np.array([names[f] for f in x]) for x in fs], np.array(ys)) for fs, ys in pages]
    state, move, start = np.zeros((len(names), 2)), np.zeros((2, 2)), np.zeros(2)
    params = [state, move, start]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    lse = lambda x, axis: np.log(np.exp(x - x.max(axis=axis, keepdims=True)).sum(axis=axis)) + x.max(axis=axis)
    for t in range(1, epochs + 1):
        grads = [penalty * state * len(pages), penalty * move * len(pages), np.zeros(2)]
        for xs, ys in coded:
            n = len(ys)
            e = np.array([state[x].sum(axis=0) for x in xs])
            fore, aft = np.zeros((n, 2)), np.zeros((n, 2))
            fore[0] = start + e[0]
            for i in range(1, n):
                fore[i] = lse(fore[i - 1][:, None] + move, 0) + e[i]
            for i in range(n - 2, -1, -1):
                aft[i] = lse(move + (e[i + 1] + aft[i + 1])[None], 1)
            z = lse(fore[-1], 0)
            p = np.exp(fore + aft - z)
            p[np.arange(n), ys] -= 1
            for x, d in zip(xs, p):
                grads[0][x] += d
            grads[2] += p[0]
            if n > 1:
                pair = np.exp(fore[:-1, :, None] + move + (e + aft)[1:, None, :] - z).sum(axis=0)
                np.add.at(pair, (ys[:-1], ys[1:]), -1)
                grads[1] += pair
        for param, grad, (m, v) in zip(params, grads, moments):
            grad = grad / len(pages)
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            param -= 0.15 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    return ChainCRF(names, state, move, start)


def labelled_pages(seed: int = 3, count: int = 160) -> list[str]:
    """Pages of common layouts with invented words; ``<!--main-->`` and
    ``<!--/main-->`` enclose the main text."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["ta", "ro", "mi", "en", "st", "ul", "ka", "ve"]) for _ in range(rng.randint(1, 4)))
    words = lambda a, b: " ".join(word() for _ in range(rng.randint(a, b)))
    line = lambda a=4, b=40: words(a, b).capitalize() + rng.choice([".", ".", ".", "", "!", "?"])
    link = lambda: f'<a href="/{word()}">{words(1, 3)}</a>'
    links = lambda n: "".join(f"<li>{link()}</li>" for _ in range(n))
    yes = lambda p: rng.random() < p

    def body_blocks() -> str:
        out = []
        for _ in range(rng.randint(1, 12)):
            kind = rng.random()
            if kind < 0.72:
                text = line(1, 3) if yes(0.15) else line(3, 60)
                if yes(0.2):
                    text += " " + link() + " " + words(2, 8) + "."
                out.append(f"<p>{text}</p>" if yes(0.8) else f"<p><b>{text}<br>")
            elif kind < 0.8:
                out.append(f"<h2>{words(1, 6)}</h2>")
            elif kind < 0.86:
                out.append("<ul>" + "".join(f"<li>{line(2, 12)}</li>" for _ in range(rng.randint(2, 4))) + "</ul>")
            elif kind < 0.9:
                out.append(f"<blockquote>{line()}</blockquote>")
            elif kind < 0.94:
                out.append(f"<pre>{words(3, 20)}</pre>")
            elif kind < 0.97:
                out.append(f"<figure><figcaption>{line(3, 9)}</figcaption></figure>")
            else:
                out.append("<table>" + "".join(f"<tr><td>{words(1, 3)}</td><td>{words(1, 3)}</td></tr>"
                                               for _ in range(3)) + "</table>")
        return "".join(out)

    def inset() -> str:
        """Foreign blocks that may stand inside or beside the main text."""
        return rng.choice([
            lambda: f'<div class="{rng.choice(["ad", "ads", "advert", "sponsored", "promo"])}">{line(2, 14)}</div>',
            lambda: f'<div class="{rng.choice(["share", "social"])}"><ul>{links(3)}</ul></div>',
            lambda: f'<aside class="{rng.choice(["related", "sidebar", "x"])}"><h3>{words(1, 3)}</h3><p>{line(2, 25)}</p><ul>{links(3)}</ul></aside>',
            lambda: f'<form action="/s"><label>{words(1, 3)}</label><input name="q"><button>{word()}</button><p>{line(2, 9)}</p></form>',
            lambda: f'<div class="newsletter"><p>{line(3, 15)}</p></div>',
            lambda: f'<section class="comments"><h3>{words(1, 2)}</h3>' + "".join(
                f'<div class="comment"><p>{line(1, 30)}</p></div>' for _ in range(rng.randint(1, 3))) + "</section>",
            lambda: f'<div id="cookie-notice"><p>{line(4, 25)}</p><button>{word()}</button></div>',
        ])()

    def before() -> str:
        out = []
        if yes(0.8):
            out.append(f"<nav><ul>{links(rng.randint(3, 6))}</ul></nav>" if yes(0.6)
                       else f'<div class="{rng.choice(["menu", "nav", "navbar"])}">{"".join(link() + " " for _ in range(4))}</div>')
        if yes(0.5):
            out.append(f'<header><h1>{words(1, 4)}</h1><p>{line(2, 10)}</p></header>' if yes(0.6)
                       else f'<div id="header"><p>{words(1, 5)}</p></div>')
        out += [inset() for _ in range(rng.randint(0, 2))]
        rng.shuffle(out)
        return "".join(out)

    def after() -> str:
        out = [inset() for _ in range(rng.randint(0, 2))]
        foot = f"&copy; {word()}.example &middot; {line(2, 12)}"
        if yes(0.85):
            out.append(f"<footer>{foot}</footer>" if yes(0.6) else f'<div class="footer"><p>{foot}</p></div>')
        return "".join(out)

    pages = []
    for _ in range(count):
        title = f"<h1>{words(2, 9).capitalize()}{rng.choice(['', '.'])}</h1>" if yes(0.8) else ""
        inner = title + body_blocks()
        if yes(0.35):
            inner += f"<!--/main-->{inset()}<!--main-->{body_blocks() if yes(0.6) else ''}"
        kind = rng.random()
        if kind < 0.45:
            shell = ("<article>", "</article>")
        elif kind < 0.6:
            shell = ("<main>", "</main>")
        elif kind < 0.85:
            shell = (f'<div class="{rng.choice(["content", "post", "entry-content", "article-body", "story"])}">', "</div>")
        elif kind < 0.93:
            shell = ("<div>", "</div>")
        else:
            shell = ("<section>", "</section>")
        pages.append(f"<html><head><title>{words(2, 5)}</title></head><body>{before()}{shell[0]}<!--main-->{inner}"
                     f"<!--/main-->{shell[1]}{after()}</body></html>")
    return pages


@lru_cache(maxsize=1)
def default_model() -> ChainCRF:
    """The CRF fitted to the labelled pages."""
    cut = [blocks(p) for p in labelled_pages()]
    return fit([(block_features(page), [int(b[3]) for b in page]) for page in cut if page])


def main_text(html: str, model: ChainCRF) -> str:
    page = blocks(html, marks=False)
    if not page:
        return ""
    labels = model.viterbi(block_features(page))
    return "\n".join(text for (text, *_), label in zip(page, labels) if label)


def _extract(model: ChainCRF):
    def run(batches):
        for batch in batches:
            for part in byte_slices(batch, "html", 4 << 20):
                texts = [main_text(h, model) if h else "" for h in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])
    return run


def extract_pages(pages: DataFrame, model: ChainCRF | None = None) -> DataFrame:
    """page_id, url, text (main text), n_chars (its code points) of every row."""
    prepare(pages.sparkSession)
    rows = pick(pages, page_id="page_id", url="url", html="html").withColumn("page_id", F.col("page_id").cast("long"))
    return rows.mapInArrow(_extract(model or default_model()), "page_id long, url string, text string, n_chars long")
