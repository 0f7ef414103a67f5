"""Main text of web pages: flat blocks with word counts and link densities, and a decision tree.

Blocks in menus, footers, side notes, forms and hidden elements go first, on every page. The tree then
judges each of the rest by its own words, links, text density and place and by those of the two blocks
on either side. It is grown from the blocks of the hand-marked pages in labelled_pages.txt, parsed as all others are.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?:(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|(?P<loose>[^>]*+)(?:>|\Z))",
    re.S,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
SPACE = re.compile(r"\s+")

# HTML element names by what they mean for blocks, and words of class names.
RAW = {"script", "style"}
TEXT_ONLY = {"textarea", "title"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "math", "mfrac", "mi", "mn", "mo", "mrow", "msqrt", "msub", "msup", "mtext", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
BOILER = {"nav", "footer", "aside", "button", "dialog", "menu", "select", "svg", "noscript", "iframe", "template", "object", "audio", "video", "canvas"}
ARTICLE = {"article", "main"}
#: Boiler too, unless the page's article or most of its words are inside.
FORMS = {"form", "fieldset"}
ITEMS = {"li", "td", "th", "dt", "dd"}
ENDS_P = {"address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul"}
SAME_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
LISTS = ("ul", "ol", "dl", "table")
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
HINTS = {"ad", "ads", "advert", "adverts", "advertisement", "alert", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "disqus", "footer", "gdpr", "header", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "overlay", "pager", "pagination", "popup", "promo", "promotion", "recommended", "related", "replies", "reply", "respond", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "subscription", "toolbar", "widget"}
#: Elements that hold the page or its article; names of classes say nothing of all in them.
WHOLE = {"html", "body", "main", "article"}
#: What a page is said to have or lack as a whole (no-sidebar, has-header) is no container of that kind.
STATED = ("no-", "no_", "has-", "has_", "with-", "with_", "without-")

#: Hand-marked pages, one a line between lines of =; data-main marks the blocks of main text in an
#: element, data-not those in it that are none after all.
LABELLED = "labelled_pages.txt"
#: A wrapped line has so many characters; words in a line are a block's text density.
LINE = 80
SCALES = (1.0, 0.5, 2.0)
FEATURES = ("hint", "place", "heading", "item", "density", "words", "links", "words_before", "links_before", "words_after", "links_after", "words_before2", "links_before2", "words_after2", "links_after2")


@dataclass
class Tree:
    """A binary decision tree: a share of label 1 in a leaf, else a feature and a bound."""

    share: float
    feature: int | None = None
    bound: float = 0.0
    sides: list[Tree] = field(default_factory=list)

    def __call__(self, row: tuple[float, ...]) -> float:
        node = self
        while node.feature is not None:
            node = node.sides[row[node.feature] > node.bound]
        return node.share


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, depth: int = 8, least: int = 12) -> Tree:
    """A CART classifier of rows with weights w: the cut with the lowest Gini impurity, first feature and
    bound in ties; no leaf has fewer than least rows."""
    share = float((w * y).sum() / w.sum()) if len(y) else 0.0
    if depth == 0 or len(y) < 2 * least or share in (0.0, 1.0):
        return Tree(share)
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for bound in (values[1:] + values[:-1]) / 2:
            right = x[:, f] > bound
            n = right.sum()
            if least <= n <= len(y) - least:
                impurity = sum(w[s].sum() * (m := (w[s] * y[s]).sum() / w[s].sum()) * (1 - m) for s in (right, ~right))
                if best is None or impurity < best[0] - 1e-9:
                    best = (impurity, f, float(bound))
    if best is None:
        return Tree(share)
    right = x[:, best[1]] > best[2]
    return Tree(share, best[1], best[2], [grow(x[s], y[s], w[s], depth - 1, least) for s in (~right, right)])


@dataclass
class Block:
    """A run of text between block-level tags."""

    text: str
    words: int
    links: float
    boiler: bool
    heading: bool
    item: bool
    marked: bool
    hint: int = 0
    article: int = 0

    def own(self) -> tuple[float, float]:
        return self.words, self.links


@dataclass
class Element:
    """An open element: what holds for all in it, and its place among open ones."""

    name: str
    boiler: bool
    hint: int  # number of the nearest element whose names hint at boiler
    article: int  # number of the nearest article
    link: bool
    heading: bool
    item: bool
    marked: bool


def _attributes(attrs: str) -> Iterator[tuple[str, str]]:
    for key, a, b, c in ATTRIBUTE.findall(attrs):
        yield key.lower(), a or b or c


def _hidden(attrs: str) -> bool:
    found = dict(_attributes(attrs))
    return "hidden" in found or found.get("aria-hidden", "").lower() == "true" or bool(re.search(r"display\s*:\s*none", found.get("style", "")))


def _hint(attrs: str) -> int:
    """2 if a class, id, role or label names boiler, 1 if a part of such a name does, else 0."""
    names = [n for key, value in _attributes(attrs) if key in ("class", "id", "role", "aria-label") for n in value.lower().split() if not n.startswith(STATED)]
    if any(n in HINTS for n in names):
        return 2
    return int(any(part in HINTS for n in names for part in re.split("[-_]+", n)))


def _is_article(name: str, attrs: str) -> bool:
    return name in ARTICLE or ("main" in attrs or "articleBody" in attrs) and any((k, v) in (("role", "main"), ("itemprop", "articleBody")) for k, v in _attributes(attrs))


class _Page:
    """Reads a page from its first tag to its last, in time linear in its length."""

    def __init__(self, marks: bool = False) -> None:
        self.marks = marks
        self.stack: list[Element] = []
        self.open: dict[str, list[int]] = {}  # name -> places of its open elements
        self.solid: list[int] = []  # places of open elements that aren't inline
        self.parts: list[tuple[str, bool]] = []
        self.blocks: list[Block] = []
        self.hints: list[tuple[int, int]] = [(0, 0)]  # strength, number of the hinted element around it
        self.articles: list[tuple[int, int]] = [(0, 0)]  # the article around it, the nearest hinted element
        self.endless: set[str] = set()  # names of which no close tag follows

    def around(self) -> Element:
        return self.stack[-1] if self.stack else Element("", False, 0, 0, False, False, False, False)

    def flush(self) -> None:
        """End a block."""
        if self.parts:
            text = SPACE.sub(" ", references.unescape("".join(p for p, _ in self.parts))).strip()
            if text:
                words, linked = text.count(" ") + 1, len(references.unescape("".join(p for p, link in self.parts if link)).split())
                at = self.around()
                self.blocks.append(Block(text, words, min(1.0, linked / words), at.boiler, at.heading, at.item, at.marked, at.hint, at.article))
            self.parts.clear()

    def cut(self, place: int) -> None:
        """Close all elements from a place on."""
        for e in self.stack[place:]:
            self.open[e.name].pop()
        while self.solid and self.solid[-1] >= place:
            self.solid.pop()
        del self.stack[place:]

    def last(self, *names: str) -> int:
        return max((self.open[n][-1] for n in names if self.open.get(n)), default=-1)

    def end(self, name: str) -> None:
        place = self.last(name)
        if place >= 0 and not (name in INLINE and self.solid and self.solid[-1] > place):
            self.cut(place)

    def begin(self, name: str, attrs: str) -> None:
        if name in ENDS_P and (odd := self.last("svg", "select")) >= 0:
            self.cut(odd)  # no text stands in these, so their end is missing
        if name in ENDS_P and (p := self.last("p")) >= 0 and self.solid[-1] == p:
            self.cut(p)
        elif name in SAME_ENDS and (same := self.last(*SAME_ENDS[name])) > self.last(*LISTS):
            self.cut(same)
        up = self.around()
        hint, article = up.hint, up.article
        strength = 3 if name in FORMS else _hint(attrs) if attrs and name not in WHOLE else 0
        if strength:
            self.hints.append((strength, hint))
            hint = len(self.hints) - 1
        if _is_article(name, attrs):
            self.articles.append((article, hint))
            article = len(self.articles) - 1
        boiler = up.boiler or name in BOILER or (name == "header" and not article) or (bool(attrs) and _hidden(attrs))
        marked = up.marked
        if self.marks:
            marked = (marked or "data-main" in attrs.split()) and "data-not" not in attrs.split()
        if name not in INLINE:
            self.solid.append(len(self.stack))
        self.open.setdefault(name, []).append(len(self.stack))
        self.stack.append(Element(name, boiler, hint, article, up.link or name == "a", up.heading or name in HEADINGS, name in ITEMS or (up.item and name not in ("p", "div", "section")), marked))

    def read(self, page: str) -> list[Block]:
        at, end, head = 0, len(page), False
        while at < end:
            tag = TAG.search(page, at)
            stop = tag.start() if tag else end
            if stop > at and not head:
                self.parts.append((page[at:stop], self.around().link))
            if tag is None:
                break
            at, head = tag.end(), False
            if tag["name"] is None:
                continue
            name, attrs = tag["name"].lower(), tag["attrs"] or tag["loose"] or ""
            if name in RAW or name in TEXT_ONLY:
                if not tag["close"] and not attrs.endswith("/"):
                    close = None if name in self.endless else re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                    if close is None:
                        self.endless.add(name)  # so no end of this kind is looked for again
                    if close or name in RAW:
                        at = close.end() if close else end
                    else:
                        head = True  # of an element that never ends, only the text up to the next tag goes
                continue
            if name == "br":
                self.parts.append((" ", self.around().link))
                continue
            if name not in INLINE:
                self.flush()
            if name in VOID:
                continue
            if tag["close"]:
                self.end(name)
            else:
                self.begin(name, attrs)
        self.flush()
        return self.blocks

    def misled(self) -> set[int]:
        """Hinted elements around the page's article, and forms around most words: these hints are wrong.

        The article is the article element of most words, or one in it that has more than half of
        them, if it has more words than all unhinted text outside; a list of related articles is none.
        """
        held = [0] * len(self.hints)
        for b in self.blocks:
            if not b.boiler:
                held[b.hint] += b.words
        for k in range(len(held) - 1, 0, -1):
            held[self.hints[k][1]] += held[k]
        return {k for k in range(1, len(held)) if self.hints[k][0] == 3 and 2 * held[k] > held[0]} | self._around_article()

    def _around_article(self) -> set[int]:
        words = [0] * len(self.articles)
        for b in self.blocks:
            if not b.boiler:
                words[b.article] += b.words
        for a in range(len(words) - 1, 0, -1):
            words[self.articles[a][0]] += words[a]
        if len(words) == 1:
            return set()
        best = max(range(1, len(words)), key=lambda a: (words[a], -a))
        below = [False] * len(words)
        for a in range(1, len(words)):
            below[a] = a == best or below[self.articles[a][0]]
        if words[best] <= sum(b.words for b in self.blocks if not b.boiler and not b.hint and not below[b.article]):
            return set()
        for a in range(best + 1, len(words)):  # articles are numbered in page order, so those inside come later
            if self.articles[a][0] == best and 2 * words[a] > words[best]:
                best = a
        wrong, hint = set(), self.articles[best][1]
        while hint:
            wrong.add(hint)
            hint = self.hints[hint][1]
        return wrong


def described(page: str, marks: bool = False) -> tuple[list[Block], list[tuple[float, ...]]]:
    """A page's blocks and the features of each: without those that are boiler by their tags and, where
    articles hold a third of the rest or more, without those outside."""
    read = _Page(marks)
    found = read.read(page)
    wrong, strength = read.misled(), [0] * len(read.hints)
    for k, (own, up) in enumerate(read.hints[1:], 1):
        strength[k] = 0 if k in wrong else max(own, strength[up])
    found = [b for b in found if not b.boiler and strength[b.hint] < 3]
    inside = [b for b in found if b.article]
    if sum(b.words for b in inside if strength[b.hint] < 2) * 3 >= sum(b.words for b in found if strength[b.hint] < 2) and inside:
        found = inside
    return found, _features(found, strength, len(found) == len(inside))


def _features(found: list[Block], strength: list[int], place: bool) -> list[tuple[float, ...]]:
    none = (0, 0.0)
    sizes = [none, none, *[b.own() for b in found], none, none]
    rows = []
    for k, b in enumerate(found):
        own = (strength[b.hint], place, b.heading, b.item, b.words / -(-len(b.text) // LINE), *b.own())
        rows.append((*own, *sizes[k + 1], *sizes[k + 3], *sizes[k], *sizes[k + 4]))
    return rows


def labelled() -> list[str]:
    """The hand-marked pages."""
    return re.split(r"\n=+\n", resources.files(__package__).joinpath(LABELLED).read_text(encoding="utf-8").strip())


def train(pages: list[str] | None = None) -> Tree:
    """The tree of the hand-marked pages; a block weighs as much as the root of its words.

    A page without an article counts twice: as it is, and as if its main text were in one. Each block
    counts with its own and its neighbours' words, and with SCALES times as many.
    """
    x, y = [], []
    for page in labelled() if pages is None else pages:
        found, rows = described(page, marks=True)
        marked = [b for b in found if b.marked]
        x += rows
        y += [b.marked for b in found]
        if not any(b.article for b in found):
            x += _features(marked, [0] * (1 + max(b.hint for b in found)), True)
            y += [True] * len(marked)
    rows = np.array(x, dtype=float)
    counts = ["words" in n for n in FEATURES]
    rows = np.concatenate([np.where(counts, np.ceil(rows * s), rows) for s in SCALES])
    return grow(rows, np.array(y * len(SCALES), dtype=float), np.sqrt(rows[:, FEATURES.index("words")]))


def main_text(page: str | None, tree: Tree) -> str:
    """The page's blocks that the tree takes for main text, one a line."""
    found, rows = described(page) if page else ([], [])
    return "\n".join(b.text for b, row in zip(found, rows, strict=True) if tree(row) > 0.5)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    A null or empty page, and one without main text, has an empty text. Any text is taken, however
    broken the markup: an open tag ends with the page, and only an unclosed script or style hides the
    rest. Repeated rows and null ids are pages of their own; an empty table gives no rows; other
    columns are not looked at.
    """
    tree = train()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p, tree) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, type=pa.string()), pa.array([len(t) for t in texts], type=pa.int64())], names=[page_id, url, "text", "n_chars"])

    kept = pages.select(F.col(page_id), F.col(url), F.col(html))
    schema = T.StructType([*kept.schema.fields[:2], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return kept.mapInArrow(run, schema)
