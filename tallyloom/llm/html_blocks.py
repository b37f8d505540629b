"""Main text of web pages from flat text blocks.

A page is cut into blocks at block-level tags.  Each block has its number of words and its link
density, those of the blocks before and after it, and two marks from the elements around it: page
furniture (menus, footers, forms, adverts, comments and the like) or an article.  A small decision
tree, trained on the labelled blocks below, tells main text from the rest.

Markup is read with a tolerant scanner: unknown, unclosed and broken tags never fail, time grows with the
page, and scripts, styles, comments and hidden elements give no text.  Pages are independent, so the work is one pass
over the table.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.llm.registry import query, table

# Names from the HTML standard, and usual names of page furniture and of articles.
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main "
    "menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
ENDS_PARAGRAPH = BLOCK_TAGS - frozenset("html head body".split())
_BARRIERS = ENDS_PARAGRAPH - {"p"}
SILENT = frozenset("head svg math object audio video canvas select button datalist".split())
FURNITURE_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
ARTICLE_TAGS = frozenset("article main".split())
FURNITURE_NAMES = frozenset(
    "ad ads adv advert advertisement adverts adbox banner breadcrumb breadcrumbs comment comments consent "
    "contentinfo cookie cookies copyright disqus footer form header masthead menu menubar modal nav navbar "
    "navigation navigation newsletter notice notices pager pagination popup promo promoted promotion "
    "recommended related replies reply search share sharing sidebar signup skip social sponsor sponsored "
    "subscribe tags toolbar widget widgets toc alert complementary respond".split()
)
ARTICLE_NAMES = frozenset("article main content post entry story body text".split())
# A header inside an article is its own; what follows a modifier says what a layout has or lacks.
HEADER_NAMES = frozenset("header masthead banner".split())
MODIFIERS = frozenset("has with without no not non hide show".split())
# How firmly furniture holds: an article element resets what only wraps, a main element also teasers.
FIRM_TAGS = frozenset("nav footer aside menu dialog".split())
TEASER_NAMES = frozenset(
    "comment comments disqus replies reply respond related recommended promo promoted sponsored sidebar nav navbar "
    "navigation menu footer complementary contentinfo".split()
)
WRAPS, TEASER, FIRM = 0, 1, 2
# First words of names that say what an article is about; they mark nothing.
TAXONOMY = frozenset("tag category cat format status type author term topic".split())
# Stands for any element that ends a paragraph, but paragraphs themselves.
_BARRIER = "#"

# A small labelled table of blocks: words, link density, words and link density of the block before
# and of the block after, marks (furniture, article), and 1 for main text.
LABELLED = """
1 1.0 0 0.0 1 1.0 1 0 0
1 1.0 1 1.0 1 1.0 1 0 0
2 1.0 1 1.0 3 1.0 0 0 0
3 1.0 2 1.0 2 1.0 0 0 0
1 1.0 1 1.0 9 0.0 1 0 0
4 1.0 2 1.0 6 0.0 0 0 0
6 0.8 3 1.0 4 1.0 0 0 0
12 0.9 6 1.0 3 1.0 0 0 0
9 0.0 1 1.0 12 0.0 1 0 0
14 0.1 1 1.0 8 0.0 1 0 0
25 0.0 4 1.0 70 0.0 1 0 0
60 0.0 2 1.0 80 0.0 1 0 0
11 0.0 90 0.0 0 0.0 1 0 0
8 0.2 40 0.0 0 0.0 1 0 0
30 0.0 110 0.0 22 0.0 1 0 0
45 0.0 30 0.0 28 0.0 1 0 0
5 0.0 10 0.0 7 0.0 1 0 0
2 0.0 5 0.0 6 0.0 1 0 0
18 0.3 9 1.0 5 1.0 1 0 0
70 0.0 60 0.0 12 0.0 1 0 0
3 0.0 1 1.0 2 1.0 0 0 0
4 0.0 2 1.0 3 1.0 0 0 0
5 0.2 60 0.0 2 1.0 0 0 0
7 0.6 50 0.0 4 1.0 0 0 0
6 0.0 4 1.0 0 0.0 0 0 0
2 0.5 3 1.0 5 0.0 0 0 0
12 0.0 9 0.0 70 0.0 0 1 1
8 0.0 1 1.0 64 0.0 0 1 1
5 0.0 14 0.0 52 0.0 0 1 1
2 0.0 40 0.0 1 0.0 0 1 1
1 0.0 60 0.0 80 0.0 0 1 1
1 0.0 1 1.0 30 0.0 0 1 1
3 0.0 20 0.0 0 0.0 0 1 1
9 0.0 80 0.0 11 0.0 0 1 1
40 0.0 12 0.0 66 0.0 0 1 1
70 0.0 40 0.0 90 0.0 0 1 1
120 0.0 70 0.0 11 0.0 0 1 1
95 0.1 9 0.0 60 0.0 0 1 1
30 0.3 50 0.0 40 0.0 0 1 1
15 0.5 44 0.0 38 0.0 0 1 1
4 0.4 33 0.0 21 0.0 0 1 1
10 1.0 60 0.0 55 0.0 0 1 1
2 1.0 45 0.1 60 0.0 0 1 1
64 0.0 6 0.5 70 0.0 0 0 1
80 0.0 64 0.0 75 0.0 0 0 1
55 0.1 2 1.0 48 0.0 0 0 1
35 0.0 60 0.0 50 0.0 0 0 1
22 0.0 41 0.0 66 0.0 0 0 1
12 0.0 70 0.0 58 0.0 0 0 1
6 0.0 66 0.0 71 0.0 0 0 1
9 0.0 2 1.0 60 0.0 0 0 1
7 0.0 5 1.0 48 0.0 0 0 1
40 0.2 30 0.0 9 0.0 0 0 1
28 0.0 33 0.0 4 1.0 0 0 1
50 0.0 0 0.0 80 0.0 1 0 0
34 0.0 2 1.0 45 0.0 1 0 0
26 0.1 3 1.0 90 0.0 1 0 0
80 0.0 75 0.0 60 0.0 1 0 0
65 0.0 50 0.0 55 0.0 1 0 0
12 0.0 44 0.0 33 0.0 1 0 0
4 0.0 8 0.0 31 0.0 1 0 0
90 0.0 85 0.0 0 0.0 1 0 0
2 1.0 1 1.0 40 0.0 1 0 0
1 1.0 2 1.0 66 0.0 1 0 0
8 1.0 60 0.0 9 1.0 0 0 0
9 1.0 8 1.0 7 1.0 0 0 0
3 1.0 5 1.0 60 0.0 0 0 0
2 1.0 2 1.0 75 0.0 0 0 0
33 0.0 70 0.0 14 0.0 0 0 1
45 0.0 50 0.0 18 0.0 0 0 1
38 0.0 44 0.0 2 0.0 0 0 1
52 0.0 33 0.0 0 0.0 0 0 1
26 0.0 40 0.0 20 0.0 0 0 1
18 0.0 25 0.0 30 0.0 0 0 1
14 0.0 30 0.0 12 0.0 0 0 1
11 0.0 28 0.0 26 0.0 0 0 1
8 0.0 3 1.0 35 0.0 0 0 1
70 0.0 0 0.0 0 0.0 0 0 1
24 0.2 60 0.0 22 0.0 0 0 1
16 0.0 48 0.0 0 0.0 0 0 1
"""
FEATURES = ("words", "density", "words_before", "density_before", "words_after", "density_after", "furniture", "article")

_TAG = re.compile(r"(/?)([a-zA-Z][^\s/><]*+)")
_UP_TO_QUOTE = re.compile(r"[^>\"']*+")
_ATTRIBUTE = re.compile(r"([^\s=\"'<>/]++)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))|([^\s=\"'<>/]++)")
_NAME = re.compile(r"[a-z]+")
_FORM_PART = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1|\Z)|<(/form|article|main|div|section)\b([^>]*)", re.S | re.I)


@dataclass
class Block:
    parts: list[str] = field(default_factory=list)
    links: list[str] = field(default_factory=list)
    furniture: bool = False
    article: bool = False

    @property
    def text(self) -> str:
        return " ".join("".join(self.parts).split())


@dataclass(slots=True)
class _Open:
    tag: str
    silent: bool
    link: bool
    furniture: bool
    article: bool
    hold: int = WRAPS


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        name = (m[1] or m[5]).lower()
        found.setdefault(name, next((v for v in (m[2], m[3], m[4]) if v is not None), ""))
    return found


def _names(attributes: dict[str, str]) -> list[list[str]]:
    """The words of each class, id and role name, up to a modifier."""
    found = []
    for name in " ".join(attributes.get(k, "") for k in ("class", "id", "role")).lower().split():
        words = _NAME.findall(name)
        cut = next((i for i, w in enumerate(words) if w in MODIFIERS), len(words))
        if cut and not (cut > 1 and words[0] in TAXONOMY):
            found.append(words[:cut])
    return found


def _furniture_names(names: list[list[str]], in_article: bool) -> set[str]:
    """Names of page furniture that begin or end a name; an article's header is none."""
    found = {w for words in names for w in (words[0], words[-1]) if w in FURNITURE_NAMES}
    if in_article or any(words[-1] in HEADER_NAMES and words[0] in ARTICLE_NAMES for words in names):
        found -= HEADER_NAMES
    return found


def _names_article(words: list[str]) -> bool:
    """Whether a name says that the element is an article, and nothing else."""
    return ARTICLE_NAMES.issuperset(words) and bool(set(words) - {"content", "body", "text"})


def _is_article(tag: str, attributes: dict[str, str]) -> bool:
    return tag in ARTICLE_TAGS or attributes.get("role", "").strip().lower() in ARTICLE_TAGS


def _opened(tag: str, attributes: dict[str, str], around: _Open, around_article: bool = False) -> _Open:
    """How the element changes what holds around it; the innermost mark counts.

    An article or main element is an article also inside furniture that only wraps it, but not in menus,
    footers, asides and, unless it is the main one, comments and teasers.  A form is no mark with
    ``around_article``.  An article element keeps its text whatever its names, but those of comments and
    teasers; so does an element with a name that is wholly an article's.
    """
    style = attributes.get("style", "").lower().replace(" ", "")
    hidden = "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true"
    silent = around.silent or tag in SILENT or hidden or "display:none" in style or "visibility:hidden" in style
    furniture, article, hold = around.furniture, around.article, around.hold
    if tag in BLOCK_TAGS and tag not in ("html", "body"):
        names = _names(attributes)
        marks = _furniture_names(names, around.article)
        own_header = tag == "header" and not around.article
        element = _is_article(tag, attributes)
        if element or marks.isdisjoint(TEASER_NAMES) and any(map(_names_article, names)):
            marks &= TEASER_NAMES
        if tag == "form" and around_article:
            pass
        elif tag in FURNITURE_TAGS or own_header or marks and not (element and marks <= HEADER_NAMES):
            furniture, article = True, False
            hold = max(hold, FIRM if tag in FIRM_TAGS else TEASER if marks & TEASER_NAMES else WRAPS)
        elif element and hold <= (TEASER if "main" in (tag, attributes.get("role", "").strip().lower()) else WRAPS):
            furniture, article, hold = False, True, WRAPS
        elif not furniture and any(not ARTICLE_NAMES.isdisjoint(words) for words in names):
            article = True
    return _Open(tag, silent, around.link or tag == "a", furniture, article, hold)


def _form_parts(page: str) -> tuple[list[int], list[int]]:
    """Where forms end and where articles begin, by elements or by whole names."""
    ends, articles = [], []
    for m in _FORM_PART.finditer(page):
        tag = (m[2] or "").lower()
        if tag == "/form":
            ends.append(m.start())
        elif tag:
            attributes = _attributes(m[3])
            if any(map(_names_article, _names(attributes))) or _is_article(tag, attributes):
                articles.append(m.start())
    return ends, articles


class _Tokens:
    """Tags and comments of a page in order; time grows with the page, whatever it holds."""

    def __init__(self, page: str) -> None:
        self.page, self.last, self.quotes = page, page.rfind(">"), True

    def _end(self, at: int) -> int:
        """The place after a tag whose attributes begin at ``at``.

        Once a tag's quotes turn out never to close, quotes are no longer looked at.
        """
        page, place = self.page, at
        while self.quotes:
            place = _UP_TO_QUOTE.match(page, place).end()
            if page[place : place + 1] == ">":
                return place + 1
            closed = page.find(page[place], place + 1) if place < len(page) else -1
            if closed < 0:
                self.quotes = False
            place = closed + 1
        return page.find(">", at) + 1

    def after(self, at: int) -> tuple[int, int, str, str | None, str] | None:
        """Start, end, slash, name and attributes of the next tag; a comment has no name."""
        page = self.page
        while (start := page.find("<", at)) >= 0:
            if page.startswith("<!--", start):
                return start, page.find("-->", start + 4) + 3 if page.find("-->", start + 4) >= 0 else len(page), "", None, ""
            if page[start + 1 : start + 2] in ("!", "?"):
                return start, page.find(">", start) + 1 or len(page), "", None, ""
            name = _TAG.match(page, start + 1) if start < self.last else None
            if name and name.end() <= self.last:
                end = self._end(name.end())
                return start, end, name[1], name[2], page[name.end() : end - 1]
            at = start + 1
        return None


def blocks_of(page: str | None) -> list[Block]:
    """Text blocks in page order; blocks without words are left out."""
    stack = [_Open("", False, False, False, False)]
    found: list[Block] = []
    current = Block()

    def close() -> None:
        nonlocal current
        if current.parts:
            found.append(current)
        current = Block()

    def say(text: str) -> None:
        top = stack[-1]
        if top.silent or not text:
            return
        if not current.parts:
            current.furniture, current.article = top.furniture, top.article
        text = html.unescape(text)
        current.parts.append(text)
        if top.link:
            current.links.append(text)

    places: dict[str, list[int]] = {}  # where the open elements of each tag are in the stack

    def enter(opened: _Open) -> None:
        for key in (opened.tag, _BARRIER) if opened.tag in _BARRIERS else (opened.tag,):
            places.setdefault(key, []).append(len(stack))
        stack.append(opened)

    def last(key: str) -> int:
        return places[key][-1] if places.get(key) else 0

    def leave(tag: str, *stops: str) -> None:
        """Close the innermost element of the tag and all in it, unless a stop stands in between."""
        depth = last(tag)
        if depth and all(depth >= last(stop) for stop in stops):
            for opened in stack[depth:]:
                places[opened.tag].pop()
                if opened.tag in _BARRIERS:
                    places[_BARRIER].pop()
            del stack[depth:]

    page, at = page or "", 0
    tokens = _Tokens(page)
    forms: tuple[list[int], list[int]] | None = None

    def encloses_article() -> bool:
        nonlocal forms
        forms = forms or _form_parts(page)
        ends, articles = forms
        end, first = bisect_left(ends, at), bisect_left(articles, at)
        return first < len(articles) and (end == len(ends) or articles[first] < ends[end])

    while at < len(page):
        token = tokens.after(at)
        if token is None:
            say(page[at:])
            break
        start, end, ends, tag, raw = token
        say(page[at:start])
        at = end
        if tag is None:
            continue
        tag = tag.lower()
        if ends:
            if tag in BLOCK_TAGS:
                close()
            # A closing inline tag does not reach out of the block around it.
            leave(tag, *(() if tag in BLOCK_TAGS else (_BARRIER,)))
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b", re.I).search(page, at)
            at = len(page) if end is None else page.find(">", end.end()) + 1 or len(page)
            continue
        if tag == "br":
            say(" ")
        if tag in BLOCK_TAGS:
            close()
            if tag in ENDS_PARAGRAPH:
                leave("p", _BARRIER)
            if tag in ("li", "dt", "dd", "option", "tr", "td", "th"):
                leave(tag, "ul", "ol", "dl", "table", "select", *(("tr",) if tag in ("td", "th") else ()))
        if tag == "a":
            leave("a", _BARRIER, "p")
        if tag not in VOID and not raw.rstrip().endswith("/"):
            enter(_opened(tag, _attributes(raw), stack[-1], tag == "form" and encloses_article()))
        elif tag not in VOID and tag not in BLOCK_TAGS and tag not in ("svg", "math"):
            enter(_opened(tag, _attributes(raw), stack[-1]))
    close()
    return [b for b in found if b.text]


def features_of(blocks: list[Block]) -> list[tuple[float, ...]]:
    words = [len(b.text.split()) for b in blocks]
    density = [min(1.0, len("".join(" ".join(b.links).split())) / max(1, len("".join(b.text.split())))) for b in blocks]
    around = lambda values, i: float(values[i]) if 0 <= i < len(values) else 0.0
    return [
        (float(words[i]), density[i], around(words, i - 1), around(density, i - 1), around(words, i + 1),
         around(density, i + 1), float(b.furniture), float(b.article))
        for i, b in enumerate(blocks)
    ]


@dataclass(frozen=True)
class Tree:
    """A leaf has a label; any other node asks whether a feature is at most a bound."""

    label: int | None = None
    feature: int = 0
    bound: float = 0.0
    low: Tree | None = None
    high: Tree | None = None

    def says(self, row: tuple[float, ...]) -> int:
        node = self
        while node.label is None:
            node = node.low if row[node.feature] <= node.bound else node.high
        return node.label


def grow_tree(rows: list[tuple[float, ...]], labels: list[int], depth: int = 5, least: int = 2) -> Tree:
    """Splits by Gini impurity; ties go to the earlier feature and the smaller bound."""
    ones = sum(labels)
    if depth == 0 or ones in (0, len(labels)) or len(labels) < 2 * least:
        return Tree(int(2 * ones >= len(labels)))
    gini = lambda part: 2 * sum(part) * (len(part) - sum(part)) / len(part)
    best = None
    for f in range(len(rows[0])):
        values = sorted({r[f] for r in rows})
        for a, b in zip(values, values[1:]):
            bound = (a + b) / 2
            low = [y for r, y in zip(rows, labels) if r[f] <= bound]
            high = [y for r, y in zip(rows, labels) if r[f] > bound]
            if min(len(low), len(high)) >= least and (best is None or gini(low) + gini(high) < best[0] - 1e-12):
                best = (gini(low) + gini(high), f, bound)
    if best is None or best[0] >= gini(labels) - 1e-12:
        return Tree(int(2 * ones >= len(labels)))
    _, f, bound = best
    parts = [[(r, y) for r, y in zip(rows, labels) if (r[f] <= bound) == side] for side in (True, False)]
    low, high = (grow_tree([r for r, _ in p], [y for _, y in p], depth - 1, least) for p in parts)
    return Tree(None, f, bound, low, high)


def train() -> Tree:
    table_ = [tuple(map(float, line.split())) for line in LABELLED.strip().splitlines()]
    return grow_tree([r[:-1] for r in table_], [int(r[-1]) for r in table_])


def main_text(page: str | None, tree: Tree) -> str:
    blocks = blocks_of(page)
    return " ".join(b.text for b, row in zip(blocks, features_of(blocks)) if tree.says(row))


def extract(pages: DataFrame, tree: Tree | None = None, id_col: str = "page_id") -> DataFrame:
    """``page_id, url, text, n_chars``, one row per page; null and empty pages give the empty text."""
    tree = tree or train()

    @F.pandas_udf("string")
    def texts(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages_ in parts:
            yield pd.Series([main_text(p, tree) for p in pages_], dtype=object)

    return pages.select(
        F.col(id_col).cast("long").alias("page_id"), "url", texts(F.col("html")).alias("text")
    ).withColumn("n_chars", F.length("text").cast("long"))


@query("op4_html_blocks")
def html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
