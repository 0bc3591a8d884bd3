"""Main text of HTML pages by text-to-tag ratios.

The standard library's parser streams a page's events into lines, one per
block element, each with its text, the tags it took, and the containers it
lies in.  Every line has a ratio of text to tags; the ratios are smoothed
with a Gaussian over neighbouring lines, and lines whose smoothed ratio is
above ``LEVEL`` standard deviations are the content cluster.  Clusters select
regions: articles (or the main element) that hold a cluster, or, on pages
that name none, the containers of the clusters' text: the smallest that holds
most of it, grown while little else is around, others of mostly such text, and
every single line of a cluster.
A selected region is taken whole, so short paragraphs and headings stay, apart
from what its markup declares to be something else: menus, page headers and
footers, sidebars, notices, adverts, forms, scripts, styles and comments.
A class or id declares an element if one of its names is made of such words
alone (``comments``, ``cookie-notice``, ``ad-box``); inside an article or main
element a name with other words beside (``related-work``), or a word that may
also be a subject (``discussion``), only marks an element, which goes if none
of its lines is about as long, links apart, as the article's own.  Ids of
headings name their subject and declare nothing, ids of sections only reader
comments.

Defined results: a null or empty page has empty text, as has a page of
nothing but boilerplate.  Text without any markup is one block.  Unclosed
and stray tags are tolerated.  Character references are decoded; a run of
white space in a block, line breaks included, is one space; blocks are
joined by an empty line.  Whole pages are read, whatever their length.
Pages are handled one by one, so repeated rows give repeated results, and an
empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.tables import ship

SIGMA = 1.5          # of the Gaussian, in lines
LEVEL = 0.5          # content threshold, in standard deviations
MARKED = 0.5         # a marked element stays with a line of such a share of the median
                     # length of the content lines beside it
SHARE = 0.7          # of the clusters' text that a container must hold

_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = set("""address article aside blockquote body caption center dd details dialog dir div dl
    dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup html legend li
    main menu nav ol optgroup option p pre section select summary table tbody tfoot thead title tr
    ul""".split())
#: Elements whose text is never part of an article.
_APART = set("""head title script style noscript template nav footer aside form button select
    textarea iframe object svg canvas dialog menu audio video map datalist""".split())
_CONTAINER = set("article main section div td body blockquote".split())
_TITLED = set("h1 h2 h3 h4 h5 h6 hgroup".split())
_ROLES = set("navigation banner contentinfo complementary search form alert alertdialog dialog "
             "menu menubar toolbar status".split())
#: Words in a class or an id that declare an element to be no article text.
_NAMES = set("""ad ads adv advert adverts advertisement advertisements adsense adslot sponsor
    sponsored promo promotion banner sidebar nav navbar navigation menu breadcrumb breadcrumbs
    footer masthead cookie cookies consent gdpr notice notices notification popup modal overlay
    newsletter subscribe subscription signup login share sharing social related recommended
    recommendations widget widgets pagination pager toolbar skip""".split())
_REMARKS = set("comment comments commentlist commentary reply replies respond discussion disqus "
               "reactions".split())
#: Of these, what may also be an article's subject, or part of its layout.
_SUBJECTS = set("commentary discussion navigation promotion reactions related recommended "
                "recommendations reply respond sharing skip social toolbar widget widgets".split())
#: What a name may have beside such words and still declare its element.
_PLACES = set("""area bar block body bottom box button buttons card center column content form inner
    item items left link links list message outer panel post posts reader readers right section
    slot space text thread title top unit user""".split())
#: Opening one of the first closes open ones of the second, down to the third.
_CLOSES = {"li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"),
           "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"),
           "option": ("option", "select"), "body": ("head", "html")}


class Element:
    """An open container; what it inherits is settled when it opens."""

    def __init__(self, tag: str, parent: "Element | None", number: int = 0,
                 apart: bool = False, named: bool = False, inline: bool = False,
                 marked: bool = False) -> None:
        self.tag, self.parent, self.number, self.inline = tag, parent, number, inline
        up = parent or self
        # Declared by a tag or role, here or around.
        self.apart = apart or (parent is not None and parent.apart)
        # Declared by a class or id, here or around; what one says of an
        # element around an article isn't said of the article.
        whole = tag in ("article", "main")
        self.named = named or (parent is not None and not whole and parent.named)
        # The outermost element around that a name marks in article text.
        self.marked: Element | None = (parent and parent.marked) or (self if marked else None)
        # The outermost article and main element around.
        self.article: Element | None = None
        self.main: Element | None = None
        if parent is not None:
            self.article = up.article or (self if tag == "article" else None)
            self.main = up.main or (self if tag == "main" else None)


@dataclass
class Line:
    text: str
    tags: int
    links: int
    at: Element


class Lines(HTMLParser):
    """Turns parser events into lines."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.top = Element("", None)
        self.elements = [self.top]          # a parent comes before its children
        self.depth: dict[str, int] = {}     # open elements by tag
        self.found: list[Line] = []
        self.text: list[str] = []
        self.tags = self.links = 0
        self.in_link = 0

    # Marked sections such as <![if ...]> are no text and no error.
    def parse_marked_section(self, i, report=1):
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else -1

    def unknown_decl(self, data):
        pass

    def flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            self.found.append(Line(text, self.tags, self.links, self.top))
            self.tags = self.links = 0
        self.text = []

    def pop_to(self, element: Element) -> None:
        """Close ``element`` and what is open inside it."""
        while self.top is not element.parent:
            self.depth[self.top.tag] -= 1
            self.top = self.top.parent

    def close_open(self, tags: set[str], until: set[str]) -> None:
        """Close the outermost open element of ``tags`` inside ``until``."""
        if not any(self.depth.get(t) for t in tags):
            return
        node, last = self.top, None
        while node is not None and node.tag not in until:
            if node.tag in tags:
                last = node
            node = node.parent
        if last is not None:
            self.pop_to(last)

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag in ("br", "hr", "img"):
            self.text.append(" ")
        if tag == "hr":
            self.flush()
        if tag in _VOID:
            return
        if tag == "a":
            self.in_link += 1
        if tag in _BLOCK:
            self.flush()
            while self.top.parent is not None and self.top.inline:
                self.pop_to(self.top)      # a block ends inline adverts
            self.close_open({"p"}, _CONTAINER | {"li", "form", "nav", "aside", "header", "footer"})
        elif tag in ("td", "th"):
            self.text.append(" ")
        if tag in _CLOSES:
            closed, until = _CLOSES[tag]
            self.close_open(set(closed.split()), set(until.split()))
        apart, named, marked = self.declared(tag, dict(attrs))
        if tag in ("article", "main"):
            # A menu or page header that was never closed ends here.
            self.close_open({"nav", "header", "form"}, {"article", "main", "aside", "footer"})
        inline = tag not in _BLOCK and tag not in _APART and tag not in ("td", "th")
        if apart or named or marked or not inline:
            self.top = Element(tag, self.top, len(self.elements), apart or named and inline,
                               named, inline, marked)
            self.elements.append(self.top)
            self.depth[tag] = self.depth.get(tag, 0) + 1

    def declared(self, tag: str, attrs: dict) -> tuple[bool, bool, bool]:
        """(apart, named, marked): by tag or role, by a name outside of
        articles, by a name where only the lines can tell."""
        inside = bool(self.depth.get("article") or self.depth.get("main"))
        names = (attrs.get("class") or "").lower().split()
        ids = [] if tag in _TITLED else (attrs.get("id") or "").lower().split()
        style = (attrs.get("style") or "").replace(" ", "").lower()
        apart = (tag in _APART or (attrs.get("role") or "").lower() in _ROLES or "hidden" in attrs
                 or (attrs.get("aria-hidden") or "").lower() == "true" or "display:none" in style)
        if tag == "header" and not inside:
            apart = True
        if tag in ("html", "body"):
            return apart, False, False
        if tag == "section":       # its id names its subject, or reader comments
            ids = [i for i in ids if declares(i, _REMARKS)]
        words = set(re.split(r"[^a-z0-9]+", " ".join(names + ids)))
        remark, name = bool(words & _REMARKS), bool(words & _NAMES)
        if tag in ("article", "main"):
            return apart, False, remark
        if inside:
            if any(declares(n, _REMARKS) for n in names + ids):
                return True, False, False
            named = any(declares(n, _NAMES) for n in names + ids)
            return apart, named, not named and (remark or name)
        return apart or remark, name or "header" in words, False

    def handle_endtag(self, tag):
        self.tags += 1
        if tag == "a":
            self.in_link = max(0, self.in_link - 1)
        if tag in _BLOCK:
            self.flush()
        if self.depth.get(tag):
            node = self.top
            while node.tag != tag:
                node = node.parent
            self.pop_to(node)

    def handle_startendtag(self, tag, attrs):
        # HTML takes <div/> as <div>; only void elements end at once.
        self.handle_starttag(tag, attrs)

    def handle_data(self, data):
        if not self.top.apart:
            self.text.append(data)
            if self.in_link:
                self.links += len(data)


def declares(name: str, words: set[str]) -> bool:
    """Is a class or id made of ``words`` and names of places alone, with one
    that is no subject?"""
    parts = set(re.split(r"[^a-z]+", name)) - {""}
    return bool(parts & (words - _SUBJECTS)) and parts <= _NAMES | _REMARKS | _PLACES


def closed(html: str) -> str:
    """``html`` with markup that never ends as text.  The parser takes it so
    too, but would look for the end again from each beginning."""
    end = html.rfind("-->")
    if html.find("<!--", end + 1) >= 0:
        html = html[:end + 1] + html[end + 1:].replace("<!--", "&lt;!--")
    end = html.rfind(">")
    return html[:end + 1] + html[end + 1:].replace("<", "&lt;")


def parsed(html: str) -> Lines:
    parser = Lines()
    parser.feed(closed(html))
    parser.close()
    parser.flush()
    return parser


def smoothed(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing; at the ends the weights that exist count."""
    reach = int(np.ceil(3 * sigma))
    weight = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    top = np.convolve(values, weight)[reach:reach + len(values)]
    return top / np.convolve(np.ones(len(values)), weight)[reach:reach + len(values)]


def content_lines(lines: list[Line]) -> np.ndarray:
    """Which lines belong to the content clusters."""
    ratio = np.array([(len(x.text) - x.links) / max(1, x.tags) for x in lines])
    smooth = smoothed(ratio)
    return (smooth >= LEVEL * smooth.std()) & (ratio > 0)


def without_marked(lines: list[Line]) -> list[Line]:
    """``lines`` without the marked elements that hold no line about as long,
    links apart, as the content lines of the rest.  Lines are taken one by
    one: smoothing would lend them their neighbours' ratio, and the first one
    has the tags of everything before it."""
    rest = [x for x in lines if x.at.marked is None]
    if not rest or len(rest) == len(lines):
        return lines
    own = [len(x.text) - x.links for x, c in zip(rest, content_lines(rest)) if c]
    level = MARKED * float(np.median(own)) if own else 0.0
    dense = {x.at.marked.number for x in lines
             if x.at.marked is not None and len(x.text) - x.links >= level}
    return [x for x in lines if x.at.marked is None or x.at.marked.number in dense]


def main_lines(page: Lines) -> list[Line]:
    left = without_marked([x for x in page.found if not (x.at.apart or x.at.named)])
    if not left:   # class names declared too much
        left = [x for x in page.found if not x.at.apart]
    if not left:
        return []
    content = content_lines(left)
    for kind in ("article", "main"):
        regions = [getattr(x.at, kind) for x in left]
        held = {r.number for r in regions if r is not None}
        if held:
            chosen = {r.number for r, c in zip(regions, content) if r is not None and c}
            return [x for x, r in zip(left, regions)
                    if r is not None and r.number in (chosen or held)]
    # No article is named: the smallest container that still holds most of
    # the clusters' text (children come after their parents), and the regions
    # of the clusters outside it.
    mass, total = [0] * len(page.elements), [0] * len(page.elements)
    for x, c in zip(left, content):
        mass[x.at.number] += len(x.text) * bool(c)
        total[x.at.number] += len(x.text)
    for e in reversed(page.elements[1:]):
        mass[e.parent.number] += mass[e.number]
        total[e.parent.number] += total[e.number]
    best = max((e.number for e in page.elements
                if e.tag in _CONTAINER and mass[e.number] >= SHARE * mass[0]), default=0)
    # It grows while what is around it holds more of the clusters and little
    # else; apart from it, containers of mostly cluster text are regions too.
    around, node = set(), page.elements[best].parent
    while node is not None:
        around.add(node.number)
        if (node.tag in _CONTAINER - {"body"} and mass[node.number] > mass[best]
                and 2 * mass[node.number] >= total[node.number]):
            best = node.number
        node = node.parent
    inside = [e.number == best or e.tag in _CONTAINER and e.number not in around
              and 0 < total[e.number] <= 2 * mass[e.number] for e in page.elements]
    for e in page.elements[1:]:
        inside[e.number] |= inside[e.parent.number]
    # A line in a cluster stays wherever it is; lines that are links for the
    # most part are menus unless in a cluster.
    return [x for x, c in zip(left, content)
            if c or inside[x.at.number] and x.links * 2 <= len(x.text)]


def extract(html: str | None) -> str:
    return "\n\n".join(x.text for x in main_lines(parsed(html or "")))


def main_text(html: Column) -> Column:
    @F.pandas_udf("string")
    def texts(pages: pd.Series) -> pd.Series:
        return pd.Series([extract(p) for p in pages], dtype=object)

    return texts(html)


def page_texts(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """``pages`` plus ``out`` (in place of a column of that name), the main
    text of each page."""
    ship(pages.sparkSession)
    return pages.withColumn(out, main_text(F.col(html_col)))
