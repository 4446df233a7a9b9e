"""Main text of web pages from a streaming parser, text-to-tag ratios and their clustering.

The standard library's parser emits events; from them come the page's lines (block elements), each with
its text and the number of tags around it. The text-to-tag ratio of each line is smoothed by a Gaussian,
and lines are clustered by a threshold (a part of the ratios' standard deviation); those above it are content.
Content lines decide in two places:

* Which region of the page is read. They vote, with their text, for the elements that hold them. The region
  is the innermost element that still holds nearly all of the content text; where articles hold a good part of it, they are.
* What counts within the region. An element whose text is mostly links and mostly not content (a list of
  links without a telling name) is left out. Every other line is kept, so a short paragraph stays with its article.

Elements that are boilerplate by their tag, role, class or id are left out wherever they are, and don't vote. The cost is linear in
the length of a page, however deep its elements are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, unfold

#: Elements whose text is never shown as text.
UNSEEN = {"script", "style", "noscript", "template", "head", "title", "svg", "math", "object", "iframe", "canvas", "audio", "video", "map"}
#: Boilerplate by tag.
CHROME = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "textarea", "fieldset", "datalist"}
#: Elements without an end.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements that begin and end a line.
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
#: A new one ends an open one of the same set, up to the container named last.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "menu", "menubar", "toolbar", "dialog", "alertdialog", "alert", "form"}
#: Words of class and id names.
NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsored", "promo", "promotion", "banner", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "pagination", "pager", "sidebar", "aside", "widget", "footer", "masthead", "topbar", "toolbar", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "share", "sharing", "social", "related", "recommended", "recommendations", "comment", "comments", "commentlist", "disqus", "replies", "respond", "paywall", "skip"}
_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class _Lines(HTMLParser):
    """Collects lines and elements; an element is its number, parents come before children."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.block, self.drop, self.unseen = ["#"], [-1], [0], [False], [False]
        self.stack = [0]
        self.depths: dict[str, list[int]] = {}  # where in the stack a tag's open elements are
        self.lines: list[tuple[str, int, int, int]] = []  # text, tags, element, characters within links
        self.parts: list[str] = []
        self.tags = self.linked = 0

    def depth(self, tags) -> int:
        return max((d[-1] for t in tags if (d := self.depths.get(t))), default=0)

    def cut(self, depth: int) -> None:
        """Ends the open elements from this depth of the stack on."""
        while len(self.stack) > depth:
            self.depths[self.tag[self.stack.pop()]].pop()

    def line(self) -> None:
        text = _SPACE.sub(" ", "".join(self.parts)).strip()
        if text:
            self.lines.append((text, self.tags, self.block[self.stack[-1]], min(self.linked, len(text))))
            self.tags = 0
        self.parts, self.linked = [], 0

    def boilerplate(self, tag: str, attrs: list) -> bool:
        if tag in CHROME:
            return True
        if tag == "header":  # an article's own header holds its title
            return not self.depth(("article", "main"))
        for key, value in attrs:
            if not value:
                continue
            if key == "role" and value.strip().lower() in ROLES:
                return True
            if key in ("class", "id") and tag not in ("html", "body", "article", "main") and any(w.lower() in NAMES for w in _NAME.findall(value)):
                return True
            if key == "aria-hidden" and value.strip().lower() == "true":
                return True
            if key == "style" and "display:none" in value.replace(" ", "").lower():
                return True
        return any(key == "hidden" for key, _ in attrs)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCK:
            self.line()
            if tag != "p":
                self.close(("p",), _P_WITHIN)
            else:
                self.close(_P_ENDS, BLOCK.difference(_P_ENDS))
        if tag in ENDS:
            self.close(*ENDS[tag])
        self.tags += 1
        if tag == "br":
            self.parts.append(" ")
        if tag not in VOID:
            up, n = self.stack[-1], len(self.tag)
            drop = self.drop[up] or self.boilerplate(tag, attrs)
            self.tag.append(tag), self.parent.append(up), self.drop.append(drop), self.unseen.append(self.unseen[up] or tag in UNSEEN)
            self.block.append(n if tag in BLOCK or drop else self.block[up])
            self.depths.setdefault(tag, []).append(len(self.stack))
            self.stack.append(n)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.tag[self.stack[-1]] == tag:
            self.handle_endtag(tag)

    def close(self, tags, up_to) -> None:
        """End the innermost open element of tags, unless one of up_to is open within it."""
        at = self.depth(tags)
        if at > self.depth(up_to):
            self.cut(at)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        at = self.depth((tag,))
        if not at or (tag not in _WIDE and self.depth(_HOLDS) > at):
            return  # an end without a start doesn't end what is around it
        if tag in BLOCK:
            self.line()
        self.cut(at)

    def handle_data(self, data: str) -> None:
        if not self.unseen[self.stack[-1]]:
            self.parts.append(data)
            if self.depths.get("a"):
                self.linked += len(data)


_P_WITHIN = {"article", "body", "div", "section", "main", "td", "li", "blockquote"}
_P_ENDS = {"p", "h1", "h2", "h3", "h4", "h5", "h6"}
_HOLDS, _WIDE = ("article", "main", "body", "td"), {"article", "main", "body", "html", "table", "tr"}
#: Elements that are lines rather than regions.
_LINE = _P_ENDS | {"li", "pre", "blockquote", "td", "b", "i", "span", "a"}


def closed(html: str) -> str:
    """The page without marks that begin what never ends, for which the parser would search again and again."""
    for begin, end, instead in (("<!--", "-->", ""), ("<![", "]]>", "&lt;!["), ("<", ">", "&lt;")):
        at = html.rfind(end) + 1
        if html.find(begin, at) >= 0:
            html = html[:at] + html[at:].replace(begin, instead)
    return html


def smoothed(ratios: np.ndarray, sigma: float = 1.0) -> np.ndarray:
    if sigma <= 0:
        return ratios
    radius = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratios)), kernel)[radius : radius + len(ratios)]
    return np.convolve(ratios, kernel)[radius : radius + len(ratios)] / weight


def extract(html: str | None, threshold: float = 0.5, sigma: float = 1.0, whole: float = 0.9) -> str:
    """The main text of a page. threshold: of the ratios' standard deviation; sigma: of the Gaussian, in lines; whole: part of the content that a region must hold."""
    if not html:
        return ""
    page = _Lines()
    page.feed(closed(html))
    HTMLParser.close(page)
    page.line()
    lines, parent, drop = page.lines, page.parent, page.drop
    if all(drop[node] for _, _, node, _ in lines):
        return ""
    ratio = smoothed(np.array([len(t) / max(1, n) for t, n, _, _ in lines]), sigma)
    content = ratio >= threshold * ratio.std()
    if not any(c and not drop[node] for c, (_, _, node, _) in zip(content, lines, strict=True)):
        content[:] = True
    # what each element holds: content text that votes, all text, linked text
    votes, text, linked = ([0] * len(parent) for _ in range(3))
    for (t, _, node, n), c in zip(lines, content, strict=True):
        if not drop[node]:
            votes[node] += len(t) if c else 0
            text[node] += len(t)
            linked[node] += n
    inner: dict[int, int] = {}  # the child that may be a region and holds nearly all of its parent's votes
    for node in range(len(parent) - 1, 0, -1):
        for held in (votes, text, linked):
            held[parent[node]] += held[node]
    for node in range(1, len(parent)):
        if votes[node] and votes[node] >= whole * votes[parent[node]] and page.tag[node] not in _LINE:
            inner.setdefault(parent[node], node)
    in_article = [False] * len(parent)
    articles = []
    for node in range(1, len(parent)):
        in_article[node] = in_article[parent[node]] or page.tag[parent[node]] == "article"
        if page.tag[node] == "article" and not in_article[node] and votes[node]:
            articles.append(node)
    if articles and sum(votes[x] for x in articles) >= 0.3 * votes[0]:
        most = max(votes[x] for x in articles)
        chosen = {x for x in articles if votes[x] >= 0.1 * most}
    else:
        best = max((x for x in range(1, len(parent)) if page.tag[x] == "main" and votes[x]), key=votes.__getitem__, default=0)
        while best in inner:
            best = inner[best]
        chosen = {best}
    state = [0] * len(parent)  # 0 outside, 1 within the region, 2 left out within it
    for node in range(len(parent)):
        up = state[parent[node]] if node else 0
        links = up == 1 and page.tag[node] in _LISTS and 2 * votes[node] < text[node] < 2 * linked[node]
        state[node] = 1 if node in chosen else 2 if links else up
    return "\n".join(t for t, _, node, _ in lines if state[node] == 1 and not drop[node])


#: Elements that hold several lines.
_LISTS = {"div", "section", "ul", "ol", "dl", "table", "p"}


def extract_pages(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), html_col: str = "html") -> DataFrame:
    """The columns keep, text and n_chars (code points) of every row.

    * Null and empty html, and pages without a line outside of boilerplate, give an empty text.
    * Rows are extracted one by one: repeated rows give equal results, ids and urls may be null, an empty table gives an empty result.
    * Pages of any length are read whole, in linear time.
    * Columns that aren't named in keep are not read; one of keep that is called text or n_chars is replaced.
    """
    rows = pages.select(F.struct(*[column(c).alias(c) for c in keep]).alias("kept"), column(html_col).alias("html"))
    out = rows.select("kept").schema.add("text", "string", False).add("n_chars", "long", False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["kept", "text", "n_chars"])

    return unfold(rows.mapInArrow(run, out), "kept", ["text", "n_chars"])


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
