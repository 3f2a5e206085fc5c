"""HTML pages -> rows (H1-H3).

A page is read once, from its first to its last character, by a scanner
with a stack of open elements; the rows or items it finds are an array
column of the page's own row, exploded by Spark, so pages are neither
collected nor shuffled. The scanner's steps are proportional to the page,
whatever its markup: the only regular expressions are single forward passes
over it, and an element's descendants are found by bisection in document
order. (Built-in expressions can only find the end of an element by
searching the rest of the page, once per element.)

Comments, scripts and styles are dropped first. An element runs to its own
closing tag, or to the end of the element around it. Names and attributes
are read without regard to case; class lists from double-quoted,
single-quoted and bare attributes. Elements nested deeper than ``DEEPEST``
are read as text, so that what a page gives is bounded by its size.
"""

from __future__ import annotations

import re
import sys
from bisect import bisect_right
from collections.abc import Callable
from html.entities import name2codepoint
from itertools import accumulate
from operator import attrgetter

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed import rules
from airshed.functions.exprs import absolute_url, numeric_text, site_root

# shipped with the tasks: executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DEEPEST = 256
_BLANK = " \t\n\x0b\f\r "
_HEAD = re.compile(r"(/?)([a-zA-Z][^\s<>/]*)|[!?]")
_SHORT, _KEPT = 200, 4096    # characters of a tag that is remembered, and how many are
_HIDDEN = re.compile(r"<!--|<(script|style)\b", re.IGNORECASE)
_HIDDEN_END = {n: re.compile(rf"</{n}\s*>", re.IGNORECASE) for n in ("script", "style")}
_REFERENCE = re.compile(r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,31});")


def visible(page: str) -> str:
    """Without comments, scripts and styles; an unclosed one hides the rest."""
    out, at = [], 0
    while found := _HIDDEN.search(page, at):
        name = found.group(1)
        # an opening tag that never closes hides nothing, nor does any after it
        start = page.find(">", found.end()) + 1 if name else found.end()
        if start == 0:
            break
        out.append(page[at:found.start()])
        if name:
            end = _HIDDEN_END[name.lower()].search(page, start)
            at = end.end() if end else len(page)
        else:
            end = page.find("-->", start)
            at = end + 3 if end >= 0 else len(page)
    out.append(page[at:])
    return "".join(out)


def decoded(text: str) -> str:
    """Character references (decimal, hexadecimal, named) as characters."""
    def char(m: re.Match) -> str:
        name = m.group(1)
        if not name.startswith("#"):
            return chr(name2codepoint[name]) if name in name2codepoint else m.group(0)
        point = int(name[2:], 16) if name[1] in "xX" else int(name[1:])
        return chr(point) if 0 < point <= 0x10FFFF and not 0xD800 <= point <= 0xDFFF else "�"

    return _REFERENCE.sub(char, text) if "&" in text else text


_attributes: dict[str, re.Pattern] = {}


def attribute_of(tag: str, name: str) -> str | None:
    """Value of an attribute of an opening tag; None when it has none."""
    if (pattern := _attributes.get(name)) is None:
        pattern = _attributes[name] = re.compile(rf"(?is)\s{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
    found = pattern.search(tag)
    return None if found is None else decoded(next((g for g in found.groups() if g is not None), ""))


_NO_TAG, _OTHER = (0, ""), (1, "")
_seen: dict[frozenset, dict[str, tuple[int, str]]] = {}


def _kind(head: str, names: frozenset[str], seen: dict[str, tuple[int, str]]) -> tuple[int, str]:
    """What stands between ``<`` and ``>``: no tag, one of another name, or
    (2, name) if it opens, (3, name) if it closes one of ``names``."""
    found = _HEAD.match(head)
    name = (found.group(2) or "").lower() if found else ""
    kind = (3 if found.group(1) else 2, name) if name in names else _OTHER if found else _NO_TAG
    if len(head) <= _SHORT:   # long ones are rarely repeated
        if len(seen) >= _KEPT:
            seen.clear()
        seen[head] = kind
    return kind


class Element:
    """An element: its place in document order, the place after its last
    descendant, its opening tag (without ``<`` and ``>``) and the text nodes inside it."""

    __slots__ = ("name", "at", "end", "tag", "first", "last", "around")

    def __init__(self, name: str, at: int, tag: str, first: int, around: int):
        self.name, self.at, self.tag, self.first, self.around = name, at, tag, first, around
        self.end = self.last = sys.maxsize

    def classes(self) -> list[str]:
        return (attribute_of(self.tag, "class") or "").split()


class Page:
    """The elements of some names, in document order, and the text nodes
    (decoded and stripped) of a page. ``around`` of an element is the place
    of the nearest element named ``mark`` that holds it, or -1."""

    def __init__(self, html: str, names: frozenset[str], mark: str = ""):
        # a tag holds no ``<``: each piece is a tag and the text after it, or text
        first, *pieces = visible(html).split("<")
        texts, glued = [first], []
        seen = _seen.setdefault(names, {})
        self.elements: dict[str, list[Element]] = {n: [] for n in names}
        self.places: dict[str, list[int]] = {n: [] for n in names}
        stack: list[Element] = []
        opened = dict.fromkeys(names, 0)
        marks = [-1]
        n = 0
        for piece in pieces:
            head, _, text = piece.partition(">")
            does, name = seen.get(head) or _kind(head, names, seen)
            if not does:
                glued = glued or [texts.pop()]
                glued.append(piece)
                continue
            if glued:
                texts.append("<".join(glued))
                glued = []
            if does == 2:
                n += 1
                if len(stack) < DEEPEST:
                    e = Element(name, n, head, len(texts), marks[-1])
                    stack.append(e)
                    opened[name] += 1
                    self.elements[name].append(e)
                    self.places[name].append(n)
                    if name == mark:
                        marks.append(n)
            elif does == 3:
                n += 1
                last = len(texts)
                while opened[name]:
                    e = stack.pop()
                    e.end, e.last = n, last
                    opened[e.name] -= 1
                    if e.name == mark:
                        marks.pop()
                    if e.name == name:
                        break
            texts.append(text)
        if glued:
            texts.append("<".join(glued))
        for e in stack:
            e.end, e.last = n + 1, len(texts)
        # most text nodes are white space, or hold no reference
        self.texts = [t and (decoded(t) if "&" in t else t).strip(_BLANK) for t in texts]
        self.whole, self.starts = "".join(self.texts), [0, *accumulate(map(len, self.texts))]

    def text(self, e: Element | None) -> str:
        """Text nodes joined with no separator (``Hà <b>Nội</b>`` -> ``HàNội``)."""
        return "" if e is None else self.whole[self.starts[e.first]:self.starts[e.last]]

    def inside(self, e: Element, name: str):
        """The elements of a name inside another, in document order."""
        found = self.elements[name]
        for i in range(bisect_right(self.places[name], e.at), len(found)):
            if found[i].at >= e.end:
                return
            yield found[i]


_PLACE = attrgetter("at")


def outermost(elements: list[Element]) -> list[Element]:
    """The elements, in document order, that lie in none of the others."""
    out: list[Element] = []
    for e in elements:
        if not out or e.at >= out[-1].end:
            out.append(e)
    return out


def table_rows(html: str | None, table_class: str) -> list[list[str]]:
    """Texts of the cells of each row of a page (see ``html_table_rows``)."""
    page = Page(html or "", frozenset(("table", "tbody", "tr", "td", "th")), "tbody")
    tables = page.elements["table"]
    chosen = [t for t in tables if table_class in t.classes()]
    # a row is in a body of the table when the nearest body around it opened inside the table
    rows = [r for t in outermost(chosen) for r in page.inside(t, "tr") if r.around > t.at]
    if not rows and tables:
        rows = list(page.inside((chosen or tables)[0], "tr"))
    out = []
    for row in rows:
        cells = sorted((*page.inside(row, "td"), *page.inside(row, "th")), key=_PLACE)
        out.append([page.text(c) for c in cells])
    return out


def list_items(html: str | None, list_class: str, item_class: str, item_tag: str, fallback: str) -> list[dict]:
    """Title, summary, date and link target of each item of a page (see
    ``html_items``)."""
    page = Page(html or "", frozenset(("div", item_tag, "h3", "a", "span")), "h3")
    lists = outermost([d for d in page.elements["div"] if list_class in d.classes()])
    items = [e for d in lists for e in page.inside(d, item_tag) if item_class in e.classes()]
    if not items:
        items = [e for e in page.elements[item_tag]
                 if not fallback or re.search(fallback, attribute_of(e.tag, "class") or "")]

    def first(item: Element, name: str, cls: str) -> str:
        return page.text(next((e for e in page.inside(item, name) if cls in e.classes()), None))

    out = []
    for item in items:
        link = next((a for a in page.inside(item, "a") if a.around > item.at), None) or next(page.inside(item, "a"), None)
        out.append({"title": page.text(link) if link else "N/A", "summary": first(item, "div", "summary"),
                    "publish_date": first(item, "span", "date"), "href": attribute_of(link.tag, "href") if link else ""})
    return out


def _scanned(scan: Callable[[str | None], list], schema: str):
    """A column function of ``scan``, computed once a row."""
    def work(pages: pd.Series) -> pd.Series:
        return pd.Series([scan(p) for p in pages], dtype=object)

    return F.pandas_udf(work, schema).asNondeterministic()


def decode_entities(c: Column) -> Column:
    """Character references (decimal, hexadecimal, named) as characters."""
    names = F.create_map(*[F.lit(x) for n, p in name2codepoint.items() for x in (n, chr(p))])
    parts = F.split(c, r"&(?=#[0-9]{1,7};|#[xX][0-9a-fA-F]{1,6};|[a-zA-Z][a-zA-Z0-9]{1,31};)")

    def one(part: Column, i: Column) -> Column:
        name = F.substring_index(part, ";", 1)
        after = F.substr(part, F.length(name) + 2, F.length(part))
        number = F.when(name.rlike("^#[xX]"), F.conv(F.substr(name, F.lit(3), F.lit(7)), 16, 10)) \
            .otherwise(F.substr(name, F.lit(2), F.lit(8))).try_cast("int")
        point = F.when(number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF), number).otherwise(0xFFFD)
        char = F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")
        text = F.when(name.startswith("#"), F.concat(char, after)) \
            .otherwise(F.coalesce(F.concat(F.element_at(names, name), after), F.concat(F.lit("&"), part)))
        return F.when(i == 0, part).otherwise(text)

    return F.when(c.contains("&"), F.array_join(F.transform(parts, one), "")).otherwise(c)


def strip_tags(c: Column) -> Column:
    """Visible text of an HTML fragment the way a parser's stripped text
    is built: every text node is decoded and stripped, and the nodes are
    joined with no separator (``Hà <b>Nội</b>`` -> ``HàNội``); whitespace
    inside a node is kept."""
    nodes = F.split(c, r"<[^>]*>")
    return F.array_join(F.transform(nodes, lambda n: F.regexp_replace(
        decode_entities(n), r"^[\s\x{A0}]+|[\s\x{A0}]+$", "")), "")


def html_table_rows(pages: DataFrame, html_col: str = "html", table_class: str = "table-striped",
                    keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """H1 first half: (page, row_no, cells[]). Rows are the rows inside a
    ``tbody`` of the tables with the class; when there are none, all rows
    of the first table with the class, else of the first table. A row's
    cells are all cells inside it, those of nested tables too, and nested
    rows are rows of their own. A null or empty page, or one without a table, has no row."""
    scan = _scanned(lambda page: table_rows(page, table_class), "array<array<string>>")
    return pages.select(*keep, F.posexplode(scan(F.col(html_col))).alias("row_no", "cells"))


def html_tables(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url"),
                min_cells: int = rules.HTML_MIN_CELLS,
                header_words: tuple[str, ...] = rules.HTML_HEADER_WORDS) -> DataFrame:
    """H1 + F19 + H3: station rows (name, index, category, time); short
    rows and header rows skipped; the index is a number or NULL."""
    rows = html_table_rows(pages, html_col, keep=keep)
    first = F.element_at("cells", 1)
    header = F.lit(False)
    for w in header_words:
        header = header | first.contains(w)
    good = rows.filter(F.when(F.size("cells") >= min_cells, ~header).otherwise(False))
    return good.select(*keep, "row_no",
                       first.alias("station_name"),
                       numeric_text(F.element_at("cells", 2)).alias("aqi_value"),
                       F.element_at("cells", 3).alias("category"),
                       F.element_at("cells", 4).alias("published_time"))


def html_items(pages: DataFrame, html_col: str = "html", url_col: str = "url",
               base_url: str | Column | None = None, keep: tuple[str, ...] = ("page_id",),
               list_class: str = "news-list", item_class: str = "item", item_tag: str = "div",
               fallback: str = "news|item") -> DataFrame:
    """H2 + F20: items with title, link, summary and date.

    Items are the ``item_tag`` elements of class ``item_class`` inside a
    ``div`` of class ``list_class``; when there are none, every ``item_tag``
    whose class matches ``fallback`` (an empty pattern: every ``item_tag``).
    An item ends at its own closing tag. The title is the first link inside
    a heading (h3), else the first link ('N/A' when none); relative links
    are made absolute against ``base_url`` (default: scheme and host of the
    page URL), a link without a target stays NULL. Items with no title and
    no summary are skipped. A null or empty page has no item.
    """
    base = site_root(F.col(url_col)) if base_url is None else (
        F.lit(base_url) if isinstance(base_url, str) else base_url)
    scan = _scanned(lambda page: list_items(page, list_class, item_class, item_tag, fallback),
                    "array<struct<title: string, summary: string, publish_date: string, href: string>>")
    item = pages.select(*keep, base.alias("_base"), F.posexplode(scan(F.col(html_col))).alias("item_no", "_item"))
    return item.filter("_item.title <> 'N/A' or _item.summary <> ''").select(
        *keep, "item_no", "_item.title", "_item.summary", "_item.publish_date",
        absolute_url(F.col("_item.href"), F.col("_base")).alias("detail_url"))
