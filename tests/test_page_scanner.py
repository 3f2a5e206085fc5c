"""The page scanner: against a plain search for each element's end, odd markup, large pages."""

import random
import re
import time

import pytest

from airshed.operators import html
from conftest import rows


def plain_elements(page, name):
    """(inner text, start) of the elements of a name in well-formed pages, by
    searching the rest of the page for each closing tag."""
    found = []
    for m in re.finditer(rf"<{name}\b[^>]*>", page):
        depth, at = 1, m.end()
        while depth:
            t = re.compile(rf"<(/?){name}\b[^>]*>").search(page, at)
            depth += -1 if t.group(1) else 1
            at = t.end()
        found.append((m.start(), page[m.end():t.start()]))
    return found


def stripped(fragment):
    return "".join(html.decoded(x).strip(" \t\n\x0b\f\r\xa0") for x in re.split(r"<[^>]*>", fragment))


def grow(rng, depth):
    if depth == 0 or rng.random() < 0.2:
        return rng.choice(["a", " b ", "&amp;", "x &lt; y", "", "é&#7841;"])
    name = rng.choice(["div", "p", "span", "b", "td", "table", "tr"])
    return f"<{name} class='{rng.choice(['k', 'k l', 'm'])}'>" + "".join(grow(rng, depth - 1) for _ in range(rng.randrange(4))) + f"</{name}>"


def test_elements_and_texts_match_a_plain_search():
    rng = random.Random(4)
    for _ in range(300):
        page = "".join(grow(rng, 5) for _ in range(3))
        scanned = html.Page(page, frozenset(("div", "span", "td", "tr")))
        for name in ("div", "span", "td", "tr"):
            assert [scanned.text(e) for e in scanned.elements[name]] == [stripped(inner) for _, inner in plain_elements(page, name)]
        places = {name: [at for at, _ in plain_elements(page, name)] for name in ("div", "span")}
        for e, (at, inner) in zip(scanned.elements["div"], plain_elements(page, "div")):
            inside = [p for p in places["span"] if at < p < at + len(inner)]
            assert len(list(scanned.inside(e, "span"))) == len(inside)


@pytest.mark.parametrize("page, want", [
    ("<table><tr><td>5 < 6</td><td>a</td></tr></table>", [["5 < 6", "a"]]),
    ("<table><tr><td>open<td>ends<tr><td>next</table><table><tr><td>no</td></tr></table>", [["openendsnext", "endsnext", "next"], ["next"]]),
    ("<TABLE><TR><TD>upper</TD></TR></TABLE>", [["upper"]]),
    ("</tr></table><table><tr><td>a</td></tr></table>", [["a"]]),
    ("<!-- <table><tr><td>x</td></tr></table> --><p>no table</p>", []),
    ("<script>'<table>'</script><table><tr></tr></table>", [[]]),
    ("<table class='table-striped'><tr><td>no body</td></tr></table>", [["no body"]]),
    ("<table><tr><td>first</td></tr></table><table class='x table-striped'><thead><tr><td>h</td></tr></thead><tbody><tr><td>b</td></tr></tbody></table>",
     [["b"]]),
    ("<tbody><table class='table-striped'><tr><td>outer body</td></tr></table></tbody>", [["outer body"]]),
    ("<table><tr><td a='1' b=\"x\"c>k</td", [["k"]]), ("", []), (None, []), ("plain", []), ("<table><tr><td>cut <td", [["cut", ""]]),
    ("<script>never closed <table><tr><td>x</td></tr></table>", []), ("<scripted><table><tr><td>x</td></tr></table>", [["x"]]),
    ("<script <table><tr><td>x</td></tr></table>", []), ("<table><tr><td>&#0;&#xD800;&nosuch;&eacute;</td></tr></table>", [["��&nosuch;é"]]),
])
def test_odd_markup(page, want):
    assert html.table_rows(page, "table-striped") == want


@pytest.mark.parametrize("page", [
    "<table class=table-striped><tbody>" + "<tr><td>a</td><td>b</td><td>c</td><td>d</td></tr>" * 24_000, "<a " * 400_000,
    "<div class=item>" * 70_000, "<table><tr><td>x" * 60_000, "<!-- " * 200_000, "<script " * 120_000, "<" * 1_000_000, "<div class='" * 80_000,
    "<div class=item>x" * 40_000 + "</div>" * 40_000, "</div>" * 160_000, "<div " + " " * 1_000_000, "<script>" + "</script " * 100_000,
    "&amp" * 250_000, "<h3><a href=x>" * 70_000,
], ids=range(14))
def test_a_megabyte_takes_seconds(page):
    began = time.perf_counter()
    html.table_rows(page, "table-striped")
    html.list_items(page, "news-list", "item", "div", "news|item")
    assert len(page) > 900_000 and time.perf_counter() - began < 15


def test_large_and_missing_pages_as_rows(spark):
    many = "<table class='table-striped'><tbody>" + "".join(
        f"<tr><td>S{i}</td><td>{i}</td><td>c</td><td>t</td></tr>" for i in range(20_000)) + "</tbody></table>"
    items = "<div class='news-list'>" + "".join(
        f"<div class='item'><h3><a href='/n/{i}'>T{i}</a></h3></div>" for i in range(10_000)) + "</div>"
    pages = spark.createDataFrame([(1, "http://h/x", many), (2, None, None), (3, "http://h/y", ""), (None, "http://h/z", items)],
                                  "page_id long, url string, html string")
    assert html.html_tables(pages).groupBy("page_id").count().collect() == [(1, 20_000)]
    last = rows(html.html_items(pages).where("item_no = 9999"))
    assert last == [(None, 9999, "T9999", "", "", "http://h/n/9999")]
    assert rows(html.html_items(pages.where("false"))) == rows(html.html_table_rows(pages.where("false"))) == []


def regex_page(page, names):
    """Elements (name, place, end, tag) and stripped text nodes by the plain pattern of a tag."""
    tag = re.compile(r"<(?:(/?)([a-zA-Z][^\s<>/]*)|[!?])[^<>]*>?")
    page, stack, found, texts, at, n = html.visible(page), [], [], [], 0, 0
    for m in tag.finditer(page):
        texts.append(html.decoded(page[at:m.start()]).strip(html._BLANK))
        at, name = m.end(), (m.group(2) or "").lower()
        if name not in names:
            continue
        n += 1
        if not m.group(1):
            found.append([name, n, None, m.group(0).strip("<>")])
            stack.append(found[-1])
        elif any(e[0] == name for e in stack):
            while True:
                stack[-1][2] = n
                if stack.pop()[0] == name:
                    break
    for e in stack:
        e[2] = n + 1
    return sorted(map(tuple, found)), [t for t in [*texts, html.decoded(page[at:]).strip(html._BLANK)] if t]


ODD = ["<td>", "</td>", "<TR a='1'>", "</tr >", "<table class='k'>", "</table>", "<", "<1", "</", "< td>", "<td", "<td/>", "a & b", "&amp;",
       " \xa0x ", "<!doctype x>", "<?php ?>", "<!-- <td>", "-->", "<p/>", ">", "<td <tr>", "é&#7841;", "<script>", "</script>", "</table\x1f>"]


def test_a_page_is_read_as_by_the_pattern_of_a_tag():
    rng, names = random.Random(9), frozenset(("table", "tr", "td"))
    for _ in range(3_000):
        page = "".join(rng.choice(ODD) for _ in range(rng.randrange(40)))
        p = html.Page(page, names)
        elements = sorted((e.name, e.at, e.end, e.tag) for of in p.elements.values() for e in of)
        assert (elements, [t for t in p.texts if t]) == regex_page(page, names), page


def test_a_short_page_takes_little_time():
    """Pages of one table each are the usual feed: what a tag costs decides."""
    row = "<tr>" + "<td><b>Tốt</b> 1</td>" * 4 + "</tr>"
    page = f"<html><table class='menu'><tr><td>a</td></tr></table><table class='table-striped'><tbody>{row * 3}</tbody></table></html>"
    names, plain = frozenset(("table", "tbody", "tr", "td", "th")), []
    fast = []
    for _ in range(5):
        for took, work in ((fast, lambda: html.Page(page, names)), (plain, lambda: regex_page(page, names))):
            began = time.perf_counter()
            for _ in range(200):
                work()
            took.append(time.perf_counter() - began)
    assert min(fast) < 0.8 * min(plain)


def test_many_bare_signs_are_one_text_in_linear_time():
    began = time.perf_counter()
    page = html.Page("<td>" + "< " * 400_000 + "</td>", frozenset(("td",)))
    assert len(page.text(page.elements["td"][0])) == 799_999 and time.perf_counter() - began < 20
