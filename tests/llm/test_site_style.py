"""Main text: page parts, site style tree, odd pages."""

import html as html_module
import itertools
import math
import random
import re
import time
from collections import Counter, defaultdict
from html.parser import HTMLParser

import pytest

from airshed.llm import site_style as H
from airshed.llm.common import Scratch
from llm_cases import rows

SF = "/root/testdata/sf0.01"
SCHEMA = "page_id long, url string, html string, text string"

FULL = """<!DOCTYPE html><html><head><title>Site &amp; title</title><style>p{}</style><script>var x = "</p><p>no";</script></head>
<body class="page"><header class="top"><h1>Site name</h1></header><nav><ul><li><a href="/a">Menu</a></ul></nav>
<div id="cookie-banner">We use cookies</div>
<main><article class="post"><header><h1>Head&eacute;line &#169; &#x41;</h1></header>
<p>First   para<b>graph</b>
 with <a href="/x">a link</a><br>and a break.<p>Unclosed &lt;b&gt; second<!-- hidden <p>no</p> -->
<ul><li>one<li>two</ul><div class="ad">Buy now</div><div class="share social">Tweet</div>
<table><tr><td>a</td><td>b</td></tr></table><form><input value="x">Name <button>Send</button></form>
<noscript>Turn on scripts</noscript><section class="comments"><p>Nice post!</p></section></article>
<aside><p>Related posts</p></aside></main><div class="sidebar"><p>Side</p></div><footer>&copy; 2024</footer></body></html>"""


def test_parts_of_a_page():
    assert H.Page(FULL).text() == "\n".join([
        "Headéline © A", "First paragraph with a link and a break.", "Unclosed <b> second", "one", "two", "a b"])


def test_hidden_elements():
    parts = ['<p hidden>a</p>', '<p style="color:red; DISPLAY: none">b</p>', "<p aria-hidden='true'>c</p>", '<p data-hidden="x">d</p>',
             '<p data-id="menu">e</p>', '<p class=menu>f</p>', '<p style="color:red">g</p>']
    assert H.Page("".join(parts)).text() == "d\ne\ng"


def test_tree_finds_what_repeats_on_a_site(spark):
    page = ("<html><body><div class='wrap'><div class='slogan'><p>All the news, every day.</p></div>"
            "<div class='body'><p>Story number {0} tells of {1}.</p><p>It goes on with {1} and {0}.</p></div>"
            "<div class='legal'><p>Rights reserved by the owner.</p></div></div></body></html>")
    data = [(i, f"https://one.example/{i}", page.format(i, f"thing{i}"), "x") for i in range(40)]
    data += [(100, "https://two.example/1", page.format(7, "lone"), "x")]
    found = {r[0]: r[2] for r in rows(H.extract(spark.createDataFrame(data, SCHEMA)), "page_id", "url", "text")}
    for i in range(40):
        assert found[i] == f"Story number {i} tells of thing{i}.\nIt goes on with thing{i} and {i}."
    # one page is no evidence
    assert found[100].startswith("All the news") and found[100].endswith("by the owner.")


def test_repeated_lines_of_a_marked_article_stay(spark):
    page = "<html><body><nav>m</nav><article><p>The same line.</p><p>Text {0}.</p></article></body></html>"
    data = [(i, "https://one.example/", page.format(i // 20), "x") for i in range(40)]
    found = rows(H.extract(spark.createDataFrame(data, SCHEMA)), "page_id", "text")
    assert all(t == f"The same line.\nText {i // 20}." for i, t in found)


def test_tree_overrules_marks(spark):
    teasers = ("<html><body><div class='list'><article class='card'><p>Teaser {0}.</p></article></div>"
               "<div class='body'><p>Story number {0} tells of thing{0} at some length, and so on.</p></div></body></html>")
    boxes = ("<html><body><main><div class='text'><p>Story {0} of thing{0}.</p></div>"
             "<div class='box'><p>All the news, every day.</p></div></main><div class='date'><p>Day {0}</p></div></body></html>")
    same = "<html><body><main><div><p>One text.</p></div><div class='x'><p>Another.</p></div></main></body></html>"
    data = [(i, "https://a.example/", teasers.format(i), "x") for i in range(40)]
    data += [(100 + i, "https://b.example/", boxes.format(i), "x") for i in range(40)]
    data += [(200 + i, "https://c.example/", same, "x") for i in range(40)]
    found = dict(rows(H.extract(spark.createDataFrame(data, SCHEMA)), "page_id", "text"))
    for i in range(40):
        assert f"Story number {i} tells of thing{i} at some length, and so on." in found[i]
        assert found[100 + i] == f"Story {i} of thing{i}."
        assert found[200 + i] == "One text.\nAnother."            # a page that is all repeats keeps its mark


def plain_site(sources):
    """Texts of a site's unmarked pages, from a tree built by the book: nested
    dicts, one pass for each measure."""
    paged = []
    for source in sources:
        found, path = [], [()]             # (path of the element, its children, its text)

        class Reader(HTMLParser):
            def handle_starttag(self, tag, attrs):
                label = tag + "".join("." + v for k, v in attrs if k == "class")
                found[self.at[-1]][1].append(label)
                path.append(path[-1] + (label,))
                self.at.append(len(found))
                found.append([path[-1], [], ""])

            def handle_endtag(self, tag):
                path.pop()
                self.at.pop()

            def handle_data(self, data):
                found[self.at[-1]][2] += data

        found.append([(), [], ""])
        reader = Reader()
        reader.at = [0]
        reader.feed(source)
        paged.append(found)
    shown, said = defaultdict(Counter), defaultdict(Counter)
    for found in paged:
        kids, texts = defaultdict(list), defaultdict(set)
        for where, children, text in found:
            kids[where] += [k for k, _ in itertools.groupby(children)]
            if text:
                texts[where].add(text)
        for where, k in kids.items():
            shown[where][tuple(k)] += 1
        for where, t in texts.items():
            said[where].update(t)
    pages = {w: sum(c.values()) for w, c in shown.items()}
    known = {w for w, n in pages.items() if n >= H.EVIDENCE}
    value = {}

    def weigh(where):
        m = pages[where]
        alone = -sum(k / m * math.log(k / m) for k in shown[where].values()) / math.log(m)
        below = [weigh(w) for w in known if w[:-1] == where and w]
        if any(w and w[:-1] == where and w not in known for w in pages):
            below.append(1.0)
        if said[where]:
            below.append(max(0.0, 1 - sum(math.log(k) for k in said[where].values()) / len(said[where]) / math.log(m)))
        weight = H.FADE ** len(shown[where])
        value[where] = (1 - weight) * alone + weight * sum(below) / len(below) if below else alone
        return value[where]

    weigh(())
    best = {w: max([v, *(u for x, u in value.items() if x[:len(w)] == w), *(1.0 for x in pages if x not in known and x[:len(w)] == w)])
            for w, v in value.items()}
    low = {w for w, v in best.items() if v < H.LEAST and w}
    return ["\n".join(text for where, _, text in found if text and not any(where[:i] in low for i in range(1, len(where) + 1)))
            for found in paged]


def neutral_site(rng, n):
    """Pages of one template of neutral classes: fixed, changing and optional parts."""
    def part(depth):
        kind = rng.choice(["fixed", "own", "few", "optional", "group", "group"]) if depth else "group"
        name = rng.choice("abcdefgh")
        if kind == "group" and depth < 4:
            inner = [part(depth + 1) for _ in range(rng.randrange(1, 4))]
            return lambda i, r: f'<div class="{name}">' + "".join(f(i, r) for f in inner) + "</div>"
        word = "".join(rng.choice("klmnop") for _ in range(6))
        text = {"fixed": lambda i, r: word, "own": lambda i, r: f"{word} {i}", "few": lambda i, r: f"{word} {r.randrange(3)}",
                "optional": lambda i, r: f"{word} {i}", "group": lambda i, r: word}[kind]
        return lambda i, r: "" if kind == "optional" and r.random() < 0.9 else f'<section class="{name}">{text(i, r)}</section>'

    template = part(0)
    return [f"<body>{template(i, random.Random(i))}</body>" for i in range(n)]


def test_tree_decides_on_neutral_pages_as_a_plainly_built_one(spark):
    rng, data, want, dropped = random.Random(5), [], {}, 0
    for site in range(25):
        pages = neutral_site(rng, rng.choice([3, 12, 30]))
        for i, (page, text) in enumerate(zip(pages, plain_site(pages))):
            data.append((site * 100 + i, f"https://s{site}.example/{i}", page, "x"))
            want[site * 100 + i] = text
            dropped += text != "\n".join(re.findall(r">([^<>]+)<", page))
    found = dict(rows(H.extract(spark.createDataFrame(data, SCHEMA).repartition(5)), "page_id", "text"))
    assert found == want and dropped > 50


@pytest.mark.parametrize("page", [
    '<div class="has-sidebar layout"><p>main text</div>', '<div id="search-page-wrapper"><article>main text</article></div>',
    '<article class="post social-science">main text', '<form id="aspnetForm"><input value="x"><article>main text</article></form>',
    '<div class="widget"><p>main text</p></div>', '<div class="left-sidebar"><article>card</article></div><article>main text<div class="comments">'
    "<p>a thread of comments longer than the article itself</p></div></article>", '<div class="page-header">x</div><p>main text</p><div id=comments>a</div>'])
def test_names_do_not_take_the_article(page):
    assert H.Page(page).text() == "main text"


def test_a_name_is_settled_by_the_pages_of_the_host(spark):
    # the wrapper named "search" holds the article on most pages, so it stays where the article is short
    page = "<div class='search'><article><p>{0}</p></article></div><article class='x'><p>{1}</p></article>"
    data = [(i, "https://a.example/", page.format(f"a long story of thing{i} and what came of it", f"short {i}"), "x") for i in range(20)]
    data.append((50, "https://a.example/", page.format("brief", "the second article is the longer one here"), "x"))
    found = dict(rows(H.extract(spark.createDataFrame(data, SCHEMA)), "page_id", "text"))
    assert found[3] == "a long story of thing3 and what came of it\nshort 3"
    assert found[50] == "brief\nthe second article is the longer one here"
    assert H.Page(data[-1][2]).text() == "the second article is the longer one here"


def test_names_with_numbers_are_one_style(spark):
    page = "<body><div class='post-{0}'><p>Story {0}.</p><div class='legal-{0}'><p>Rights reserved.</p></div></div></body>"
    pages = spark.createDataFrame([(i, "https://a.example/", page.format(i), "x") for i in range(200)], SCHEMA)
    assert H.weighed_nodes(pages, Scratch(spark, "test")).count() == 6                     # the templates, not the pages
    assert dict(rows(H.extract(pages), "page_id", "text")) == {i: f"Story {i}." for i in range(200)}


@pytest.mark.parametrize("page", [
    "<a " * 350_000, "<div>" * 100_000 + "x", "<i>" * 100_000 + "x<p>y</p>" * 50_000, "<div>" * 50_000 + "</p></section>" * 50_000,
    '<a "' * 250_000, "<a '\"" * 200_000, "<p class='ad'>x" * 60_000, "<script>" + "</script " * 100_000, "<ul><li>" * 80_000], ids=range(9))
def test_a_megabyte_takes_seconds(page):
    began = time.perf_counter()
    found = H.Page(page)
    found.features()
    found.text({1}, {2}, {3}, {4}, {5})
    assert time.perf_counter() - began < 20


def test_driver_pages_against_their_articles(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    out = H.extract(pages).collect()
    assert len(out) == len(source)
    for r in out:
        article = re.search(r"<article>(.*)</article>", source[r.page_id], re.S)[1]
        parts = (" ".join(html_module.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", article))
        assert r.text == "\n".join(x for x in parts if x) and r.n_chars == len(r.text)


def test_odd_pages(spark):
    deep = "<div>" * 3000 + "<p>deep</p>" + "</div>" * 3000
    data = [(1, None, None, None), (2, "", "", "x"), (3, "no url", "plain text &amp; more", "x"), (4, "http://h", "<p>a<p>b</q></p>", "x"),
            (4, "http://h", "<p>a<p>b</q></p>", "x"), (None, "http://h", "<p>no id</p>", "x"), (6, "http://h", deep, "x"),
            (7, "http://h", "<article><p>x " + "word " * 40_000 + "</p></article>", "x"), (8, "http://h", "<p>cut <b", "x"),
            (9, "http://h", "<!-- open <p>no</p>", "x"), (10, "http://h", "<script>no end", "x"), (11, "http://h", "a < b > c &nosuch; &#0;", "x")]
    found = {}
    for i, t, n in rows(H.extract(spark.createDataFrame(data, SCHEMA)), "page_id", "text", "n_chars"):
        assert n == len(t)
        found[i] = t
    assert found[1] == found[2] == found[9] == found[10] == ""
    assert found[3] == "plain text & more" and found[4] == "a\nb" and found[None] == "no id" and found[6] == "deep"
    assert len(found[7]) == len("x " + "word " * 40_000) - 1 and found[8].startswith("cut")
    assert rows(H.extract(spark.createDataFrame([], SCHEMA))) == []
