"""Main text of web pages by a site style tree.

The DOMs of a host's pages are merged into one tree of style nodes: a node
is the chain of its ancestors' tags and classes. Every page adds to a node
one presentation (the run-collapsed sequence of its children) and the
contents of its own text. A node whose presentations differ from page to
page is important; so is one whose contents are its page's own, while
contents that repeat on a host's pages carry no information: a content on k
of the node's m pages has the entropy log k / log m. A branch's composite
importance weighs its own presentation entropy against the mean of its
children; branches in which no node reaches ``LEAST`` are taken out of each
page.

What an element says of itself is a prior in that tree. A name (navigation,
footer, form, advert, comments ...; whole class tokens only) leaves a branch
``NAMED`` of its importance, so it goes, unless the branch holds the article
itself: most of the text under the page's marks, or nearly all text of a
page without marks. The tree settles this by the majority of a host's
pages, a page alone where the host is no evidence. Where a page marks its article,
a branch inside the mark goes only if nothing in it varies at all
(``MARKED_LEAST``), unless the whole mark is like that; and where the tree finds
more of a page's own text outside the marks than there is inside, the page
is read as one without marks. Hidden elements and controls are never text.

Pages are parsed where they lie, once for the tree and once for the text;
what is shuffled are counts by node.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable, Iterator, Set

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import Scratch

LEAST = 0.2                    # composite importance below this is noise
MARKED_LEAST = 0.05            # the same, for a branch inside a marked article
OWN = 0.8                      # importance of contents that speak for a node outside the marks
NAMED = 0.15                   # factor of the importance of a branch named as noise
HOLDS = 0.8                    # share of a page's text that a branch holds which its name cannot condemn
FADE = 0.9                     # weight of a node's children: FADE ** (number of presentations)
EVIDENCE = 5                   # pages a node needs to be weighed
LINKED = 0.6                   # share of link text that makes a block a menu, outside articles

# fixed values: element names by role
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math object select xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split())
CELLS = frozenset("td th br".split())
CONTROL_TAGS = frozenset("head button dialog input label".split())
NOISE_TAGS = frozenset("nav footer aside form menu fieldset".split())
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb "
    "breadcrumbs sidebar footer cookie cookies consent gdpr notice popup modal overlay newsletter subscribe subscription signup "
    "social share sharing related recommended recommendations comment comments reply replies respond disqus login search copyright "
    "widget toolbar pagination pager skip contentinfo complementary dialog alert masthead topbar hidden".split())
# fixed values: what may stand beside a noise word in a compound name
PLACE_WORDS = frozenset(
    "site page main left right top bottom global primary secondary container box block area section bar list item items link links "
    "form group inner sticky fixed mobile desktop small large slot unit".split())
ARTICLE_TAGS = frozenset(["article", "main"])
CLOSES_P = BLOCKS - frozenset(["body", "html", "head", "tr", "tbody", "thead", "tfoot", "li", "dd", "dt"])
SIBLINGS = {"li": ("li", ("ul", "ol", "menu", "dir")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)),
            "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")),
            "option": ("option", ("select",))}

# a tag ends at its bracket, or, if its quotes do not pair or the bracket is missing, at the next one of either kind
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/<>]*)(?:((?>(?:\"[^\"<>]*\"|'[^'<>]*'|\"[^\"<]*\"(?=[\s/>])|'[^'<]*'(?=[\s/>])|[^'\"<>])*))>|([^<>]*)>?)", re.S)
_RAW_END = {tag: re.compile(rf"</{tag}\b[^<>]*>?", re.I) for tag in RAW}
_ATTR = re.compile(r"""(?<![\w-])(class|id|role|itemprop|style|aria-hidden|hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORDS = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"[0-9]+")
_HOST = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", re.I)


def host_of(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found[1].lower() if found else ""


def _hash(*parts: str) -> int:
    return xxhash.xxh64_intdigest("\x1f".join(parts).encode("utf-8", "surrogatepass")) - (1 << 63)


def named_noise(tokens: list[str], more: frozenset[str] = frozenset()) -> bool:
    """Whether a whole name says noise: a noise word, or noise words put
    together with each other and with words of place."""
    for token in tokens:
        parts = _WORDS.findall(token)
        if any(p in NOISE_WORDS or p in more for p in parts) and all(
                p in NOISE_WORDS or p in more or p in PLACE_WORDS or len(p) == 1 for p in parts):
            return True
    return False


class _Node:
    """A node of a page: ``article`` lies in a mark, ``marks`` is one, ``suspect``
    is named as noise, ``gone`` is never text; ``home`` takes its text."""

    __slots__ = ("tag", "key", "parent", "gone", "article", "marks", "suspect", "home", "children", "chars", "marked", "spared")

    def __init__(self, tag, key, parent, gone=False, article=False, marks=False, suspect=False):
        self.tag, self.key, self.parent = tag, key, parent
        self.gone, self.article, self.marks, self.suspect = gone, article, marks, suspect
        self.home = self if parent is None or tag in BLOCKS else parent.home
        self.children: list[str] = []
        self.chars = self.marked = 0
        self.spared = False


class Page:
    """Blocks of a page: (node, text, code points of link text). Every step
    is proportional to the page, whatever its markup and depth."""

    def __init__(self, source: str | None):
        root = _Node("", 0, None)
        self.nodes: list[_Node] = [root]
        self.blocks: list[tuple[_Node, str, int]] = []
        self._stack, self._text, self._links, self._in_link = [root], [], 0, 0
        self._home, self._opened = root, Counter()
        if source:
            self._read(source)
        self._weigh_names()

    def _flush(self):
        if self._text:
            text = " ".join("".join(self._text).split())
            if text:
                self.blocks.append((self._home, text, self._links))
            self._text, self._links = [], 0

    def _add(self, piece: str):
        node = self._stack[-1]
        if not piece or node.gone:
            return
        piece = html.unescape(piece)
        if not self._text:
            self._home = node.home
        self._text.append(piece)
        if self._in_link:
            self._links += len("".join(piece.split()))

    def _close(self, names, stops):
        if not any(self._opened[n] for n in names):
            return
        for at in range(len(self._stack) - 1, 0, -1):
            tag = self._stack[at].tag
            if tag in names:
                for node in self._stack[at:]:
                    self._opened[node.tag] -= 1
                    self._in_link -= node.tag == "a"
                del self._stack[at:]
                return
            if tag in stops:
                return

    def _open(self, tag: str, attributes: str):
        parent = self._stack[-1]
        tokens: list[str] = []
        classes, role = "", ""
        hidden = False
        if attributes:
            for m in _ATTR.finditer(attributes):
                name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
                if name == "hidden" or name == "aria-hidden" and value == "true":
                    hidden = True
                elif name == "style":
                    hidden |= "display:none" in (style := value.replace(" ", "")) or "visibility:hidden" in style
                elif name == "itemprop":
                    role += " " + value
                else:
                    tokens += value.split()
                    if name == "class":
                        classes = " ".join(sorted(value.split()))
                    elif name == "role":
                        role += " " + value
        page = tag in ("html", "body")
        marks = tag in ARTICLE_TAGS or "main" in role.split() or "articlebody" in role
        suspect = not page and (tag in NOISE_TAGS or tag == "header" and not parent.article or bool(tokens) and named_noise(
            tokens, frozenset() if parent.article else frozenset(["header"])))
        # names with numbers in them are one style; what a name means is part of it
        label = tag + ("." + _DIGITS.sub("#", classes) if classes else "") + "!" * suspect + "@" * marks
        parent.children.append(label)
        node = _Node(tag, _hash(str(parent.key), label), parent, parent.gone or not page and (hidden or tag in CONTROL_TAGS),
                     parent.article or marks, marks, suspect)
        self.nodes.append(node)
        return node

    def _read(self, source: str):
        at, end = 0, len(source)
        while at < end:
            found = _TOKEN.search(source, at)
            if not found:
                self._add(source[at:])
                break
            self._add(source[at:found.start()])
            at = found.end()
            if found[2] is None:
                continue
            tag, attributes = found[2].lower(), found[3] if found[3] is not None else found[4]
            if found[1]:
                if tag in BLOCKS:
                    self._flush()
                elif tag in CELLS:
                    self._add(" ")
                self._close((tag,), () if tag in BLOCKS else BLOCKS)
                continue
            if tag in RAW:
                stop = _RAW_END[tag].search(source, at)
                at = stop.end() if stop else end
                self._add(" ")
                continue
            if tag in BLOCKS:
                self._flush()
            elif tag in CELLS:
                self._add(" ")
            if tag in CLOSES_P:
                self._close(("p",), ("table", "td", "th", "body", "article", "div", "section", "li"))
            if tag in SIBLINGS:
                names, stops = SIBLINGS[tag]
                self._close(names.split(), stops)
            node = self._open(tag, attributes)
            if tag not in VOID and not attributes.rstrip().endswith("/"):
                self._stack.append(node)
                self._opened[tag] += 1
                self._in_link += tag == "a"
        self._flush()

    def _weigh_names(self):
        """Which named nodes hold the article on this page: half or more of
        the text under marks, the marks being inside them, or ``HOLDS`` of a
        page's text if it has no mark."""
        for node, text, _ in self.blocks:
            node.chars += len(text)
        for n in reversed(self.nodes):
            if n.parent is not None:
                n.parent.chars += n.chars
                n.parent.marked += n.chars if n.marks and not n.parent.article else n.marked
        root = self.nodes[0]
        for n in self.nodes:
            if n.suspect:
                n.spared = 2 * n.marked >= root.marked if root.marked else n.chars >= HOLDS * root.chars > 0
        dropped = self._dropped(lambda n: n.suspect and not n.spared)
        self.marked = any(n.article and n not in dropped for n, _, _ in self.blocks)
        self.unnamed = dropped

    def _dropped(self, at: Callable[[_Node], bool]) -> set[_Node]:
        """The nodes for which ``at`` holds, and all below them (parents come first in ``nodes``)."""
        out: set[_Node] = set()
        for n in self.nodes:
            if n.parent in out or at(n):
                out.add(n)
        return out

    def text(self, noise: Set[int] = frozenset(), plain: Set[int] = frozenset(), own: Set[int] = frozenset(),
             named: Set[int] = frozenset(), spared: Set[int] = frozenset()) -> str:
        """``noise``: unimportant branches; ``plain``: those to leave out
        inside a mark; ``own``: nodes whose contents are important; ``named`` and
        ``spared``: the branches with a noise name that go, and that stay."""
        gone = self._dropped(lambda n: n.suspect and (n.key in named or n.key not in spared and not n.spared))
        low = self._dropped(lambda n: n.key in noise) if noise else gone
        if self.marked:
            kept = self._marked_kept(plain)
            inside = [text for node, text, _ in self.blocks if node in kept and node not in gone]
            outside = [text for node, text, links in self.blocks if not node.article and node.key in own
                       and not self._menu(text, links) and node not in low and node not in gone]
            if sum(map(len, outside)) <= sum(map(len, inside)):
                return "\n".join(inside)
        return "\n".join(text for node, text, links in self.blocks
                         if not self._menu(text, links) and node not in low and node not in gone)

    @staticmethod
    def _menu(text: str, links: int) -> bool:
        return links > LINKED * len("".join(text.split()))

    def _marked_kept(self, plain) -> set[_Node]:
        """Nodes in a mark, without the plain branches below a mark that is not plain itself."""
        out: set[_Node] = set()
        above = self._dropped(lambda n: n.key in plain) if plain else set()
        whole: set[_Node] = set()          # in a mark that is plain from the top
        for n in self.nodes:
            if not n.article:
                continue
            if not n.parent.article:
                whole.update([n] if n in above else [])
                out.add(n)
            else:
                if n.parent in whole:
                    whole.add(n)
                if n in whole or n.parent in out and n.key not in plain:
                    out.add(n)
        return out

    def features(self) -> dict[tuple[int, int, int, int, int], int]:
        """(node, parent, kind, feature, suspect) and whether a suspect is
        spared: kind 0 a presentation, 1 a content, 2 that a page with marks
        has text there outside of them. Below a condemned name nothing is told."""
        out: dict[tuple[int, int, int, int, int], int] = {}
        shown: dict[int, list[str]] = {}
        first: dict[int, _Node] = {}
        for n in self.nodes:
            if n.gone or n.parent in self.unnamed:
                continue
            first.setdefault(n.key, n)
            kids = shown.setdefault(n.key, [])
            kids += [c for i, c in enumerate(n.children) if i == 0 or c != n.children[i - 1]]
        for key, kids in shown.items():
            n = first[key]
            out[(key, n.parent.key if n.parent else 0, 0, _hash("p", *kids), int(n.suspect))] = int(n.spared)
        for node, text, _ in self.blocks:
            if node in self.unnamed:
                continue
            above = node.parent.key if node.parent else 0
            out[(node.key, above, 1, _hash("c", text), int(node.suspect))] = 0
            if self.marked and not node.article:
                out[(node.key, above, 2, 0, int(node.suspect))] = 0
        return out


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for url, source in zip(pdf["url"], pdf["html"]):
            if source:
                host = host_of(url)
                out += [(host, *f, spared) for f, spared in Page(source).features().items()]
        yield pd.DataFrame(out, columns=["host", "node", "parent", "kind", "feature", "suspect", "spared"])


def _weigh(pdf: pd.DataFrame) -> pd.DataFrame:
    """Composite importance of a host's nodes, children before parents.
    ``rare``: a node's children on too few pages to be weighed, which count as important."""
    nodes = {int(r.node): r for r in pdf.itertuples(index=False)}
    children: dict[int, list[int]] = {}
    for key, r in nodes.items():
        if key != int(r.parent):
            children.setdefault(int(r.parent), []).append(key)
    value: dict[int, float] = {}
    best: dict[int, float] = {}      # of a node and all below it
    most: dict[int, float] = {}      # the same, contents by themselves
    stack = [(k, False) for k in nodes if int(nodes[k].parent) not in nodes or k == int(nodes[k].parent)]
    while stack:
        key, ready = stack.pop()
        if not ready:
            stack.append((key, True))
            stack += [(c, False) for c in children.get(key, [])]
            continue
        r = nodes[key]
        below = [value[c] for c in children.get(key, [])] + [1.0] * int(r.rare > 0)
        if r.contents:
            below.append(float(r.content_importance))
        if not below:
            value[key] = float(r.presentation_importance)
        else:
            weight = FADE ** float(r.presentations)
            value[key] = (1 - weight) * float(r.presentation_importance) + weight * float(np.mean(below))
        rare = 1.0 if r.rare else 0.0
        best[key] = max([value[key], rare, *(best[c] for c in children.get(key, []))])
        most[key] = max([value[key], rare, float(r.content_importance) if r.contents else 0.0, *(most[c] for c in children.get(key, []))])
    held = {k for k, r in nodes.items() if r.suspect and 2 * r.spared >= r.pages}
    # a branch is noise if nothing in it is important; a name takes most of its importance unless it holds the article
    low = [k for k, v in best.items() if v < LEAST and k != 0 and not nodes[k].suspect]
    named = [k for k, v in best.items() if nodes[k].suspect and k not in held and NAMED * v < LEAST]
    plain = {k for k, v in most.items() if v < MARKED_LEAST and k != 0 and not nodes[k].suspect}
    own = [k for k, r in nodes.items() if r.outside and r.content_importance >= OWN]
    lists = {"noise": low, "plain": [k for k in plain if int(nodes[k].parent) not in plain], "own": own, "named": named,
             "spared": [k for k in nodes if nodes[k].suspect and k not in set(named)]}
    return pd.DataFrame({"host": [pdf["host"].iloc[0]], **{n: [np.array(sorted(x), dtype=np.int64)] for n, x in lists.items()}})


LISTS = ("noise", "plain", "own", "named", "spared")


def weighed_nodes(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """The style nodes of each host that have ``EVIDENCE`` pages, with their
    counts and entropies; what is rarer is folded into a number at its
    parent, so a host has as many rows as it has templates, not pages."""
    rows = pages.select("url", "html").mapInPandas(
        _features, "host string, node long, parent long, kind int, feature long, suspect int, spared int")
    # written, as four aggregates read it: the pages are parsed once for all of them
    counted = scratch.settle(rows.groupBy("host", "node", "parent", "kind", "feature", "suspect").agg(
        F.count(F.lit(1)).alias("k"), F.sum("spared").alias("spared")))
    shown = counted.where("kind = 0")
    # a node's pages: each gives it one presentation
    nodes = shown.groupBy("host", "node", "parent", "suspect").agg(
        F.sum("k").alias("pages"), F.count(F.lit(1)).alias("presentations"), F.sum(F.col("k") * F.log("k")).alias("klogk"),
        F.sum("spared").alias("spared"))
    rare = nodes.where(F.col("pages") < EVIDENCE).groupBy("host", F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("rare"))
    m = F.col("pages").cast("double")
    known = nodes.where(F.col("pages") >= EVIDENCE).withColumn("presentation_importance", (F.log(m) - F.col("klogk") / m) / F.log(m))
    contents = counted.where("kind = 1").groupBy("host", "node").agg(
        F.count(F.lit(1)).alias("contents"), F.sum(F.log("k")).alias("logs"))
    outside = counted.where("kind = 2").groupBy("host", "node").agg(F.sum("k").alias("outside"))
    both = known.join(contents, ["host", "node"], "left").join(outside, ["host", "node"], "left").join(rare, ["host", "node"], "left")
    return both.withColumn(
        "content_importance", F.greatest(F.lit(0.0), 1 - F.col("logs") / F.col("contents") / F.log(m))).select(
        "host", "node", "parent", "suspect", "spared", "pages", "presentations", "presentation_importance",
        F.coalesce("contents", F.lit(0)).alias("contents"), F.coalesce("content_importance", F.lit(1.0)).alias("content_importance"),
        F.coalesce("outside", F.lit(0)).alias("outside"), F.coalesce("rare", F.lit(0)).alias("rare"))


def noise_nodes(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """host and its lists of style nodes: ``noise`` below ``LEAST``, ``plain``
    the topmost ones below ``MARKED_LEAST``, ``own`` with own contents outside
    the marks of pages that have marks, ``named`` and ``spared`` the branches
    with a noise name that go and that stay."""
    schema = ", ".join(f"{n} array<long>" for n in LISTS)
    return weighed_nodes(pages, scratch).groupBy("host").applyInPandas(_weigh, f"host string, {schema}")


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        lists = ([set() if x is None else set(map(int, x)) for x in row] for row in zip(*(pdf[n] for n in LISTS)))
        text = [Page(s).text(*row) for s, row in zip(pdf["html"], lists)]
        yield pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "text": text, "n_chars": [len(t) for t in text]})


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for each row of ``pages`` (page_id, url, html).

    Null or empty html: empty text. A null or unreadable url: such pages form
    a host of their own. Repeated rows: a row each. Pages of any length, depth
    and markup are read whole, in time proportional to them: a tag that is
    not closed ends at the next one, an element at the end of the one around
    it. Empty table: empty result. Other columns are not read.
    """
    scratch = Scratch(pages.sparkSession, "site-style")
    pages = pages.select(F.col("page_id").cast("long").cast("string").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.col("html").cast("string").alias("html"))
    noise = scratch.settle(noise_nodes(pages, scratch))
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    return (
        pages.withColumn("host", host).join(noise, "host", "left").select("page_id", "url", "html", *LISTS)
        .mapInPandas(_extract, "page_id string, url string, text string, n_chars long")
        .withColumn("page_id", F.col("page_id").cast("long"))
    )
