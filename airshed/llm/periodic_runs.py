"""Runs of periodic words, from the maximal pairs of a text.

A run is a stretch of words with smallest period q, at least ``least`` words
and ``times`` periods long, that no neighbouring word extends. Its first
place ``s`` and ``s + q`` begin the same words, differ in their left words and
differ after ``length - q`` words: a maximal pair. Conversely a maximal pair at
distance q with ``l`` common words is a stretch of ``q + l`` words with period
q that nothing extends. So the runs are the maximal pairs whose distance
is at most ``l / (times - 1)`` and whose stretch is long enough, the one of
smallest distance for each stretch; nothing is extended or compared again.

Maximal pairs come from the LCP-interval tree of the text's suffixes,
bottom up. A node holds the places of its suffixes in one list per left
word; where two children meet, places of the smaller are looked up in the
larger's lists of another left word. Only places within reach matter, and
because words that overlap themselves by half are periodic, the places
within reach to the right of one all have the same left word, and those to
its left too but for the farthest: one list a side is read.

Only common stretches of ``least * (times - 1) / times`` words or more can
make a run, so a text without a repeated stretch of that length (told by
hashes, which can only keep too many) has no node to visit. Every text is
handled in its own row, in memory linear in its words; no rows are moved.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import in_slices, with_ids
from airshed.llm.shingles import mix

LEAST, TIMES = 24, 3
PLANTED = 10                   # one document in so many gets the query's periodic tail
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def words_of(text: str | None) -> list[bytes]:
    """The runs of bytes other than space and 0x09-0x0D (none for null)."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def _repeats(x: np.ndarray, width: int) -> bool:
    """Whether two stretches of the largest power of two up to ``width`` words have one hash."""
    h, w = mix(x.astype(np.uint64) + _FACTOR), 1
    while 2 * w <= width:
        h = mix(h[:-w] * _FACTOR + h[w:])
        w *= 2
    h.sort()
    return bool((h[1:] == h[:-1]).any())


def suffix_order(x: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``x`` (numbers from 1) in order, by doubling."""
    n = len(x)
    rank, k = x.astype(np.int64), 1
    while True:
        key = rank * np.int64(max(n, int(rank.max())) + 1)
        if k < n:
            key[:-k] += rank[k:]
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.concatenate([[1], 1 + np.cumsum(key[1:] != key[:-1])])
        if new[-1] == n:
            return order
        rank[order] = new
        k *= 2


def common_lengths(x: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Words that each suffix shares with the one before it in ``order``."""
    n = len(x)
    before = np.full(n, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    lengths = np.zeros(n, dtype=np.int64)
    words, before, out, l = memoryview(x), memoryview(before), memoryview(lengths), 0
    for i in range(n):
        j = before[i]
        if j < 0:
            l = 0
            continue
        stop = n - (i if i > j else j)
        while l < stop and words[i + l] == words[j + l]:
            l += 1
        out[i] = l
        if l:
            l -= 1
    return lengths[order]


class _Node:
    """Places of one node: all of them in order, and by left word."""

    __slots__ = ("places", "lists")

    def __init__(self, place: int, left: int):
        self.places, self.lists = [place], {left: [place]}


def find_runs(words: list, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and period. ``times`` is
    at least 3. Fewer than ``least`` words: none."""
    n, shortest = len(words), -(-least * (times - 1) // times)
    if n < max(least, times):
        return []
    seen: dict = {}
    x = np.fromiter((seen.setdefault(w, len(seen) + 1) for w in words), dtype=np.int64, count=n)
    if not _repeats(x, shortest):
        return []
    order = suffix_order(x)
    shared = common_lengths(x, order)
    left = memoryview(np.concatenate([[0], x[:-1]]))
    found: dict[tuple[int, int], int] = {}

    def pair(i: int, j: int, l: int) -> None:
        q = j - i
        if q + l >= least and found.get((i, q + l), n) > q:
            found[i, q + l] = q

    def merged(a: _Node, b: _Node, l: int) -> _Node:
        """Two children of a node whose suffixes share ``l`` words."""
        if len(a.places) < len(b.places):
            a, b = b, a
        reach, places = l // (times - 1), a.places
        for own, of in b.lists.items():
            for i in of:
                at = bisect_left(places, i)
                if at < len(places) and places[at] <= i + reach and (other := left[places[at]]) != own:
                    alike = a.lists[other]
                    for k in range(bisect_left(alike, i), bisect_left(alike, i + reach + 1)):
                        pair(i, alike[k], l)
                at = bisect_left(places, i - reach)
                if at < len(places) and places[at] < i and left[places[at]] != own:
                    pair(places[at], i, l)
        for own, of in b.lists.items():
            mine = a.lists.setdefault(own, [])
            for i in of:
                insort(places, i)
                insort(mine, i)
        return a

    long = np.concatenate([shared >= shortest, [False]])
    edges = np.flatnonzero(np.diff(long))          # from the suffix before the first long one to the last long one
    for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
        suffixes, lengths = order[begin:end + 1].tolist(), shared[begin:end + 1].tolist()
        stack: list[list] = []
        node = _Node(suffixes[0], left[suffixes[0]])
        for i, l in zip(suffixes[1:], lengths[1:]):
            while stack and stack[-1][0] > l:
                depth, first = stack.pop()
                node = merged(first, node, depth)
            if stack and stack[-1][0] == l:
                stack[-1][1] = merged(stack[-1][1], node, l)
            else:
                stack.append([l, node])
            node = _Node(i, left[i])
        while stack:
            depth, first = stack.pop()
            node = merged(first, node, depth)
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run repeats: of each run its first period stays."""
    if not runs:
        return words
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        cover[start + period] += 1
        cover[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(cover[:-1]) == 0)]


def planted(doc_id: str | None, words: list[bytes]) -> list[bytes]:
    """The query's edit: in a tenth of the documents, told by the crc32 of the
    id, the words from some place on repeat with some period."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(doc_id.encode())
    g, n = h // PLANTED, len(words)
    if h % PLANTED:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def runs(docs: DataFrame, edit: Callable[[str | None, list[bytes]], list[bytes]] | None = None,
         least: int = LEAST, times: int = TIMES) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period by start, then
    period), collapsed (the kept words joined by one space) for each row.

    Null, empty and blank texts: no words, no runs, an empty text. Texts of
    any length are read whole. Repeated rows each get their row; a null id
    stays null and is not edited. Empty table: empty result. Other columns
    are not read. ``edit`` changes a document's words before.
    """
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in in_slices(batches):
            n, found, kept = [], [], []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                words = words_of(text)
                if edit:
                    words = edit(doc_id, words)
                r = find_runs(words, least, times)
                n.append(len(words))
                found.append([{"start": s, "length": l, "period": q} for s, l, q in r])
                kept.append(b" ".join(collapsed(words, r)).decode("utf-8", "surrogatepass"))
            yield pd.DataFrame({"doc_id": pdf["doc_id"].to_numpy(), "n_words": n, "runs": found, "collapsed": kept})

    return with_ids(docs).mapInPandas(work, f"doc_id string, n_words bigint, runs {_RUNS}, collapsed string").withColumn(
        "doc_id", F.col("doc_id").cast("long"))


def digest(found: DataFrame) -> DataFrame:
    """The digest columns of ``runs`` rows. The best run has the greatest
    length / period, compared exactly; ties go to the smallest start, then
    period, which is their order."""
    best = F.aggregate(F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))), F.get("runs", F.lit(0)), lambda b, r: F.when(
        r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("_best.start").alias("start"),
        F.col("_best.length").alias("length"), F.col("_best.period").alias("period"),
        F.expr("1000 * _best.length div _best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
