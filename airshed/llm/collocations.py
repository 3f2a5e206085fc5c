"""Phrase collocations by multikey quicksort of suffix pointers.

Texts are cut into pieces and words; every word is a suffix pointer to the
phrase of up to three words that begins there. Pointers are dealt by their
leading words over the cluster, and each task sorts its own with a
three-way quicksort on one word after the other: a partition of equal
words at depth d is a phrase of d words and its size the phrase's count, a
partition of fewer than ``least`` is abandoned on the spot, the others
go one word deeper.

Before they are dealt, the equal pointers of a batch of texts become one
with a weight, and a leading word's pointers in the batch one row: the
words at depth two, each with its words at depth three and their weights.
A task so sorts rows at the first depth, second words at the next and, of
the few pairs that are left, third words.

A census of word and pair hashes, a few passes over the bytes, goes before.
Leading words whose hash bucket has more than one ``SPREAD``-th of all words
are dealt by their second word as well, pairs with so many by the third:
at most ``SPREAD`` buckets of each kind, whatever the corpus. What such a word
or pair has in one task is a part of its count: parts are kept whatever
their size and added up afterwards.

The counted phrases, a table that grows with the vocabulary and not with
the text, are joined with their parts for the score of the lowest cut, in
exact decimal arithmetic, and with the longer candidates that hold them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airshed.llm.common import Scratch
from airshed.llm.shingles import mix, run_hashes

LEAST, TOP = 10, 2000
SHARE = 50                     # percent of a candidate's count that makes a longer one replace it
UNKNOWN = "und"
SPREAD = 512                   # a leading word with more than this part of all words is dealt by more words
PARTS = 256                    # ways in which such a word is dealt
RANKED_PARTS = 16              # parts of a language that are ranked by themselves first
TASK_WORDS = 1_000_000         # words whose pointers a task sorts, about
CHUNK = 2_000_000              # words whose pointers are combined together before they are sent
CENSUS_BYTES = 1 << 20         # text whose hashes are counted together
SLICE = 20_000                 # rows handed to Spark at once
_BITS = 21                     # of a word's number within a chunk
_STOP = b"."                   # a delimiter cannot be a word
_DELIMITERS = bytes.maketrans(b",;:!?\n\x0b\x0c\r", _STOP * 9)
_BUCKET = np.uint64(48)        # bits of a hash that are not its bucket
_PAIR = np.uint64(0x9E3779B97F4A7C15)
_ROWS = "lang string, w1 string, part int, n bigint, seconds string, fans binary, thirds string, counts binary"
_FOUND = "lang string, w1 string, w2 string, w3 string, f bigint, whole boolean"


def _bytes(text: str) -> bytes:
    """Lower-cased (A-Z only), every delimiter a ``.``."""
    return text.encode("utf-8", "surrogatepass").lower().translate(_DELIMITERS)


def words_of(text: str) -> list[bytes]:
    """The words, lower-cased (A-Z only), with ``.`` where a piece ends."""
    return _bytes(text).replace(_STOP, b" . ").split()


# ---------------------------------------------------------------------------
# Census: how the pointers are dealt
# ---------------------------------------------------------------------------

def _pairs(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * _PAIR + second)


def _count_hashes(text: bytes, words: np.ndarray, pairs: np.ndarray) -> int:
    """Adds the words and pairs of pieces of ``text`` to the bucket counts;
    the number of words."""
    raw = np.frombuffer(text, dtype=np.uint8)
    stop = raw == _STOP[0]
    inside = ~(stop | (raw == 32) | (raw == 9))
    h = run_hashes(raw, inside)
    if not len(h):
        return 0
    piece = np.cumsum(stop)[np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))]
    words += np.bincount((h >> _BUCKET).astype(np.int64), minlength=len(words))
    same = piece[1:] == piece[:-1]
    pairs += np.bincount((_pairs(h[:-1][same], h[1:][same]) >> _BUCKET).astype(np.int64), minlength=len(pairs))
    return len(h)


def _census(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, lang, bucket, n): words and pairs by bucket, words by language."""
    counts = {"word": np.zeros(1 << 16, dtype=np.int64), "pair": np.zeros(1 << 16, dtype=np.int64)}
    held: dict[str, list[bytes]] = {}
    size, total = Counter(), Counter()

    def count(lang: str) -> None:
        total[lang] += _count_hashes(_STOP.join(held.pop(lang)), counts["word"], counts["pair"])
        del size[lang]

    for batch in batches:
        for lang, text in zip(batch.column("lang"), batch.column("text")):
            lang, text = lang.as_py(), text.as_py()
            if text:
                held.setdefault(lang, []).append(_bytes(text))
                size[lang] += len(held[lang][-1])
                if size[lang] >= CENSUS_BYTES:
                    count(lang)
                elif size.total() >= 16 * CENSUS_BYTES:      # many languages
                    count(max(size, key=size.get))
    for lang in list(held):
        count(lang)
    names = ["kind", "lang", "bucket", "n"]
    for kind, n in counts.items():
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.repeat(kind, len(used)), pa.nulls(len(used), pa.string()),
                                          pa.array(used.astype(np.int32)), pa.array(n[used])], names)
    yield pa.RecordBatch.from_arrays([pa.repeat("lang", len(total)), pa.array(list(total), pa.string()),
                                      pa.nulls(len(total), pa.int32()), pa.array(list(total.values()), pa.int64())], names)


# ---------------------------------------------------------------------------
# Before the shuffle: equal pointers of a batch become one
# ---------------------------------------------------------------------------

class _Chunk:
    """Words of one language, numbered."""

    def __init__(self):
        self.number, self.ids = {_STOP: 0}, []

    def add(self, text: str) -> None:
        number = self.number
        self.ids += [number.setdefault(w, len(number)) for w in words_of(text)]
        self.ids.append(0)

    def rows(self, lang: str, hot_words: np.ndarray, hot_pairs: np.ndarray) -> pa.RecordBatch:
        """A row for each leading word, or part of a hot one."""
        ids = np.concatenate([np.array(self.ids, dtype=np.int64), np.zeros(2, dtype=np.int64)])
        first, second = ids[:-2], ids[1:-1]
        third = np.where(second > 0, ids[2:], 0)
        key, n = np.unique(((first << 2 * _BITS) | (second << _BITS) | third)[first > 0], return_counts=True)
        mask = (1 << _BITS) - 1
        w1, w2, w3 = key >> 2 * _BITS, (key >> _BITS) & mask, key & mask
        raw = np.frombuffer(b" ".join(self.number), dtype=np.uint8)
        h = run_hashes(raw, raw != 32)                      # of each number's word
        part = np.zeros(len(key), dtype=np.int64)
        at = np.flatnonzero(hot_words[(h >> _BUCKET).astype(np.int64)][w1])
        if len(at):
            ways = lambda x: (x >> np.uint64(16)).astype(np.int64) % PARTS
            hot = hot_pairs[(_pairs(h[w1[at]], h[w2[at]]) >> _BUCKET).astype(np.int64)]
            part[at] = np.where(hot, 1 + PARTS + ways(h[w3[at]]), 1 + ways(h[w2[at]]))
            order = np.argsort(w1 * (2 * PARTS + 1) + part, kind="stable")
            w1, w2, w3, n, part = (x[order] for x in (w1, w2, w3, n, part))
        fresh = np.concatenate([[True], (w1[1:] != w1[:-1]) | (part[1:] != part[:-1])])[:len(key)]
        row = np.flatnonzero(fresh)
        fan = np.flatnonzero(fresh | np.concatenate([[True], w2[1:] != w2[:-1]])[:len(key)])
        names = [w.decode("utf-8", "surrogatepass") for w in self.number]
        seconds, thirds = [names[i] for i in w2[fan].tolist()], [names[i] for i in w3.tolist()]
        fans = np.diff(np.append(fan, len(key))).astype("<i4").tobytes()
        counts = n.astype("<i4").tobytes()
        ends = np.append(row[1:], len(key))
        spans = list(zip(row.tolist(), ends.tolist(), np.searchsorted(fan, row).tolist(), np.searchsorted(fan, ends).tolist()))
        return pa.RecordBatch.from_arrays(
            [pa.repeat(lang, len(row)), pa.array([names[i] for i in w1[row].tolist()], pa.string()), pa.array(part[row].astype(np.int32)),
             pa.array(np.add.reduceat(n, row) if len(row) else n),
             pa.array([" ".join(seconds[c:d]) for _, _, c, d in spans], pa.string()),
             pa.array([fans[4 * c:4 * d] for _, _, c, d in spans], pa.binary()),
             pa.array([" ".join(thirds[a:b]) for a, b, _, _ in spans], pa.string()),
             pa.array([counts[4 * a:4 * b] for a, b, _, _ in spans], pa.binary())],
            ["lang", "w1", "part", "n", "seconds", "fans", "thirds", "counts"])


def _combiner(hot_words: list[int], hot_pairs: list[int]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a partition's texts, a chunk of each language at a time."""
        hot = [np.isin(np.arange(1 << 16), b) for b in (hot_words, hot_pairs)]
        chunks: dict[str, _Chunk] = {}
        held = 0

        def rows(lang: str) -> Iterator[pa.RecordBatch]:
            nonlocal held
            chunk = chunks.pop(lang)
            held -= len(chunk.ids)
            found = chunk.rows(lang, *hot)
            for at in range(0, len(found), SLICE):
                yield found.slice(at, SLICE)

        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text")):
                lang, text = lang.as_py(), text.as_py()
                if text:
                    chunk = chunks.setdefault(lang, _Chunk())
                    held -= len(chunk.ids)
                    chunk.add(text)
                    held += len(chunk.ids)
                    if len(chunk.number) >= 1 << (_BITS - 1):
                        yield from rows(lang)
                    while held >= CHUNK:
                        yield from rows(max(chunks, key=lambda k: len(chunks[k].ids)))
        for lang in list(chunks):
            yield from rows(lang)

    return work


# ---------------------------------------------------------------------------
# After the shuffle: multikey quicksort
# ---------------------------------------------------------------------------

def equal_partitions(word: np.ndarray, weight: np.ndarray, floor: np.ndarray, pointers: np.ndarray,
                     size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One depth of the quicksort: segments of ``pointers`` (``size`` of each, one
    after the other) are split three ways by ``word`` until equal words stand
    together. Returns the pointers of the equal partitions, their sizes and
    their weights; those lighter than the ``floor`` of their pointers are abandoned.

    All segments are split at once, each by its own pivot, so a round is a
    few passes over the pointers left, and there are about as many rounds
    as a balanced sort has levels.
    """
    rng = np.random.default_rng(7)
    none = np.empty(0, dtype=np.int64)
    kept, sizes, weights = [none], [none], [none]
    while len(pointers):
        start = np.concatenate([[0], np.cumsum(size)[:-1]])
        own = word[pointers]
        # the middle of three random words of each segment
        three = [own[start + (rng.random(len(size)) * size).astype(np.int64)] for _ in range(3)]
        pivot = np.repeat(np.maximum(np.minimum(three[0], three[1]), np.minimum(np.maximum(three[0], three[1]), three[2])), size)
        segment = np.repeat(np.arange(len(size)), size)
        equal = own == pivot
        # the equal ones are complete: their weight is a count
        done, at = pointers[equal], segment[equal]
        heavy = np.bincount(at, weight[done], len(size)).astype(np.int64)
        many = np.bincount(at, minlength=len(size))
        keep = heavy >= floor[done[np.cumsum(many) - many]]
        kept.append(done[keep[at]])
        sizes.append(many[keep])
        weights.append(heavy[keep])
        # a stable split of every segment into its lesser and greater part
        rest = ~equal
        pointers, at, less = pointers[rest], segment[rest], (own < pivot)[rest]
        part = 2 * at + ~less
        size = np.bincount(part, minlength=2 * len(size))
        lesser = np.cumsum(less) - less
        greater = np.arange(len(part)) - lesser
        begin = (np.cumsum(size[::2] + size[1::2]) - size[::2] - size[1::2])[at]
        ahead = np.where(less, lesser - lesser[begin], greater - greater[begin]) if len(part) else part
        moved = np.empty_like(pointers)
        moved[(np.cumsum(size) - size)[part] + ahead] = pointers
        pointers, size = moved, size[size > 0]
    return np.concatenate(kept), np.concatenate(sizes), np.concatenate(weights)


def _deeper(pointers: np.ndarray, size: np.ndarray, begin: np.ndarray, end: np.ndarray, stop: np.ndarray):
    """The children of the pointers, in segments, without those where a piece ends."""
    many = (end - begin)[pointers]
    segment = np.repeat(np.repeat(np.arange(len(size)), size), many)
    child = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(begin[pointers], many)
    goes = ~stop[child]
    sizes = np.bincount(segment[goes], minlength=len(size))
    return child[goes], sizes[sizes > 0]


def _numbers(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def _joined(column: pa.ChunkedArray, kind: pa.DataType) -> pa.Array:
    column = column.cast(kind).combine_chunks()
    return column.chunk(0) if isinstance(column, pa.ChunkedArray) else column


def _sorter(least: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)
        if not sum(b.num_rows for b in batches):
            return
        table = pa.Table.from_batches(batches)
        del batches
        (lang, langs), (w1, firsts) = (_numbers(_joined(table.column(c), pa.large_string())) for c in ("lang", "w1"))
        weight = [table.column("n").to_numpy()]
        part = table.column("part").to_numpy()
        by = [np.where(part == 0, 1, np.where(part <= PARTS, 2, 3))]
        spread = lambda c: pc.split_pattern(_joined(table.column(c), pa.large_string()), " ").flatten()
        many = pc.list_value_length(pc.split_pattern(_joined(table.column("seconds"), pa.large_string()), " ")).to_numpy()
        w2, seconds = _numbers(spread("seconds"))
        w3, thirds = _numbers(spread("thirds"))
        fans, counts = (np.frombuffer(b"".join(table.column(c).to_pylist()), dtype="<i4").astype(np.int64) for c in ("fans", "counts"))
        del table
        row_of = np.repeat(np.arange(len(many)), many)      # of a second word
        second_of = np.repeat(np.arange(len(fans)), fans)   # of a third one
        weight += [np.add.reduceat(counts, np.cumsum(fans) - fans), counts]
        by += [by[0][row_of], by[0][row_of][second_of]]
        ends = [np.cumsum(many), np.cumsum(fans)]
        stops = [w2 == pc.index(seconds, ".").as_py(), w3 == pc.index(thirds, ".").as_py()]

        def phrases(depth: int, pointers: np.ndarray, size: np.ndarray, f: np.ndarray) -> Iterator[pa.RecordBatch]:
            one = pointers[np.cumsum(size) - size]
            whole = pa.array(by[depth - 1][one] <= depth)
            third = second = None
            if depth == 3:
                third, one = one, second_of[one]
            if depth >= 2:
                second, one = one, row_of[one]
            empty = pa.nulls(len(one), pa.string())
            take = lambda words, code, at: words.take(pa.array(code[at])).cast(pa.string())
            out = pa.RecordBatch.from_arrays(
                [take(langs, lang, one), take(firsts, w1, one), empty if second is None else take(seconds, w2, second),
                 empty if third is None else take(thirds, w3, third), pa.array(f), whole], ["lang", "w1", "w2", "w3", "f", "whole"])
            for at in range(0, len(out), SLICE):
                yield out.slice(at, SLICE)

        pointers, size = np.arange(len(lang)), np.array([len(lang)])
        pointers, size, _ = equal_partitions(lang, weight[0], np.zeros(len(lang)), pointers, size)
        for depth, word in ((1, w1), (2, w2), (3, w3)):
            if depth > 1:
                pointers, size = _deeper(pointers, size, ends[depth - 2] - (many if depth == 2 else fans), ends[depth - 2], stops[depth - 2])
            # complete partitions below ``least`` go; a part of a count stays
            floor = np.where(by[depth - 1] <= depth, least, 1)
            pointers, size, f = equal_partitions(word, weight[depth - 1], floor, pointers, size)
            yield from phrases(depth, pointers, size, f)

    return work


def phrase_counts(docs: DataFrame, scratch: Scratch, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Two written tables: (lang, w1, w2, w3, f) of every phrase of 1 to 3
    words with f >= ``least``, the words beyond its own being null, and
    (lang, n) with the number of all words.

    Null and empty texts have no words; a null ``lang`` is ``und``. Texts are
    read whole, repeated rows count each. Empty table: empty results.
    """
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col("text").cast("string").alias("text"))
    census = scratch.settle(texts.mapInArrow(_census, "kind string, lang string, bucket int, n bigint")
                            .groupBy("kind", "lang", "bucket").agg(F.sum("n").alias("n")))
    totals = census.where("kind = 'lang' and n > 0").select("lang", "n")
    words = totals.agg(F.sum("n")).first()[0] or 0
    # at most SPREAD buckets of a kind can have more than one SPREAD-th of all
    hot = census.where("bucket is not null").where(F.col("n") > words // SPREAD).select("kind", "bucket").collect()
    hot = {k: [r["bucket"] for r in hot if r["kind"] == k] for k in ("word", "pair")}
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-words // TASK_WORDS))
    dealt = texts.mapInArrow(_combiner(hot["word"], hot["pair"]), _ROWS).repartition(tasks, "lang", "w1", "part")
    found = scratch.settle(dealt.mapInArrow(_sorter(least), _FOUND))
    parts = found.where(~F.col("whole")).groupBy("lang", "w1", "w2", "w3").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    out = scratch.settle(found.where("whole").drop("whole").unionByName(parts))
    scratch.drop(found)
    return out, totals


def collocations(docs: DataFrame, least: int = LEAST, share: int = SHARE, top: int = TOP) -> DataFrame:
    """The first ``top`` collocations of each language: lang, rank, phrase, a
    (its count), l and r (of the parts of the lowest-scoring cut), n, score.

    score = floor(10**6 * a * a / (l * r)), computed in 38-digit decimals.
    Equal scores of two cuts: the cut after the first word counts. Candidates
    inside a longer one with at least ``share`` percent of their count go.
    Ranks are unique: score and count descending, then the phrase in byte order.
    """
    scratch = Scratch(docs.sparkSession, "collocations")
    found, totals = phrase_counts(docs, scratch, least)
    counts = found.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("part"), F.col("f"))

    def cut(k: int, first: tuple[str, ...], rest: tuple[str, ...], when: str) -> DataFrame:
        return found.where(when).select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), F.col("f").alias("a"), F.lit(k).alias("k"),
                                        F.concat_ws(" ", *first).alias("first"), F.concat_ws(" ", *rest).alias("rest"))

    cuts = cut(1, ("w1",), ("w2", "w3"), "w2 is not null").unionByName(cut(2, ("w1", "w2"), ("w3",), "w3 is not null"))
    for part, name in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(counts.select("lang", F.col("part").alias(part), F.col("f").alias(name)), ["lang", part])
    a, l, r = (F.col(c).cast("decimal(20,0)") for c in "alr")
    scored = cuts.withColumns({"_up": F.lit(1_000_000).cast("decimal(7,0)") * a * a, "_low": l * r}) \
        .withColumn("score", F.expr("_up div _low"))
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("_cut"))
    longer = found.where("w3 is not null").select("lang", F.explode(F.array(F.concat_ws(" ", "w1", "w2"), F.concat_ws(" ", "w2", "w3")))
                                                  .alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("_longer"))
    kept = lowest.join(longer, ["lang", "phrase"], "left").where(
        F.col("_longer").isNull() | (F.col("_longer") * 100 < F.col("a") * share))
    # the best of each of some parts of a language, then of the language: its last ranking sees RANKED_PARTS * top rows at most
    order = [F.desc("_cut.score"), F.desc("a"), F.col("phrase")]
    some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(RANKED_PARTS))).orderBy(*order)
    few = kept.withColumn("_place", F.row_number().over(some)).where(F.col("_place") <= top)
    best = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("_cut.l").alias("l"), F.col("_cut.r").alias("r"), "n",
        F.col("_cut.score").alias("score"))


def oracle_sql() -> str:
    """The collocations of ``documents`` in DuckDB SQL."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
with pieces as (
  select coalesce(lang, '{UNKNOWN}') as lang,
         unnest(regexp_split_to_array(translate(text, '{upper}', '{upper.lower()}'), '[.,;:!?\\x0A-\\x0D]')) as piece
  from documents where text is not null),
worded as (
  select lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') as ws from pieces),
suffixes as (
  select lang, ws, unnest(range(1, len(ws) + 1)) as i from worded where len(ws) > 0),
phrases as (
  select lang, d, array_to_string(ws[i:i + d - 1], ' ') as phrase, ws[i:i + d - 1] as words, count(*) as f
  from suffixes, (values (1), (2), (3)) depths(d) where i + d - 1 <= len(ws) group by all),
totals as (select lang, sum(f) as n from phrases where d = 1 group by lang),
frequent as (select * from phrases where f >= {LEAST}),
halves as (
  select lang, phrase, f as a, k, array_to_string(words[1:k], ' ') as head, array_to_string(words[k + 1:], ' ') as tail
  from frequent, (values (1), (2)) cut(k) where k < d),
cuts as (
  select h.lang, h.phrase, a, k, x.f as l, y.f as r, ((1000000::hugeint * a * a) // (x.f::hugeint * y.f))::bigint as score
  from halves h join frequent x on x.lang = h.lang and x.phrase = h.head join frequent y on y.lang = h.lang and y.phrase = h.tail),
lowest as (
  select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1),
longer as (
  select lang, unnest([array_to_string(words[1:2], ' '), array_to_string(words[2:3], ' ')]) as phrase, f from frequent where d = 3),
kept as (
  select lowest.* from lowest left join (select lang, phrase, max(f) as most from longer group by all) using (lang, phrase)
  where most is null or 100 * most < {SHARE} * a),
ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score
from ranked join totals using (lang) where rank <= {TOP}
"""
