"""Collocations against plain counting of all phrases."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from airshed.llm import collocations as C
from airshed.llm.common import Scratch
from llm_cases import AWKWARD, rows

SF = "/root/testdata/sf0.001"
_LOWER = {i: i + 32 for i in range(65, 91)}


def counted(data):
    """{lang: {phrase words: count}} and words by language, of (text, lang) rows."""
    phrases, words = {}, Counter()
    for text, lang in data:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(_LOWER)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(ws)
            own = phrases.setdefault(lang, Counter())
            for d in (1, 2, 3):
                own.update(tuple(ws[i:i + d]) for i in range(len(ws) - d + 1))
    return phrases, words


def plain(data, least=10, share=50, top=2000):
    phrases, words = counted(data)
    out = []
    for lang, f in phrases.items():
        found = []
        for p, a in f.items():
            if len(p) < 2 or a < least:
                continue
            if any(len(q) > len(p) and b >= least and 100 * b >= share * a and any(q[i:i + len(p)] == p for i in range(len(q)))
                   for q, b in f.items() if len(q) == 3):
                continue
            cuts = [(1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, words[lang], -s))
    return sorted(out)


def data_of(seed, n=60):
    rng = random.Random(seed)
    vocabulary = ["new", "york", "city", "Of", "the", "é", "😀x", "a-b", "hot"]
    out = []
    for _ in range(n):
        words = []
        for _ in range(rng.randrange(40)):
            words += rng.choice([["New", "York", "city"], ["of", "the"], [rng.choice(vocabulary)]])
            words[-1] += rng.choice(["", "", "", "", ".", ",", "\n", "\t", "!x"])
        out.append((" ".join(words), rng.choice(["en", "en", "de", None])))
    return out


@pytest.mark.parametrize("spread, task_words", [(C.SPREAD, C.TASK_WORDS), (1, 200), (8, 100), (10**9, 100)])
def test_matches_plain_counting(spark, monkeypatch, spread, task_words):
    # no, some or all words and pairs are dealt by more words, over several tasks
    monkeypatch.setattr(C, "SPREAD", spread)
    monkeypatch.setattr(C, "TASK_WORDS", task_words)
    data = data_of(3)
    docs = spark.createDataFrame([(t, l, "x") for t, l in data], "text string, lang string, phrase string").repartition(5)
    assert sorted(rows(C.collocations(docs))) == plain(data)
    assert sorted(rows(C.collocations(docs, least=3, share=90, top=7))) == plain(data, 3, 90, 7)


def test_one_hot_pair(spark, monkeypatch):
    monkeypatch.setattr(C, "SPREAD", 4)
    data = [(f"hot pair w{i} hot pair w{i % 7}", "en") for i in range(300)]
    docs = spark.createDataFrame(data, "text string, lang string").repartition(6)
    assert sorted(rows(C.collocations(docs))) == plain(data)


def test_chunks_of_any_size(spark, monkeypatch):
    data = data_of(5)
    batch = pa.RecordBatch.from_pydict({"lang": [l or "und" for _, l in data], "text": [t for t, _ in data]})

    def total():
        out = Counter()
        for b in C._combiner([], [])(iter([batch])):
            for r in b.to_pylist():
                counts, fans = np.frombuffer(r["counts"], "<i4"), np.frombuffer(r["fans"], "<i4")
                seconds = np.repeat(r["seconds"].split(" "), fans)
                assert r["n"] == counts.sum()
                for w2, w3, n in zip(seconds, r["thirds"].split(" "), counts):
                    out[r["lang"], r["w1"], w2, w3] += int(n)
        return out

    whole = total()
    monkeypatch.setattr(C, "CHUNK", 50)
    monkeypatch.setattr(C, "SLICE", 3)
    assert total() == whole and sum(whole.values()) == sum(counted(data)[1].values())


def test_quicksort_partitions_are_counts():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 50, 3000):
        segments = rng.integers(1, 40, max(1, n // 15)) if n else np.empty(0, dtype=np.int64)
        pointers = rng.permutation(int(segments.sum()))
        word, weight = rng.integers(0, 25, len(pointers)), rng.integers(1, 4, len(pointers))
        own = dict(zip(pointers.tolist(), np.repeat(np.arange(len(segments)), segments).tolist()))
        want = Counter()
        for i in pointers.tolist():
            want[own[i], int(word[i])] += int(weight[i])
        for least in (1, 5):
            got, sizes, weights = C.equal_partitions(word, weight, np.full(len(pointers), least), pointers, segments)
            at, seen = 0, {}
            for size, f in zip(sizes.tolist(), weights.tolist()):
                group = got[at:at + size].tolist()
                at += size
                assert len({(own[i], int(word[i])) for i in group}) == 1 and sum(int(weight[i]) for i in group) == f
                key = own[group[0]], int(word[group[0]])
                assert key not in seen
                seen[key] = f
            assert at == len(got) and seen == {k: f for k, f in want.items() if f >= least}


def test_counts_beyond_64_bits(spark, monkeypatch):
    big = 3_000_000_000
    found = spark.createDataFrame([("en", "a", None, None, 2 * big), ("en", "b", None, None, big + 1), ("en", "a", "b", None, big)],
                                  "lang string, w1 string, w2 string, w3 string, f long")
    monkeypatch.setattr(C, "phrase_counts", lambda *_: (found, spark.createDataFrame([("en", 10 * big)], "lang string, n long")))
    got = rows(C.collocations(spark.createDataFrame([], "text string, lang string")))
    assert got == [("en", 1, "a b", big, 2 * big, big + 1, 10 * big, 1_000_000 * big * big // (2 * big * (big + 1)))]


def test_oracle_on_the_driver_table(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert sorted(rows(C.collocations(docs))) == sorted(con.sql(C.oracle_sql()).fetchall())


def test_awkward_rows(spark, documents):
    data = [*AWKWARD, (9, "x. " * 30, "en", "s"), (9, "...,,,;;", "en", "s"), (10, "und so weiter " * 12, None, "s"), (11, "Ünd x " * 15, "", "s")]
    assert sorted(rows(C.collocations(documents(data)))) == plain([(t, l) for _, t, l, _ in data])
    assert rows(C.collocations(documents([]))) == []
    counts, totals = C.phrase_counts(documents([]), Scratch(spark, "test"))
    assert rows(counts) == rows(totals) == []
