"""Runs against a plain search for every period."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest

from airshed.llm import periodic_runs as R
from llm_cases import AWKWARD, rows

SF = "/root/testdata/sf0.001"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, least=24, times=3):
    """Maximal stretches of each period, the smallest period of each stretch."""
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, times * q):
                found.setdefault((i, j - i + q), q)
            i = j
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    """The contract's row, from the brute-force runs."""
    words = _WORD.findall(text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def periodic_words(rng):
    words = [rng.randrange(rng.choice([1, 2, 3, 40])) for _ in range(rng.randrange(140))]
    for _ in range(rng.randrange(4)):
        if len(words) > 5:
            a, p = rng.randrange(len(words)), rng.randrange(1, 20)
            for i in range(max(a, p), min(len(words), a + rng.randrange(90))):
                words[i] = words[i - p]
    return words


@pytest.mark.parametrize("least, times", [(24, 3), (6, 3), (5, 4)])
def test_runs_match_brute_force(least, times):
    rng = random.Random(least * times)
    for _ in range(400):
        words = periodic_words(rng)
        assert R.find_runs(words, least, times) == brute(words, least, times)


def test_long_and_degenerate_texts():
    assert R.find_runs([1] * 50_000) == [(0, 50_000, 1)]
    assert R.find_runs(list(range(5_000)) * 8) == [(0, 40_000, 5_000)]
    assert R.find_runs([0] + [1, 2] * 30 + [2]) == [(1, 60, 2)]
    # a passage that comes back after other words, thousands of times, is no run
    assert R.find_runs([w for i in range(4_000) for w in (1_000 + i, *range(20))]) == []
    assert R.find_runs([]) == R.find_runs([1] * 23) == []


def test_query_on_the_driver_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = R.digest(R.runs(docs, edit=R.planted))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = [plain_row(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(rows(out)) == sorted(want) and sum(r[1] > 0 for r in want) > 5


def test_awkward_rows(spark, documents):
    looped = " ".join(["la", "li", "lu"] * 40)
    data = [*AWKWARD, (20, looped, "en", "s"), (20, looped, "en", "s"), (None, looped, "en", "s"), (21, "x " * 100 + looped, "en", "s"),
            (22, looped.replace(" ", "\x85"), "en", "s")]
    got = rows(R.digest(R.runs(documents(data), edit=R.planted)))
    assert sorted(got, key=str) == sorted((plain_row(i, t) for i, t, _, _ in data), key=str)
    assert rows(R.digest(R.runs(documents([])))) == []


def test_real_outputs(spark, documents):
    found = R.runs(documents([(1, "start " + "a b " * 20 + "end", "en", "s")])).first()
    assert found.n_words == 42 and [tuple(r) for r in found.runs] == [(1, 40, 2)] and found.collapsed == "start a b end"
