"""Near duplicates against brute force over all pairs of full sets."""

import random
import re

import numpy as np
import pandas as pd
import pytest

from airshed.llm import hyperminhash as H
from airshed.llm.shingles import shingle_hashes
from llm_cases import AWKWARD, rows

SF = "/root/testdata/sf0.001"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    words = [w.translate({i: i + 32 for i in range(65, 91)}) for w in _WORD.findall(text or "")]
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(texts, percent=85):
    """(id, set size, component, kept) of (id, text) rows."""
    sets = [(i, shingle_set(t)) for i, t in texts]
    parent = {i: i for i, _ in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            (i, x), (j, y) = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(i), find(j)
                parent[max(p, q)] = min(p, q)
    return sorted((i, len(s), find(i), find(i) == i) for i, s in sets)


def near_copies(n, seed):
    """A base text and copies that drift apart, so that links form chains."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(160)]
    out = []
    for i in range(n):
        words = list(base)
        for _ in range(rng.randrange(0, 9)):
            words[rng.randrange(len(words))] = f"v{rng.randrange(9999)}"
        if rng.random() < 0.4:
            base = words
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("block", [64, 5])
def test_matches_brute_force(spark, documents, block):
    texts = near_copies(70, 1) + near_copies(50, 2) + ["a b c d e f g", "a b c d e f g h", "a b", "A  B", "a"] * 2
    data = [(i * 3 + 1, t) for i, t in enumerate(texts)]
    found = rows(H.near_duplicates(documents([(i, t, "en", "s") for i, t in data]), block=block))
    assert sorted(found) == brute(data)


def test_driver_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert sorted(rows(H.near_duplicates(docs))) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_awkward_rows(spark, documents):
    found = rows(H.near_duplicates(documents(AWKWARD)))
    assert len(found) == len(AWKWARD)
    by = {r[0]: r for r in found}
    assert by[1] == (1, 0, 1, True) and by[2] == (2, 0, 2, True) and by[3] == (3, 0, 3, True)
    assert by[4][2:] == (-5, False) and by[-5][2:] == (-5, True)
    assert by[None][2:] == (None, False)
    assert by[7][2:] == (6, False) and by[6][1] == 39_996
    assert by[2**62 + 1] == (2**62 + 1, 1, 2**62 + 1, True)


def test_empty(spark, documents):
    assert rows(H.near_duplicates(documents([]))) == []


def test_estimate_follows_similarity():
    rng = np.random.default_rng(0)
    pool = np.unique(rng.integers(0, 2**64, 3000, dtype=np.uint64))
    for share in (0.0, 0.5, 0.9):
        same = int(1000 * 2 * share / (1 + share))
        a, b = np.sort(pool[:1000]), np.sort(np.concatenate([pool[:same], pool[1000:2000 - same]]))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        guess = float(H.estimate(H.registers(a), H.registers(b), len(a), len(b)))
        assert abs(guess - true) < 0.12


def test_shingles_ignore_ascii_case_and_white_space_only():
    assert (shingle_hashes("A b\tC\nd\x0be f") == shingle_hashes("a B c D E F")).all()
    assert not np.array_equal(shingle_hashes("É b c d e"), shingle_hashes("é b c d e"))
    assert len(shingle_hashes("a b")) == 1 and len(shingle_hashes("x " * 50)) == 1


def test_blocks_send_sets_only_of_documents_that_pass_the_estimate():
    rng = np.random.default_rng(6)
    base = np.unique(rng.integers(0, 2**63, 400, dtype=np.uint64))

    def spoilt(share):
        own = base.copy()
        own[rng.random(len(base)) < share] = rng.integers(0, 2**63, dtype=np.uint64)
        return np.unique(np.concatenate([own, rng.integers(0, 2**63, int(share * 400), dtype=np.uint64)]))

    sets = [spoilt(s) for s in [0.0, 0.02] + [0.45] * 30]          # two alike, thirty that share a template at most
    pdf = pd.DataFrame({"cluster": 1, "i": 0, "j": 0, "side": 0, "id": range(len(sets)), "component": range(len(sets)),
                        "regs": [H.registers(s).tobytes() for s in sets], "size": [len(s) for s in sets],
                        "shingles": [s.tobytes() for s in sets]})
    wanted = H._block_candidates(H.THRESHOLD)(pdf.drop(columns="shingles"))
    assert {0, 1} <= set(wanted["id"]) and len(wanted) < 8
    links = H._block_links(H.THRESHOLD)(wanted.merge(pdf[["id", "regs", "shingles"]], on="id"))
    assert links.to_numpy().tolist() == [[0, 1]] == H._block_links(H.THRESHOLD)(pdf).to_numpy().tolist()
