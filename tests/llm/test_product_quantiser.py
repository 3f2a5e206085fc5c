"""Embedding duplicates against brute force in double precision."""

import numpy as np
import pytest

from airshed.llm import product_quantiser as V
from llm_cases import rows

SCHEMA = "vec_id long, embedding array<float>, label int, id string"


def brute(data, cosine=V.COSINE):
    def unit(v):
        if v is None or any(x is None or not np.isfinite(np.float32(x)) for x in v):
            return None
        x = np.array(v, dtype=np.float32).astype(np.float64)
        n = np.sqrt((x * x).sum())
        return x / n if n > 0 else None

    units = [(i, unit(v)) for i, v in data]
    parent = {i: i for i, _ in data}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(units)
    for a in range(len(units)):
        for b in range(a):
            (i, x), (j, y) = units[a], units[b]
            if i is not None and j is not None and x is not None and y is not None and len(x) == len(y) and x @ y >= cosine:
                links[a] += 1
                links[b] += 1
                p, q = find(i), find(j)
                parent[max(p, q)] = min(p, q)
    return sorted(((i, n, find(i), i == find(i)) for (i, _), n in zip(data, links)), key=str)


def planted(n, groups, seed, size=64):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, size))
    out = [row for row in base]
    for g in range(groups):
        for k in range(int(rng.integers(1, 12))):
            out.append(base[g] + rng.normal(size=size) * rng.uniform(0.0, 0.35))
    for k in range(80):                                  # one large group of near copies, some of them equal
        out.append(base[0] + rng.normal(size=size) * 0.15 * (k % 9 != 0))
    order = rng.permutation(len(out))
    return [(int(i) * 5 - 20, [float(np.float32(x)) for x in out[j]]) for i, j in enumerate(order)]


def test_every_link_is_probed_in_many_dimensions():
    x = np.zeros((400, 400))
    x[:, :3] = np.random.default_rng(4).normal(size=(400, 3))          # differences run along the centroids' axes
    own, _, _, near = V.Quantiser(x, 40).encode(x, V.COSINE)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    i, j = np.nonzero(unit @ unit.T >= V.COSINE)
    assert (near[i, own[j]] | near[j, own[i]]).all()


@pytest.mark.parametrize("block,lists", [(512, None), (16, 7), (16, 40)])
def test_matches_brute_force(spark, block, lists):
    data = planted(150, 40, 3)
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in data], SCHEMA)
    found = rows(V.near_duplicates(df, block=block, lists=lists))
    assert sorted(found, key=str) == brute(data)


def test_recall_when_fitted_on_a_small_sample(spark):
    data = planted(300, 60, 8)
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in data], SCHEMA)
    assert sorted(rows(V.near_duplicates(df, sample=60, lists=12)), key=str) == brute(data)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    data = [(1, None), (2, []), (3, [0.0, 0.0, 0.0]), (4, [nan, 1.0, 0.0]), (5, [inf, 0.0, 0.0]), (6, [None, 1.0, 0.0]),
            (7, [1.0, 0.0, 0.0]), (8, [2.0, 0.0, 0.0]), (9, [1.0, -0.0, 0.0]), (10, [1.0, 0.0]), (11, [-1.0, 0.0, 0.0]),
            (12, [1e-30, 0.0, 0.0]), (None, [1.0, 0.0, 0.0]), (13, [1.0, 0.33, 0.0]), (14, [1.0, 0.3, 0.0])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in data], SCHEMA)
    found = {r[0]: r[1:] for r in rows(V.near_duplicates(df))}
    for i in (1, 2, 3, 4, 5, 6, 10, 11):
        assert found[i] == (0, i, True)
    assert found[None] == (0, None, False)
    want = {r[0]: r[1:] for r in brute([d for d in data if d[0] is not None])}
    assert {k: v for k, v in found.items() if k is not None} == want


def test_repeated_rows_and_empty(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], 0, "x"), (1, [1.0, 2.0], 0, "x"), (3, [1.0, 2.0], 0, "x")], SCHEMA)
    assert sorted(rows(V.near_duplicates(df))) == [(1, 2, 1, True), (1, 2, 1, True), (3, 2, 1, False)]
    assert rows(V.near_duplicates(spark.createDataFrame([], SCHEMA))) == []


def test_table_distances_are_exact_on_codes():
    rng = np.random.default_rng(1)
    model = V.Quantiser(rng.normal(size=(200, 24)), 6)
    x = rng.normal(size=(30, 24))
    own, codes, error, near = model.encode(x, 0.95)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    for at in range(6):
        members = np.flatnonzero(own == at)
        if len(members):
            rebuilt = model.centres[at] + np.concatenate([b[codes[members, m]] for m, b in enumerate(model.books)], axis=1)
            want = np.linalg.norm(unit[:, None] - rebuilt, axis=2)
            assert np.allclose(model.distances(unit, at, codes[members]), want, atol=1e-3)
            assert np.allclose(np.linalg.norm(unit[members] - rebuilt, axis=1), error[members], atol=1e-6)
    assert near[np.arange(30), own].all()
