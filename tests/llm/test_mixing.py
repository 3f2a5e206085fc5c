"""Raking: marginals met, calibrated rates, deterministic draws."""

import numpy as np
import pandas as pd
import pytest

from airshed.llm import mixing as X
from llm_cases import AWKWARD, rows

SF = "/root/testdata/sf0.01"
TARGETS = {"source": {"a": 0.5, "b": 0.3, "c": 0.2}, "lang": {"en": 0.7, "de": 0.3}}


def cells(seed=0):
    rng = np.random.default_rng(seed)
    return pd.DataFrame([(s, l, float(rng.integers(1, 1000))) for s in ("a", "b", "c") for l in ("en", "de")],
                        columns=["source", "lang", "tokens"])


def test_marginals_are_the_targets():
    c = cells()
    c["w"] = X.rake(c, TARGETS, rounds=200)
    total = c["tokens"].sum()
    for dim, wanted in TARGETS.items():
        got = c.groupby(dim)["w"].sum() / total
        assert all(got[v] == pytest.approx(w, abs=1e-6) for v, w in wanted.items())
    # raking keeps the odds ratios of the cells it starts from
    odds = lambda x: x[0] * x[3] / (x[1] * x[2])
    assert odds(c["w"].to_numpy()[:4]) == pytest.approx(odds(c["tokens"].to_numpy()[:4]))


def test_values_without_target_keep_their_share():
    c = pd.concat([cells(), pd.DataFrame([("(other)", "en", 500.0)], columns=["source", "lang", "tokens"])], ignore_index=True)
    c["w"] = X.rake(c, {"source": TARGETS["source"]}, rounds=50)
    assert c[c.source == "(other)"]["w"].sum() == pytest.approx(500)
    assert c[c.source == "a"]["w"].sum() == pytest.approx(0.5 * (c["tokens"].sum() - 500))


def test_calibrated_rate_without_probabilities_above_one():
    tokens = np.array([100.0, 50.0, 10.0, 0.0])
    p = X.calibrate(tokens, np.array([40.0, 60.0, 60.0, 0.0]), 0.5)
    assert p.max() <= 1 and (tokens * p).sum() == pytest.approx(80, abs=1e-3) and p[2] == 1
    assert (X.calibrate(tokens, tokens, 1.0)[:3] == 1).all()


def test_targets_are_kept_under_skew():
    names = [f"s{i}" for i in range(20)]
    targets = {"source": {n: 0.05 for n in names}}
    c = pd.DataFrame({"source": names, "tokens": [950.0] + [100.0] * 19})
    wanted = X.rake(c, targets)
    c["probability"] = X.calibrate(c["tokens"], wanted, keep_targets=True)
    assert c["probability"].max() == pytest.approx(1)
    assert np.allclose(X.marginals(c, targets)["achieved"], 0.05)
    c["probability"] = X.calibrate(c["tokens"], wanted)                # the fixed rate gives up the targets
    assert X.marginals(c, targets)["achieved"][0] == pytest.approx(380 / 2280, abs=1e-4)


def test_the_rate_falls_only_as_far_as_the_targets_need():
    targets = {"source": {"a": 0.5, "b": 0.5}, "lang": {"en": 0.5, "de": 0.5}}
    c = pd.DataFrame([("a", "en", 900.0), ("a", "de", 100.0), ("b", "en", 100.0), ("b", "de", 300.0)],
                     columns=["source", "lang", "tokens"])
    p, rate, missed = X.mix_plan(c, targets)
    got = c["tokens"] * p
    # b has 400 of 1400 tokens, so at most 800 can be drawn: the rate tried below is 0.56
    assert rate == pytest.approx(0.56) and missed <= X.WITHIN and p.max() <= 1 and got.sum() == pytest.approx(0.56 * 1400, rel=1e-3)
    # a sparse cell does not scale the sample down: its neighbours make up for it
    sparse = pd.concat([c, pd.DataFrame([("a", "fr", 1.0)], columns=c.columns)], ignore_index=True)
    assert X.mix_plan(sparse, targets)[1] == pytest.approx(0.56)


def test_contradicting_targets_are_told():
    c = pd.DataFrame([("a", "en", 500.0), ("b", "de", 500.0)], columns=["source", "lang", "tokens"])
    p, rate, missed = X.mix_plan(c, {"source": {"a": 0.9, "b": 0.1}, "lang": {"en": 0.1, "de": 0.9}})
    assert missed > X.WITHIN and 0 <= p.min() and p.max() <= 1


def test_sample_moves_the_table_to_its_targets(spark):
    docs = X.with_topic(spark.read.parquet(f"{SF}/documents.parquet"))
    out = X.mix(docs).toPandas()
    drawn = out.n_tokens * out.probability
    assert out.probability.max() <= 1 and drawn.sum() <= X.RATE * out.n_tokens.sum()
    for dim, wanted in X.TARGETS.items():          # in expectation, the targets of every dimension
        for value, share in wanted.items():
            assert drawn[out[dim] == value].sum() / drawn.sum() == pytest.approx(share, abs=X.WITHIN)
    kept = out[out.kept]
    for lang, share in X.TARGETS["lang"].items():
        assert abs(kept[kept.lang == lang].n_tokens.sum() / kept.n_tokens.sum() - share) < 0.1
    again = {r.doc_id: r.kept for r in X.mix(docs.repartition(5)).collect()}
    assert again == dict(zip(out.doc_id, out.kept))


def test_awkward_and_empty(spark, documents):
    out = X.mix(X.with_topic(documents(AWKWARD))).collect()
    assert len(out) == len(AWKWARD) and all(r.probability is not None and r.kept is not None for r in out)
    assert [r.kept for r in out if r.doc_id is None] == [False]
    assert len({r.kept for r in out if r.doc_id == 4}) == 1
    assert rows(X.mix(X.with_topic(documents([])))) == []
