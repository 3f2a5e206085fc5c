"""Quality votes: a plain vote over all neighbours, held-out quality, no leaks."""

import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from airshed.llm import quality_neighbours as Q
from llm_cases import AWKWARD, rows

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def scored(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = Q.fit(docs, labels)
    return docs, labels, model, Q.score(docs, model).join(labels, "doc_id", "left").collect()


def plain_vote(model, text):
    """The vote of one text, neighbour by neighbour."""
    v = np.zeros(model.directions.shape[1])
    for i, w in zip(*Q.terms(text)):
        v += w * model.rarity[i] * model.directions[i]
    v /= max(np.sqrt((v * v).sum()), 1e-12)
    close = sorted(((round(float(sum(a * b for a, b in zip(v, u))), 9), int(y)) for u, y in zip(model.vectors, model.labels)),
                   reverse=True)
    last = close[min(Q.NEIGHBOURS, len(close)) - 1][0]
    votes = [0.0, 0.0]
    for c, y in close:
        if c >= last:
            votes[y] += max(c, 0) ** Q.SHARPNESS * model.weight[y]
    return votes[1] / sum(votes) if sum(votes) else model.prior


def test_votes_match_a_plain_search(scored):
    docs, _, model, out = scored
    texts = {r.doc_id: r.text for r in docs.where("doc_id < 40").collect()}
    want = {i: plain_vote(model, t) for i, t in texts.items()}
    got = dict(zip(texts, model.votes(list(texts.values()))))
    assert got == pytest.approx(want, abs=1e-6)
    for r in out:
        if r.doc_id in want:
            v = want[r.doc_id]
            stretched = Q.CUT * v / model.at if v < model.at else Q.CUT + (1 - Q.CUT) * (v - model.at) / (1 - model.at)
            assert r.score == pytest.approx(stretched, abs=1e-6)


def test_blocks_do_not_matter(scored):
    texts = [r.text for r in scored[0].limit(300).collect()]
    model = scored[2]
    one = np.concatenate([model.votes([t]) for t in texts[:50]])
    assert np.allclose(model.votes(texts)[:50], one, atol=1e-9)


def test_held_out_quality(scored):
    out = scored[3]
    assert len(out) == scored[0].count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    held = [r for r in out if r.held_out and r.quality is not None]
    good, bad = ([r.predicted for r in held if r.quality == y] for y in (1, 0))
    assert sum(good) / len(good) > 0.93 and sum(bad) / len(bad) < 0.12
    score = pd.Series([r.score for r in held]).rank().to_numpy()
    y = np.array([r.quality for r in held])
    assert (score[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum())) > 0.95


def test_neither_test_labels_nor_other_columns_are_read(spark, scored):
    docs, labels, _, out = scored
    twisted = labels.withColumn("quality", F.when(Q.fold(F.col("doc_id"), 4) == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumns({"source": F.lit("x"), "n_chars": F.lit(1), "lang": F.lit("zz"), "quality": F.lit(1)})
    again = {r.doc_id: r.score for r in Q.score(other, Q.fit(other, twisted)).collect()}
    assert again == pytest.approx({r.doc_id: r.score for r in out}, abs=1e-9)


def test_the_cut_comes_from_every_row_outside_the_sample(spark, scored):
    docs, labels = scored[:2]
    known = labels.where(Q.fold(F.col("doc_id"), 4) != 2).count()
    model = Q.fit(docs, labels, sample=50)
    assert 50 <= len(model.vectors) <= 160 and known > 2_000 and 0 < model.at < 1


def test_awkward_and_degenerate(spark, documents):
    docs = documents(AWKWARD)
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 1), (6, 1, None), (7, 0, 0), (2, 0, 1), (-5, 1, 1), (None, 1, 1), (8, None, 0)],
                                   "doc_id long, quality int, toxic int")
    out = Q.score(docs, Q.fit(docs, labels)).collect()
    assert len(out) == len(AWKWARD) and all(0 <= r.score <= 1 and r.held_out is not None for r in out)
    same = [r.score for r in out if r.doc_id == 4]
    assert same[0] == same[1]
    none = labels.where("false")
    assert {round(r.score, 6) for r in Q.score(docs, Q.fit(docs, none)).collect()} == {0.7}
    one = spark.createDataFrame([(6, 0, 0)], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in Q.score(docs, Q.fit(docs, one)).collect()} == {0}
    assert rows(Q.score(documents([]), Q.fit(documents([]), none))) == []
