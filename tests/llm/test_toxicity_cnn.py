"""Toxicity: gradients, held-out quality, no leak of labels or other columns."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from airshed.llm import toxicity_cnn as T
from llm_cases import AWKWARD, rows

SF = "/root/testdata/sf0.1"


def test_step_follows_the_numerical_gradient():
    model = T.Classifier()
    ids = np.array([5, 9, 5, 77, 1000, 3], dtype=np.int32)

    def loss(m):
        z = m.forward(ids)[0]
        return np.log1p(np.exp(-z))          # label 1

    import copy
    rate, h = 1e-3, 1e-3
    after = copy.deepcopy(model)
    after.step(ids, 1, rate)
    for name, at in (("dense", (2,)), ("table", (5, 1))):
        up, down = copy.deepcopy(model), copy.deepcopy(model)
        getattr(up, name)[at] += h
        getattr(down, name)[at] -= h
        slope = (loss(up) - loss(down)) / (2 * h)
        moved = (getattr(after, name)[at] - getattr(model, name)[at]) / rate
        assert moved == pytest.approx(-slope, abs=2e-2)
    assert loss(after) < loss(model)


@pytest.fixture(scope="module")
def scored(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    return docs, labels, T.score(docs, T.fit(docs, labels)).join(labels, "doc_id", "left").collect()


def test_held_out_quality(scored):
    out = scored[2]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    held = [r for r in out if r.held_out and r.toxic is not None]
    hit = sum(r.predicted and r.toxic for r in held)
    assert hit / sum(r.predicted for r in held) > 0.85 and hit / sum(r.toxic for r in held) > 0.7


def test_neither_test_labels_nor_other_columns_are_read(spark, scored):
    docs, labels, out = scored
    twisted = labels.withColumn("toxic", F.when(T.fold(F.col("doc_id"), 3) == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = docs.withColumns({"source": F.lit("x"), "n_chars": F.lit(1)})
    model = T.fit(docs, twisted)
    again = {r.doc_id: r.score for r in T.score(other.withColumn("lang", F.lit("zz")), model).collect()}
    assert again == {r.doc_id: r.score for r in out}


def test_thresholds_come_from_every_row_outside_the_fit(spark, scored):
    # a quarter of 80 rows of a label holds no language's LEAST positives, the rows outside the sample do
    model = T.fit(scored[0], scored[1], sample=80)
    at = dict(zip(model.languages, model.thresholds))
    assert len({at["en"], at["de"], at["fr"]}) == 3


def test_awkward_and_degenerate(spark, documents):
    docs = documents(AWKWARD)
    labels = spark.createDataFrame([(4, 1, 0), (4, 1, 1), (6, None, 1), (7, 0, None), (2, 1, 0), (-5, 1, 1), (None, 1, 1), (6, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    out = T.score(docs, T.fit(docs, labels)).collect()
    assert len(out) == len(AWKWARD) and all(0 <= r.score <= 1 for r in out)
    none = labels.where("false")
    assert {r.predicted for r in T.score(docs, T.fit(docs, none)).collect()} == {0}
    assert rows(T.score(documents([]), T.fit(documents([]), none))) == []


def plain_logit(model, text):
    """Filters, pooling and dense layer by loops over places and dimensions."""
    words = re.findall(r"[a-z\x80-\U0010ffff]+", (text or "").lower())
    ids = [int(T.word_ids(w)[0]) for w in words]
    rows = [[float(v) for v in model.table[i]] for i in ids]
    rows += [[0.0] * T.DIM] * (max(T.WIDTHS) - len(rows))
    z = float(model.offset)
    for n, w in enumerate(T.WIDTHS):
        for f in range(T.FILTERS):
            best = max(sum(rows[at + k][d] * float(model.filters[w][k, d, f]) for k in range(w) for d in range(T.DIM))
                       for at in range(len(rows) - w + 1))
            z += max(best + float(model.bias[w][f]), 0.0) * float(model.dense[n * T.FILTERS + f])
    return z


def test_scores_match_plain_loops(spark, scored):
    docs, labels, out = scored
    model = T.fit(docs, labels)
    got = {r.doc_id: r for r in out}
    for r in docs.where("doc_id < 60").collect():
        words = Counter(re.findall(r"[a-z\x80-\U0010ffff]+", r.text.lower()))
        told = [sum(n * float(model.words[T.word_ids(w)[0], g]) for w, n in words.items()) for g in range(len(model.languages))]
        at = model.thresholds[max(range(len(told)), key=told.__getitem__)]
        want = 1 / (1 + math.exp(-(T.SLOPE * (plain_logit(model, r.text) - at) + math.log(T.CUT / (1 - T.CUT)))))
        assert got[r.doc_id].score == pytest.approx(want, abs=2e-3)


def test_thresholds_match_a_search_over_all_cuts():
    rng = np.random.default_rng(8)
    for _ in range(30):
        n = int(rng.integers(2, 60))
        z, y = rng.integers(-9, 9, n).astype(float), rng.integers(0, 2, n)
        y[0] = 1
        weight = rng.integers(1, 4, n).astype(float)

        def f1(cut):
            taken = z > cut
            return 2 * weight[taken & (y == 1)].sum() / (weight[taken].sum() + weight[y == 1].sum())

        assert f1(T._best_threshold(z, y, weight)) == pytest.approx(max(f1(c - 0.5) for c in z), abs=1e-9)
