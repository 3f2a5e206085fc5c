"""Toxicity by a convolutional text classifier over hashed words.

A word is hashed into a table of embeddings; filters of several widths run
over the text, each keeps its largest response (max pooling), and a dense
layer makes one number of these. Trained in numpy by stochastic gradient
steps on a bounded sample of labelled rows; the embeddings' first dimension
starts from the words' smoothed log odds in that sample.

The text's language, told from its words by counts of the same sample,
chooses a threshold calibrated on every labelled row of the training folds
that the classifier was not fitted on, by counts of (language, score bin,
label); the score is the logistic function of the distance to that threshold, 0.7 lying on it.
Scoring reads the text only: no label, language, source or id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import by_text
from airshed.llm.language_mixture import fold
from airshed.llm.sampling import drawn, share_of
from airshed.llm.shingles import letter_word_hashes

SAMPLE = 4_000                 # rows of each label the classifier is fitted on, about
TABLE_BITS, DIM = 18, 8
WIDTHS, FILTERS = (1, 2, 3), 6
EPOCHS, RATE, PRIOR = 4, 0.05, 2.0
CUT = 0.7                      # scores from here on are predictions of 1
SLOPE = 2.0
BINS, REACH = 256, 100          # bins of a unit of the logit, and the largest logit told apart, in calibration
LEAST = 25                     # positive calibration rows a language needs for a threshold of its own
FOLDS, TEST_FOLD = 3, 1


def word_ids(text: str | None) -> np.ndarray:
    return (letter_word_hashes(text) >> np.uint64(64 - TABLE_BITS)).astype(np.int32)


class Classifier:
    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.table = rng.normal(0, 0.1, (1 << TABLE_BITS, DIM)).astype(np.float32)
        self.filters = {w: rng.normal(0, 0.2, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS}
        for w in WIDTHS:
            self.filters[w][0, 0, 0] = 1.0
        self.bias = {w: np.zeros(FILTERS, dtype=np.float32) for w in WIDTHS}
        self.dense = rng.normal(0, 0.1, len(WIDTHS) * FILTERS).astype(np.float32)
        self.dense[::FILTERS] = 0.5
        self.offset = 0.0
        self.languages: list[str] = []
        self.words = np.zeros((1 << TABLE_BITS, 1), dtype=np.float32)
        self.thresholds = np.zeros(1)

    def forward(self, ids: np.ndarray) -> tuple[float, np.ndarray, list[np.ndarray]]:
        """Logit, pooled responses, and the places they come from."""
        pad = max(WIDTHS) - len(ids)
        x = self.table[ids]
        if pad > 0:
            x = np.concatenate([x, np.zeros((pad, DIM), dtype=np.float32)])
        pooled, places = [], []
        for w in WIDTHS:
            f = self.filters[w]
            r = x[:len(x) - w + 1] @ f[0]
            for k in range(1, w):
                r += x[k:len(x) - w + 1 + k] @ f[k]
            at = r.argmax(axis=0)
            places.append(at)
            pooled.append(r[at, np.arange(FILTERS)] + self.bias[w])
        top = np.maximum(np.concatenate(pooled), 0)
        return float(top @ self.dense + self.offset), top, places

    def step(self, ids: np.ndarray, label: int, rate: float) -> None:
        z, top, places = self.forward(ids)
        gap = rate * (label - 1 / (1 + np.exp(-np.clip(z, -30, 30))))
        back = np.where(top > 0, gap * self.dense, 0).astype(np.float32)
        self.dense += (gap * top).astype(np.float32)
        self.offset += gap
        for n, w in enumerate(WIDTHS):
            g = back[n * FILTERS:(n + 1) * FILTERS]
            self.bias[w] += g
            for k in range(w):
                at = places[n] + k
                known = at < len(ids)
                rows = ids[at[known]]
                old = self.table[rows]
                np.add.at(self.table, rows, g[known, None] * self.filters[w][k][:, known].T)
                self.filters[w][k][:, known] += old.T * g[known]

    def language(self, ids: np.ndarray) -> int:
        return int(self.words[ids].sum(axis=0).argmax()) if len(ids) else 0

    def score(self, text: str | None) -> float:
        ids = word_ids(text)
        z = self.forward(ids)[0]
        at = self.thresholds[self.language(ids)]
        return float(1 / (1 + np.exp(-np.clip(SLOPE * (z - at) + np.log(CUT / (1 - CUT)), -500, 500))))


def _best_threshold(z: np.ndarray, label: np.ndarray, weight: np.ndarray) -> float:
    """The middle of the widest best gap: the largest F1 of the weighted rows."""
    order = np.argsort(-z, kind="stable")
    z, label, weight = z[order], label[order], weight[order]
    hit, taken = np.cumsum(weight * label), np.cumsum(weight)
    f1 = 2 * hit / (taken + (weight * label).sum())
    f1[:-1][z[:-1] == z[1:]] = -1
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    below = np.append(z[1:], z[-1] - 2.0)
    at = best[np.argmax((z - below)[best])]
    return float((z[at] + below[at]) / 2)


def train(rows: list[tuple[np.ndarray, int, str | None]]) -> Classifier:
    """``rows``: word ids, label, language (or None). The thresholds are left to ``calibrate``."""
    model = Classifier()
    if not rows or len({y for _, y, _ in rows}) < 2:
        # one label only: its share is all there is to learn
        model.dense[:] = 0
        model.thresholds[:] = -10.0 if rows and rows[0][1] else 10.0
        return model
    rng = np.random.default_rng(5)
    count = np.zeros((2, 1 << TABLE_BITS), dtype=np.float64)
    total = np.zeros(2)
    for ids, y, _ in rows:
        count[y, np.unique(ids)] += 1
        total[y] += 1
    odds = np.log((count[1] + PRIOR) / (total[1] + 2 * PRIOR)) - np.log((count[0] + PRIOR) / (total[0] + 2 * PRIOR))
    # words that are about as frequent under either label say nothing
    model.table[:, 0] = np.where(count.sum(axis=0) > 0, odds, 0.0)
    model.languages = sorted({l for _, _, l in rows if l is not None})
    if model.languages:
        words = np.full((1 << TABLE_BITS, len(model.languages)), 0.1, dtype=np.float64)
        for ids, _, l in rows:
            if l is not None:
                np.add.at(words[:, model.languages.index(l)], ids, 1.0)
        words = np.log(words / words.sum(axis=0))
        model.words = (words - words.mean(axis=1, keepdims=True)).astype(np.float32)
    for epoch in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            model.step(rows[i][0], rows[i][1], RATE / (1 + epoch))
    model.thresholds = np.zeros(max(1, len(model.languages)))
    return model


def calibrate(model: Classifier, counts: pd.DataFrame, weights: tuple[float, float] = (1.0, 1.0)) -> None:
    """Sets the thresholds. ``counts``: rows ``n`` by language, score ``bin``
    and label ``toxic``; ``weights``: labelled rows that a counted row of
    label 0 and 1 stands for."""
    counts = counts.sort_values(["language", "bin", "toxic"], kind="stable")
    z = (counts["bin"].to_numpy() + 0.5) / BINS
    label, n, group = (counts[c].to_numpy() for c in ("toxic", "n", "language"))
    weight = n * np.where(label == 1, weights[1], weights[0])
    common = _best_threshold(z, label, weight) if label.any() else 0.0
    model.thresholds = np.array([
        _best_threshold(z[group == g], label[group == g], weight[group == g])
        if n[(group == g) & (label == 1)].sum() >= LEAST else common for g in range(max(1, len(model.languages)))])


def _to_ids(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"ids": [word_ids(t).astype("<i4").tobytes() for t in pdf["text"]],
                            "toxic": pdf["toxic"].astype("int32"), "lang": pdf["lang"]})


def _to_bins(model: Classifier):
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [(model.language(ids), model.forward(ids)[0]) for ids in map(word_ids, pdf["text"])]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "language": [g for g, _ in found],
                                "bin": [int(np.floor(np.clip(z, -REACH, REACH) * BINS)) for _, z in found]})

    return work


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Classifier:
    """Fit on three quarters of about ``sample`` labelled rows of each label,
    chosen by a hash of their ids; thresholds from all other labelled rows.
    Only rows outside the test fold are read. Rows of ``labels`` without an
    id or a label, or that contradict each other, are left out."""
    outside = fold(F.col("doc_id"), FOLDS) != TEST_FOLD
    known = (
        labels.where("doc_id is not null and toxic in (0, 1)").where(outside)
        .groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other")).where("toxic = other")
    )
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    # the same draw on both sides: texts outside the sample are not moved
    draws = [(F.col("toxic") == y, drawn("doc_id", share_of(counts.get(y, 0), sample), y)) for y in (0, 1)]
    learn = drawn("doc_id", share_of(4, 3), 2)
    chosen = known.where((draws[0][0] & draws[0][1]) | (draws[1][0] & draws[1][1])).select("doc_id", "toxic")
    texts = docs.select("doc_id", "text", "lang").where(draws[0][1] | draws[1][1])

    def rows(part):
        found = (
            texts.where(part).join(chosen.where(part), "doc_id").select("text", "toxic", "lang")
            .mapInPandas(_to_ids, "ids binary, toxic int, lang string").toArrow().to_pylist()
        )
        return sorted(((r["ids"], r["toxic"], r["lang"]) for r in found), key=lambda r: (r[0], r[1], r[2] or ""))

    found = rows(learn)
    if len({y for _, y, _ in found}) < 2 <= len(counts):
        # too few rows to hold any back
        learn = F.lit(True)
        found = rows(learn)
    model = train([(np.frombuffer(b, dtype="<i4"), y, l) for b, y, l in found])
    if len({y for _, y, _ in found}) < 2:
        return model
    # texts are scored where they lie; only ids, languages and bins are moved
    fitted = learn & ((draws[0][0] & draws[0][1]) | (draws[1][0] & draws[1][1]))
    binned = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .where("doc_id is not null").where(outside)
        .mapInPandas(_to_bins(model), "doc_id long, language int, bin int")
    )
    bins = (
        binned.join(known.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic"), "doc_id").where(~fitted)
        .groupBy("language", "bin", "toxic").agg(F.count(F.lit(1)).alias("n")).toArrow().to_pandas()
    )
    held = [int(bins.loc[bins["toxic"] == y, "n"].sum()) for y in (0, 1)]
    calibrate(model, bins, tuple(counts.get(y, 0) / max(1, held[y]) for y in (0, 1)))
    return model


def score(docs: DataFrame, model: Classifier) -> DataFrame:
    """doc_id, held_out, score, predicted for each row.

    Null and empty texts are scored as texts without words. A null id is not
    held out. Repeated rows are scored alike. Empty table: empty result.
    """
    def work(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"score": [model.score(t) for t in texts]})

    out = by_text(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), work, "score double", "_cnn")
    return out.select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), FOLDS) == TEST_FOLD, F.lit(False)).alias("held_out"),
        F.col("_cnn.score").alias("score")).withColumn("predicted", (F.col("score") >= CUT).cast("int"))
