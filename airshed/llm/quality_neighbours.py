"""Quality by the votes of the nearest labelled documents.

A text is a vector of hashed terms: its lower-cased words, the shapes of
its words ("Aa.", "AA!!") and the size of the text, each family with a share
of the whole (square roots of relative frequencies, weighted by rarity). The
leading singular directions of a bounded sample of labelled rows make the
latent space; the sample's unit vectors there are broadcast, a table of at
most ``2 * SAMPLE`` rows of ``DIM`` numbers whatever the size of the corpus.

Every document is projected, its cosines with all labelled vectors are
computed exactly, block by block, and its ``NEIGHBOURS`` nearest (with all
that tie with the last) vote with the power ``SHARPNESS`` of their similarity, a label's votes
weighted by the labelled rows that one of the sample stands for.

The vote at which label 1 is predicted is chosen on all labelled rows of
the training folds that are not in the sample, by counts of (vote bin,
label); the score is the vote stretched so that this place is ``CUT``.
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
from airshed.llm.shingles import letter_word_hashes, run_hashes

SAMPLE = 2_000                 # labelled rows of each label the space is fitted on, about
WORD_BITS, SHAPE_BITS, SIZES = 12, 11, 24
SHARES = (0.45, 0.5, 0.05)     # of words, shapes and size in a vector
DIM, SPARE, POWERS = 24, 16, 3
NEIGHBOURS, SHARPNESS = 15, 4
BLOCK = 256                    # documents whose cosines are computed together
CUT = 0.7                      # scores from here on are predictions of 1
BINS = 400                     # bins of the vote in calibration
FOLDS, TEST_FOLD = 4, 2
TERMS = (1 << WORD_BITS) + (1 << SHAPE_BITS) + SIZES

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[65:91], _CLASS[48:58] = 65, 48
_CLASS[97:123] = _CLASS[128:] = 97
_BLANK = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])


def shape_hashes(raw: np.ndarray) -> np.ndarray:
    """One hash per run of non-blank bytes, read as classes of bytes (upper,
    lower, digit, or the byte itself) with repetitions taken together."""
    kind = np.where(_BLANK[raw], 32, _CLASS[raw]).astype(np.uint8)
    kind = kind[np.concatenate([[True], kind[1:] != kind[:-1]])] if len(kind) else kind
    return run_hashes(kind, kind != 32)


def terms(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct terms of a text and their weights, whose squares add up to
    the families' shares."""
    text = text or ""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    words = (letter_word_hashes(text) >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    shapes = (shape_hashes(raw) >> np.uint64(64 - SHAPE_BITS)).astype(np.int64)
    ids, weights, base = [], [], 0
    for found, size, share in ((words, 1 << WORD_BITS, SHARES[0]), (shapes, 1 << SHAPE_BITS, SHARES[1])):
        counts = np.bincount(found, minlength=size)
        used = np.flatnonzero(counts)
        ids.append(used + base)
        weights.append(np.sqrt(counts[used] * (share / max(1, len(found)))))
        base += size
    ids.append(np.array([base + min(SIZES - 1, len(raw).bit_length())]))
    weights.append(np.sqrt([SHARES[2]]))
    return np.concatenate(ids), np.concatenate(weights)


class Neighbours:
    """Rarity of the terms, directions of the space, labelled unit vectors."""

    def __init__(self, rarity: np.ndarray, directions: np.ndarray, vectors: np.ndarray, labels: np.ndarray,
                 weight: tuple[float, float], prior: float):
        self.rarity, self.directions, self.vectors, self.labels = rarity, directions, vectors, labels
        self.weight, self.prior, self.at = weight, prior, 0.5

    def project(self, texts) -> np.ndarray:
        out = np.zeros((len(texts), self.directions.shape[1]))
        for i, text in enumerate(texts):
            ids, w = terms(text)
            out[i] = (w * self.rarity[ids]) @ self.directions[ids]
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)

    def votes(self, texts) -> np.ndarray:
        """The weighted share of label 1 among the neighbours of each text."""
        out = np.full(len(texts), self.prior)
        k = min(NEIGHBOURS, len(self.vectors))
        if k == 0:
            return out
        of = np.array(self.weight)[self.labels]
        for at in range(0, len(texts), BLOCK):
            close = np.round(self.project(texts[at:at + BLOCK]) @ self.vectors.T, 9)
            last = np.partition(close, len(self.vectors) - k, axis=1)[:, -k, None]
            text, near = np.nonzero(close >= last)
            vote = np.maximum(close[text, near], 0) ** SHARPNESS * of[near]
            whole = np.bincount(text, vote, len(close))
            good = np.bincount(text, vote * self.labels[near], len(close))
            out[at:at + BLOCK] = np.where(whole > 0, good / np.maximum(whole, 1e-300), self.prior)
        return out

    def scores(self, texts) -> np.ndarray:
        v = self.votes(texts)
        return np.clip(np.where(v < self.at, CUT * v / self.at, CUT + (1 - CUT) * (v - self.at) / (1 - self.at)), 0, 1)


def train(rows: list[tuple[str | None, int]], totals: tuple[int, int]) -> Neighbours:
    """``rows``: text and label; ``totals``: labelled rows of either label
    that the rows stand for. No rows: every vote is a half."""
    labels = np.array([y for _, y in rows], dtype=np.int64)
    prior = totals[1] / max(1, sum(totals)) if sum(totals) else 0.5
    found = [terms(t) for t, _ in rows]
    seen = np.zeros(TERMS)
    for ids, _ in found:
        seen[ids] += 1
    rarity = np.sqrt(np.log((1 + len(rows)) / (1 + seen)) + 0.1)
    x = np.zeros((len(rows), TERMS), dtype=np.float32)
    for i, (ids, w) in enumerate(found):
        x[i, ids] = w * rarity[ids]
    # leading right singular vectors by repeated multiplication of random ones
    dim = min(DIM, max(1, len(rows)))
    basis = np.random.default_rng(11).normal(size=(TERMS, dim + SPARE)).astype(np.float32)
    for _ in range(POWERS):
        basis = np.linalg.qr(x.T @ (x @ basis))[0]
    turn = np.linalg.svd(x @ basis, full_matrices=False)[2] if len(rows) else np.eye(basis.shape[1])
    directions = (basis @ turn.T)[:, :dim].astype(np.float64)
    vectors = x.astype(np.float64) @ directions if len(rows) else np.zeros((0, dim))
    vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    weight = tuple(totals[y] / max(1, int((labels == y).sum())) for y in (0, 1))
    return Neighbours(rarity, directions, vectors, labels, weight, prior)


def calibrate(model: Neighbours, counts: pd.DataFrame) -> None:
    """Sets the vote that separates best: the largest sum of the shares of
    either label on its own side, the middle of the widest such gap.
    ``counts``: rows ``n`` by vote ``bin`` and label ``quality``."""
    n = np.zeros((2, BINS + 1))
    np.add.at(n, (counts["quality"].to_numpy(dtype=np.int64), counts["bin"].to_numpy(dtype=np.int64)), counts["n"].to_numpy())
    if (n.sum(axis=1) == 0).any():
        return
    below = np.cumsum(n, axis=1) / n.sum(axis=1, keepdims=True)
    gain = below[0, :-1] - below[1, :-1]           # the cut lies above bin b
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    stretch = max(np.split(best, np.flatnonzero(np.diff(best) > 1) + 1), key=len)
    model.at = float(np.clip((stretch[0] + stretch[-1] + 2) / 2 / (BINS + 1), 1e-3, 1 - 1e-3))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Neighbours:
    """Fit on about ``sample`` labelled rows of each label, chosen by a hash
    of their ids; the cut from all other labelled rows (from the same ones, if no others
    are there). Only rows outside the test fold are read. Rows of ``labels``
    without an id or a label, or that contradict each other, are left out."""
    outside = fold(F.col("doc_id"), FOLDS) != TEST_FOLD
    known = (
        labels.where("doc_id is not null and quality in (0, 1)").where(outside)
        .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other")).where("quality = other")
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    )
    totals = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    totals = (totals.get(0, 0), totals.get(1, 0))
    # an eighth stays out of the sample, so that small tables have rows to choose the cut by
    draws = [drawn("doc_id", share_of(max(totals[y] * 8, 1), min(sample * 8, totals[y] * 7)), y) for y in (0, 1)]
    chosen = ((F.col("quality") == 0) & draws[0]) | ((F.col("quality") == 1) & draws[1])
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .where("doc_id is not null")
    # the draw is tested on the texts too: those outside the sample are not moved
    found = sorted(
        texts.where(draws[0] | draws[1]).join(known.where(chosen), "doc_id").select("text", "quality").toArrow().to_pylist(),
        key=lambda r: (r["quality"], r["text"] or ""))
    model = train([(r["text"], r["quality"]) for r in found], totals)
    if not len(model.vectors):
        return model

    def bins(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "bin": np.floor(model.votes(list(pdf["text"])) * BINS).astype("int32")})

    # texts are scored where they lie; only ids and bins are moved
    binned = texts.where(outside).mapInPandas(bins, "doc_id long, bin int").join(known, "doc_id")
    counts = binned.groupBy("bin", "quality", chosen.alias("chosen")).agg(F.count(F.lit(1)).alias("n")).toArrow().to_pandas()
    held = counts[~counts["chosen"]]
    calibrate(model, held if held["quality"].nunique() == 2 else counts)
    return model


def score(docs: DataFrame, model: Neighbours) -> DataFrame:
    """doc_id, held_out, score, predicted for each row.

    Null, empty and blank texts are scored as texts without words. A null id
    is not held out. Texts of any length are read whole. Repeated rows are
    scored alike. Empty table: empty result. Without labelled rows every
    score is that of a half vote. Other columns are not read.
    """
    def work(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"score": model.scores(list(texts))})

    out = by_text(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), work, "score double", "_votes")
    return out.select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), FOLDS) == TEST_FOLD, F.lit(False)).alias("held_out"),
        F.col("_votes.score").alias("score")).withColumn("predicted", (F.col("score") >= CUT).cast("int"))
