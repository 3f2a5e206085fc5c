"""Language identification by multilingual mixture inference.

A document is a mixture of languages. Expectation-maximisation estimates
its language proportions from the likelihoods of its letter trigrams under
each learned language; the set of languages is the one with the best
penalised likelihood (a language stays only if the log likelihood it adds
exceeds ``PENALTY * log(number of trigrams)``). The prediction is the
language of the largest proportion in that set.

Trigram counts come from every training row: each task counts its own
rows, the counts are summed by (language, bucket). The model that goes to
the tasks has ``BUCKETS`` numbers a language, whatever the size of the
corpus.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import by_text

BUCKETS = 1 << 15
SMOOTHING = 0.5                # added to every count of the background
BACKGROUND = 0.02              # weight of the trigrams of all languages in each of them
ROUNDS, ROUNDS_AGAIN = 10, 6   # EM steps over all languages, and after each removal
PENALTY = 3.0
CHUNK = 200_000                # distinct trigrams treated together in a task
UNKNOWN = "und"
FOLDS, TEST_FOLD = 5, 0

_tables: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    if "letters" not in _tables:
        _tables["letters"] = np.array([chr(i).isalpha() for i in range(1 << 16)])
    return _tables["letters"]


def trigrams(text: str | None) -> np.ndarray:
    """Bucket of each letter trigram; words are bounded by one separator.
    Empty if the text is null or has no letter."""
    if not text:
        return np.empty(0, dtype=np.int64)
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    alpha = _letters()[np.minimum(code, 0xFFFF)]
    far = np.flatnonzero(code > 0xFFFF)
    for i in far:
        alpha[i] = chr(code[i]).isalpha()
    code = np.where(alpha, code, 0)
    code = np.concatenate([[0], code, [0]]).astype(np.uint32)
    code = code[(code != 0) | (np.concatenate([[1], code[:-1]]) != 0)]
    middle = code[1:-1] != 0
    if not middle.any():
        return np.empty(0, dtype=np.int64)
    h = code[:-2] * np.uint32(0x9E3779B1) ^ code[1:-1] * np.uint32(0x85EBCA77) + np.uint32(0x165667B1) * code[2:]
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return (h >> np.uint32(32 - 15))[middle].astype(np.int64)


def fold(doc_id: Column, folds: int = FOLDS) -> Column:
    """crc32 of the id as text, modulo ``folds`` (null id: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(folds)


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(BUCKETS, dtype=np.int64))
    for pdf in batches:
        for lang, text in zip(pdf["lang"], pdf["text"]):
            found = trigrams(text)
            if len(found):
                total[lang] += np.bincount(found, minlength=BUCKETS)
    for lang, counts in total.items():
        used = np.flatnonzero(counts)
        yield pd.DataFrame({"lang": lang, "bucket": used, "n": counts[used]})


class Mixture:
    """Learned languages (sorted) and their trigram probabilities."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        # what a language has not shown is as likely as in all languages
        # together: little training text is no advantage
        whole = counts.sum(axis=0) + SMOOTHING
        own = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
        p = (1 - BACKGROUND) * own + BACKGROUND * whole / whole.sum()
        self.p = np.ascontiguousarray(p.T.astype(np.float32) * BUCKETS)

    def _em(self, p, weight, doc, starts, share, active, rounds):
        for _ in range(rounds):
            mixed = np.einsum("gl,gl->g", p, share[doc])
            taken = np.add.reduceat(p * (weight / np.maximum(mixed, 1e-30))[:, None], starts, axis=0)
            share = share * taken * active
            share = share / np.maximum(share.sum(axis=1, keepdims=True), 1e-30)
        mixed = np.einsum("gl,gl->g", p, share[doc])
        return share, np.add.reduceat(weight * np.log(np.maximum(mixed, 1e-30)), starts)

    def proportions(self, found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """Language shares of documents, given as distinct buckets (one at
        least) and their counts, after the selection of their language sets,
        and their numbers of trigrams."""
        size = np.array([len(used) for used, _ in found])
        starts = np.concatenate([[0], np.cumsum(size)[:-1]])
        doc = np.repeat(np.arange(len(found)), size)
        p = self.p[np.concatenate([used for used, _ in found])]
        weight = np.concatenate([counts for _, counts in found]).astype(np.float32)
        n = np.array([counts.sum() for _, counts in found], dtype=np.float32)
        k = len(self.languages)
        active = np.ones((len(found), k), dtype=np.float32)
        share, fit = self._em(p, weight, doc, starts, active / k, active, ROUNDS)
        cost = PENALTY * np.log(n + 1.0)
        rows = np.arange(len(found))
        for _ in range(k - 1):
            several = active.sum(axis=1) > 1
            if not several.any():
                break
            weakest = np.where(active > 0, share, np.inf).argmin(axis=1)
            trial = active.copy()
            trial[rows[several], weakest[several]] = 0
            begin = np.maximum(share, 1e-3) * trial
            begin = begin / begin.sum(axis=1, keepdims=True)
            less, fit_less = self._em(p, weight, doc, starts, begin, trial, ROUNDS_AGAIN)
            drop = several & (fit - fit_less <= cost)
            if not drop.any():
                break
            active[drop], share[drop], fit[drop] = trial[drop], less[drop], fit_less[drop]
        return share, n

    def label(self, texts) -> tuple[list[str], list[float], list[str]]:
        lang, score, langs = [UNKNOWN] * len(texts), [0.0] * len(texts), [""] * len(texts)
        pending: list[tuple[int, tuple[np.ndarray, np.ndarray]]] = []

        def flush():
            share, n = self.proportions([x for _, x in pending])
            best = share.argmax(axis=1)
            k = len(self.languages)
            for (i, _), row, b, m in zip(pending, share, best, n):
                lang[i] = self.languages[b]
                score[i] = float((m * row[b] + 1) / (m + k))
                order = np.argsort(-row, kind="stable")
                langs[i] = ",".join(f"{self.languages[j]}:{row[j]:.3f}" for j in order if row[j] > 0)
            pending.clear()

        held = 0
        for i, text in enumerate(texts):
            found = trigrams(text)
            if len(found) and self.languages:
                counts = np.bincount(found, minlength=BUCKETS)
                used = np.flatnonzero(counts)
                pending.append((i, (used, counts[used])))
                held += len(used)
                if held >= CHUNK:
                    flush()
                    held = 0
        if pending:
            flush()
        return lang, score, langs


def fit(docs: DataFrame) -> Mixture:
    """Learn from (text, lang) of every given row with a language."""
    counted = (
        docs.where("lang is not null and text is not null").select("lang", "text")
        .mapInPandas(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
        .toArrow().to_pandas()
    )
    languages = sorted(counted["lang"].unique())
    counts = np.zeros((len(languages), BUCKETS), dtype=np.int64)
    counts[np.searchsorted(languages, counted["lang"].to_numpy().astype(str)) if len(counted) else [],
           counted["bucket"].to_numpy().astype(np.int64)] = counted["n"].to_numpy()
    return Mixture(languages, counts)


def predict(docs: DataFrame, model: Mixture) -> DataFrame:
    """Each row with lang_pred, score, proportions ('en:0.900,fr:0.100').

    Null text or a text without a letter: 'und', score 0, no proportions.
    Ties go to the language first in alphabetical order. Only the text is
    read. Repeated rows each get their row.
    """
    def label(texts: pd.Series) -> pd.DataFrame:
        lang, score, langs = model.label(list(texts))
        return pd.DataFrame({"lang_pred": lang, "score": score, "proportions": langs})

    out = by_text(docs, label, "lang_pred string, score double, proportions string", "_label")
    return out.select(*docs.columns, F.col("_label.lang_pred").alias("lang_pred"), F.col("_label.score").alias("score"),
                      F.col("_label.proportions").alias("proportions"))


def identify(docs: DataFrame) -> DataFrame:
    """Fit on the rows outside the test fold, predict every row.

    doc_id, held_out, lang_pred, score, proportions; a null doc_id is
    neither learned from nor held out. Without any labelled row every
    prediction is 'und'.
    """
    model = fit(docs.where(fold(F.col("doc_id")) != TEST_FOLD))
    return predict(docs.select("doc_id", "text"), model).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(fold(F.col("doc_id")) == TEST_FOLD, F.lit(False)).alias("held_out"),
        "lang_pred", "score", "proportions")
