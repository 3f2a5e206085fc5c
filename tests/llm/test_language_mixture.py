"""Language mixtures: recovered proportions, held-out accuracy, defined results for odd rows."""

import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from airshed.llm import language_mixture as M
from llm_cases import AWKWARD, rows

SF = "/root/testdata/sf0.01"


def test_proportions_of_a_concatenated_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = M.fit(docs)
    assert model.languages == ["de", "en", "es", "fr"]
    own = {r.lang: r.text for r in docs.where("n_chars between 2000 and 3000").collect()}
    lang, score, parts = model.label([own["de"], own["fr"][:2000] + " " + own["en"][:2000], own["es"]])
    assert [lang[0], lang[2]] == ["de", "es"] and lang[1] in ("fr", "en")
    assert {p.split(":")[0] for p in parts[1].split(",")} >= {"fr", "en"}
    share = {p.split(":")[0]: float(p.split(":")[1]) for p in parts[1].split(",")}
    assert abs(share["fr"] - 0.5) < 0.12 and abs(share["en"] - 0.5) < 0.12
    assert all(0 <= s <= 1 for s in score)


def test_em_is_the_likelihood_maximum():
    # two languages, three trigram buckets: compare with a grid search
    counts = np.zeros((2, M.BUCKETS), dtype=np.int64)
    counts[0, :3], counts[1, :3] = (800, 150, 50), (50, 250, 700)
    model = M.Mixture(["a", "b"], counts)
    share, n = model.proportions([(np.array([0, 1, 2]), np.array([60, 30, 110]))])
    p = model.p[[0, 1, 2]].astype(float)
    grid = np.linspace(0.001, 0.999, 999)
    like = [(np.array([60, 30, 110]) * np.log(g * p[:, 0] + (1 - g) * p[:, 1])).sum() for g in grid]
    assert abs(share[0, 0] - grid[int(np.argmax(like))]) < 0.01 and n[0] == 200


def test_held_out_accuracy_and_folds(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = M.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(out) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    held = [r for r in out if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.97


def test_awkward_rows(spark, documents):
    found = rows(M.identify(documents(AWKWARD)))
    assert len(found) == len(AWKWARD)
    by = {r[0]: r for r in found}
    assert all(by[i][2:] == ("und", 0.0, "") for i in (1, 2, 3, 9))
    assert by[None][1] is False and by[None][2] in ("en", "de")
    assert by[4][2] == by[-5][2] == "en"


def test_empty_and_unlabelled(spark, documents):
    assert rows(M.identify(documents([]))) == []
    assert {r[2] for r in rows(M.identify(documents([(1, "some text", None, "s"), (2, None, None, None)])))} == {"und"}


def plain_trigrams(text):
    """Buckets of the letter trigrams, character by character."""
    code = [0]
    for c in (text or "").lower() + " ":
        x = ord(c) if c.isalpha() else 0
        if x or code[-1]:
            code.append(x)
    out, mask = Counter(), (1 << 32) - 1
    for a, b, c in zip(code, code[1:], code[2:]):
        if b:
            h = (a * 0x9E3779B1 & mask) ^ (b * 0x85EBCA77 + 0x165667B1 * c & mask)
            h = (h ^ h >> 15) * 0x2C1B3C6D & mask
            out[h >> 17] += 1
    return out


def plain_model(data):
    """Trigram probabilities of each language of (text, lang) rows."""
    counts = {}
    for text, lang in data:
        if lang is not None and (found := plain_trigrams(text)):
            counts.setdefault(lang, Counter()).update(found)
    whole = sum(counts.values(), Counter())
    total = sum(whole.values()) + M.SMOOTHING * M.BUCKETS
    return {lang: lambda b, c=c, n=sum(c.values()): (1 - M.BACKGROUND) * c[b] / n + M.BACKGROUND * (whole[b] + M.SMOOTHING) / total
            for lang, c in sorted(counts.items())}


def plain_label(model, text):
    """Language and score of one text: EM and removal of languages by loops."""
    found = plain_trigrams(text)
    if not found or not model:
        return "und", 0.0
    p = {lang: {b: of(b) for b in found} for lang, of in model.items()}
    n = sum(found.values())

    def em(share, rounds):
        for _ in range(rounds):
            taken = dict.fromkeys(share, 0.0)
            for b, k in found.items():
                mixed = sum(s * p[lang][b] for lang, s in share.items())
                for lang, s in share.items():
                    taken[lang] += k * s * p[lang][b] / mixed
            whole = sum(taken.values())
            share = {lang: t / whole for lang, t in taken.items()}
        return share, sum(k * math.log(sum(s * p[lang][b] for lang, s in share.items())) for b, k in found.items())

    share, fit = em({lang: 1 / len(model) for lang in model}, M.ROUNDS)
    while len(share) > 1:
        weakest = min(share, key=share.get)
        rest = {lang: max(s, 1e-3) for lang, s in share.items() if lang != weakest}
        less, fit_less = em({lang: s / sum(rest.values()) for lang, s in rest.items()}, M.ROUNDS_AGAIN)
        if fit - fit_less > M.PENALTY * math.log(n + 1):
            break
        share, fit = less, fit_less
    best = max(share, key=share.get)
    return best, (n * share[best] + 1) / (n + len(model))


def test_query_matches_a_plain_mixture(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    data = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    model = plain_model([(t, lang) for i, t, lang in data if zlib.crc32(str(i).encode()) % 5])
    # long texts are given by their first part here, the loops being slow
    short = docs.withColumn("text", F.substring("text", 1, 1500))
    got = {r.doc_id: r for r in M.predict(short, M.fit(docs.where(M.fold(F.col("doc_id")) != M.TEST_FOLD))).collect()}
    for i, text, _ in data:
        lang, score = plain_label(model, text[:1500])
        assert got[i].lang_pred == lang and abs(got[i].score - score) < 5e-3, i
