"""Fingerprints: edited texts by brute force, digests, bounded likeness."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from airshed.llm import quartile_digest as Q
from llm_cases import AWKWARD, rows

SF = "/root/testdata/sf0.001"


def brute(data):
    """Expected rows of (id, text), ordered by descending id, then text."""
    order = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""), reverse=True)
    out = []
    for k, (i, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        changed = text[:len(text) - half] + following[:half]
        a, b, c = Q.digest(text), Q.digest(changed), Q.digest(following)
        out.append((i, len(text), hashlib.sha256(changed.encode()).hexdigest(), a, b, Q.likeness(a, b), Q.likeness(a, c)))
    return out


def same(found, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(found, key=key) == sorted(want, key=key)


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_neighbours_across_partitions(spark, parts):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        found = rows(Q.fingerprints(docs), *Q.COLUMNS)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    same(found, brute([(r.doc_id, r.text) for r in docs.collect()]))


def test_awkward_single_and_empty(spark, documents):
    docs = documents(AWKWARD)
    same(rows(Q.fingerprints(docs), *Q.COLUMNS), brute([(r.doc_id, r.text) for r in docs.collect()]))
    one = documents([(1, "a single document of its own", "en", "s")])
    same(rows(Q.fingerprints(one), *Q.COLUMNS), brute([(1, "a single document of its own")]))
    assert rows(Q.fingerprints(documents([]))) == []


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=300), st.text(max_size=300))
def test_likeness_is_bounded_symmetric_and_one_for_equal_texts(a, b):
    x, y = Q.digest(a), Q.digest(b)
    assert 0 <= Q.likeness(x, y) <= 1 and Q.likeness(x, y) == Q.likeness(y, x) and Q.likeness(x, x) == 1


def test_likeness_orders_texts_by_what_they_share(spark):
    docs = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").where("n_chars > 1500").collect()]
    a, b = docs[0], docs[1]
    light, heavy = a[:-30] + b[:30], a[:len(a) // 2] + b[:len(a) // 2]
    d = Q.digest
    assert Q.likeness(d(a), d(light)) > Q.likeness(d(a), d(heavy)) > Q.likeness(d(a), d(b)) - 0.05
