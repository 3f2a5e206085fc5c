"""The pipeline: each stage's decisions against brute force, odd tables."""

import importlib

import pytest

import corpus_pipeline as P
from airshed.llm import packing
from llm_cases import AWKWARD, rows
from test_hyperminhash import brute as near_groups
from test_secret_crf import base

SF = "/root/testdata/sf0.001"


@pytest.fixture
def written(spark, tmp_path, documents):
    def write(data):
        path = str(tmp_path / "sf")
        documents(data).drop("id", "kept").write.mode("overwrite").parquet(f"{path}/documents.parquet")
        return path
    return write


def test_stages_on_the_driver_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = P.language_id(spark, docs, SF)
    assert kept.columns == docs.columns and kept.count() == docs.count()        # every text has letters
    groups = near_groups([(r.doc_id, r.text) for r in kept.collect()], 80)
    alone = P.near_dedup(spark, kept, SF)
    assert sorted(r.doc_id for r in alone.collect()) == [i for i, _, _, first in groups if first]
    clean = P.redact_secrets(spark, alone, SF)
    for r in clean.collect():
        assert not base(r.text) and r.n_chars == len(r.text)
    assert clean.count() == alone.count() and clean.columns == docs.columns
    mixed = P.mix_sources(spark, clean, SF)
    assert mixed.columns == docs.columns
    want = {r.doc_id for r in P.mixing.mix(P.mixing.with_topic(clean)).where("kept").collect()}
    assert {r.doc_id for r in mixed.collect()} == want
    pieces = P.pack_sequences(spark, mixed, SF).collect()
    assert {p.doc_id for p in pieces} == want
    encode = packing.default_encoder()
    texts = {r.doc_id: r.text for r in mixed.collect()}
    assert sum(p.length for p in pieces) == sum(len(encode(t)) + 1 for t in texts.values())


def test_run_is_the_chain_of_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF)
    # the stream's order is that of the partitions: compare what each document got
    per_doc = lambda df: sorted(rows(df.groupBy("doc_id", "doc_tokens").sum("length")))
    assert per_doc(P.run(spark, SF)) == per_doc(docs)


def test_near_copies_from_0_8_on_go(spark, documents):
    words = [f"w{i}" for i in range(104)]                 # 100 shingles; n spoilt last words leave 100 - n of them
    texts = [" ".join(words[:104 - n] + [f"x{n}y{i}" for i in range(n)]) for n in (0, 10, 12)]
    for other, stays in ((1, False), (2, True)):          # 90/110 and 88/112
        data = documents([(1, texts[0], "en", "s"), (2, texts[other], "en", "s")])
        assert len(P.near_dedup(spark, data, SF).collect()) == 1 + stays
        assert P.hyperminhash.near_duplicates(data).where("kept").count() == 2


def test_rows_with_one_id(spark, documents):
    data = [(1, "b text of its own", "en", "s"), (1, "a text of its own", "en", "t"), (1, "a text of its own", "en", "s"),
            (2, None, "en", "s"), (2, "later", "en", "s")]
    got = {r.doc_id: (r.text, r.source) for r in P.near_dedup(spark, documents(data).repartition(3), SF).collect()}
    assert got == {1: ("a text of its own", "s"), 2: (None, "s")}


def test_awkward_table(spark, written):
    path = written(AWKWARD)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = P.language_id(spark, docs, path)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [-5, 4, 4, 6, 7, 8, 2**62 + 1]
    alone = P.near_dedup(spark, kept, path)
    assert sorted(r.doc_id for r in alone.collect() if r.doc_id is not None) == [-5, 6, 8, 2**62 + 1]
    assert sum(r.doc_id is None for r in alone.collect()) == 1
    assert P.run(spark, path).count() >= 0


def test_empty_table(spark, written):
    assert rows(P.run(spark, written([]))) == []


def test_registered_queries():
    entry = importlib.import_module("__spark_entry__")
    names = [n for n in entry.queries() if n.startswith("op")]
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14)) and "pipeline" in entry.queries()
