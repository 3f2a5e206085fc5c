"""Packing: exact round trip to the tokenizer's ids."""

import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from airshed.llm import packing as P
from llm_cases import AWKWARD, rows

SF = "/root/testdata/sf0.001"
_fast, _file = P.default_encoder(), P.file_encoder(public_tokenizers.path(P.VOCABULARY))


def check(docs, length):
    """Pieces put together give every document's ids, once, in windows without gaps."""
    pieces = P.pack(docs, length=length).collect()
    seen = sorted((p.sequence_id, p.offset, p.length) for p in pieces)
    at = 0
    for s, o, n in seen:
        assert s * length + o == at and n > 0 and o + n <= length
        at += n
    texts = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    made = []
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        if p.start == 0:
            made.append((p.doc_id, b""))
        made[-1] = (made[-1][0], made[-1][1] + bytes(p.ids))
        assert p.doc_id == made[-1][0]
    want = [(i, np.array([*(_file(t) if t else []), P.SEPARATOR], dtype="<u4").tobytes()) for i, t in texts]
    assert sorted(made, key=str) == sorted(want, key=str)
    return pieces


def test_round_trip_of_the_driver_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").repartition(7)
    pieces = check(docs, P.SEQUENCE)
    found = {(r.doc_id, r.start): r.ids_crc32 for r in P.digest(P.pack(docs)).collect()}
    assert found == {(p.doc_id, p.start): zlib.crc32(bytes(p.ids)) for p in pieces}


def test_awkward_rows_and_small_windows(spark, documents):
    check(documents(AWKWARD), 16)
    assert rows(P.pack(documents([]))) == []


def test_texts_that_exhaust_the_pattern(spark, documents):
    texts = [" " * 2_000_000, "\n" * 2_000_000, "a " + "\t \n" * 500_000 + "end"]
    for text in texts:
        assert list(_fast(text)) == list(_file(text))
    check(documents([(i, t, "en", "s") for i, t in enumerate([*texts, "plain"])]), P.SEQUENCE)


def test_exact_fit_and_single_tokens(spark, documents):
    docs = documents([(i, None, "en", "s") for i in range(8)])       # the separator alone: eight tokens
    pieces = P.pack(docs, length=4).collect()
    assert {(p.sequence_id, p.offset) for p in pieces} == {(s, o) for s in (0, 1) for o in range(4)}


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="ab '\n\t.é😀<|endoftext|>", max_size=60))
def test_both_encoders_agree(text):
    assert list(_fast(text)) == list(_file(text))
    assert list(_fast(text + "<|endoftext|> x")) == list(_file(text + "<|endoftext|> x"))
