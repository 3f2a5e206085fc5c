"""Packing token sequences: concatenate and cut.

Every document becomes its token ids and the separator. The documents of
all partitions stand one after the other in one stream, which is cut every
``SEQUENCE`` tokens; a piece is what one document has in one window, and is the
record of that boundary. Nothing but the end of the stream is padded.

Two passes: the first tokenizes each text once and writes its ids with the
document's offset inside its partition; the second adds the partition's
place in the stream, a prefix sum over one total per partition, and cuts
each document by arithmetic, without bringing rows together.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airshed.llm.common import Scratch, in_slices, with_ids

SEQUENCE = 2048
SEPARATOR = 1
VOCABULARY = "byte_bpe_50k.json"
#: The same vocabulary in the form of a library that encodes it faster.
RANKS = "byte_bpe_50k.tiktoken"
SPECIAL = {"<|endoftext|>": 50256}


def ranks_encoder(path: str, pattern: str):
    """text -> ids of a byte-level BPE given as ranks; the special token's
    string is the special id, as the vocabulary file declares it."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    coder = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens=SPECIAL)
    return lambda text: coder.encode(text, allowed_special="all")


def file_encoder(path: str):
    """text -> ids of a vocabulary file of the tokenizers library."""
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(path)
    return lambda text: coder.encode(text, add_special_tokens=False).ids


def default_encoder():
    """The ids of ``byte_bpe_50k.json``; made inside a task, from the files
    installed there. A text whose words the ranks' pattern cannot cut (a
    million blanks in a row exhaust its stack) is encoded by the file's own encoder."""
    import public_tokenizers

    fast, own = ranks_encoder(public_tokenizers.path(RANKS), public_tokenizers.PATTERN), []

    def encode(text: str):
        try:
            return fast(text)
        except ValueError:
            if not own:
                own.append(file_encoder(public_tokenizers.path(VOCABULARY)))
            return own[0](text)

    return encode


def tokenize(docs: DataFrame, make_encoder=default_encoder, separator: int = SEPARATOR) -> DataFrame:
    """doc_id, part, before, doc_tokens, ids for each row: ``ids`` are unsigned
    32-bit little-endian numbers with the separator last, ``before`` counts the
    partition's ids ahead of the document. To be written before it is read
    twice: the order of a partition's rows is that of one run."""
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, before, part = make_encoder(), 0, TaskContext.get().partitionId()
        for pdf in in_slices(batches):
            ids, at = [], []
            for text in pdf["text"]:
                found = np.append(np.asarray(encode(text) if text else [], dtype="<u4"), np.uint32(separator)).astype("<u4")
                ids.append(found.tobytes())
                at.append(before)
                before += len(found)
            yield pd.DataFrame({"doc_id": pdf["doc_id"].to_numpy(), "part": part, "before": at,
                                "doc_tokens": [len(x) // 4 for x in ids], "ids": ids})

    return with_ids(docs).mapInPandas(work, "doc_id string, part int, before long, doc_tokens long, ids binary").withColumn(
        "doc_id", F.col("doc_id").cast("long"))


def cut(tokens: DataFrame, length: int = SEQUENCE) -> DataFrame:
    """Pieces of written ``tokenize`` rows: doc_id, start, length, ids (of the
    piece), doc_tokens, sequence_id, offset."""
    # one row a partition: a small table, and the window's single task reads no more than that
    totals = tokens.groupBy("part").agg(F.max(F.col("before") + F.col("doc_tokens")).alias("total"))
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(upto), F.lit(0)).alias("base"))
    placed = tokens.join(F.broadcast(bases), "part").withColumn("place", F.col("base") + F.col("before"))
    after = F.col("place") + F.col("doc_tokens")
    size = F.lit(length).cast("long")
    pieces = placed.withColumn(
        "sequence_id", F.explode(F.sequence(F.expr(f"place div {length}"), F.expr(f"(place + doc_tokens - 1) div {length}"))))
    begin = F.greatest("place", F.col("sequence_id") * size)
    end = F.least(after, (F.col("sequence_id") + 1) * size)
    start, n = begin - F.col("place"), end - begin
    return pieces.select(
        "doc_id", start.alias("start"), n.alias("length"),
        F.substr("ids", (start * 4 + 1).cast("int"), (n * 4).cast("int")).alias("ids"), "doc_tokens", "sequence_id",
        (begin - F.col("sequence_id") * size).alias("offset"))


def pack(docs: DataFrame, make_encoder=default_encoder, length: int = SEQUENCE, separator: int = SEPARATOR) -> DataFrame:
    """Pieces with their ids. Null or empty text: the separator alone. Repeated
    rows and equal texts are packed once each. Texts of any length and make
    are encoded whole. Empty table: no piece. Only doc_id and text are read."""
    scratch = Scratch(docs.sparkSession, "packing")
    return cut(scratch.settle(tokenize(docs, make_encoder, separator)), length)


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
