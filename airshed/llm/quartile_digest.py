"""Document fingerprints: a quartile bucket digest.

Byte triplets from a sliding window of five bytes are hashed into 256
buckets. A digest is the text's length on a logarithmic scale, two ratios
of the quartiles of the bucket counts, and for each bucket the quartile its
count lies in (two bits). Two digests are compared by a difference that is
bounded, so the likeness 1 - difference / bound lies in 0 to 1.

Each document is also compared with its *edited* text, whose second half is
taken from the next document by descending id. For that the rows are
range-partitioned and sorted by id and read as a stream that holds two
texts; only the first and last row of each partition are matched up
afterwards, through a table with two rows a partition.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airshed.llm.common import Scratch, with_ids

BUCKETS, WINDOW = 256, 5
LENGTH_BASE = 1.2              # a step of the length code
LENGTH_WEIGHT, LENGTH_MOST = 4, 60
RATIO_WEIGHT = 3
FAR = 6                        # difference of a bucket in the first and the fourth quartile
BOUND = 400                    # about what unrelated bytes differ by

_rng = np.random.default_rng(1_013)
_TABLE = np.array([_rng.permutation(256) for _ in range(WINDOW)], dtype=np.uint8)
_SALT = {(j, k): np.uint8(_rng.integers(256)) for j in range(1, WINDOW) for k in range(j + 1, WINDOW)}
_CODES = (np.arange(256)[:, None] >> np.array([6, 4, 2, 0])) & 3
_GAP = np.abs(_CODES[:, None, :] - _CODES[None, :, :])
_APART = np.where(_GAP == 3, FAR, _GAP).sum(axis=2).astype(np.int32)   # by pairs of bytes


def digest(text: str) -> str:
    """Hexadecimal digest of a text; shorter than the window: padded by zero bytes."""
    raw = text.encode("utf-8", "surrogatepass")
    n = len(raw)
    data = np.frombuffer(raw.ljust(WINDOW, b"\0"), dtype=np.uint8)
    size = len(data) - WINDOW + 1
    hashed = [_TABLE[k][data[k:k + size]] for k in range(WINDOW)]
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for (j, k), salt in _SALT.items():
        counts += np.bincount(hashed[0] ^ hashed[j] ^ hashed[k] ^ salt, minlength=BUCKETS)
    order = np.sort(counts)
    q1, q2, q3 = (int(order[BUCKETS * i // 4 - 1]) for i in (1, 2, 3))
    code = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    packed = code[0::4] << 6 | code[1::4] << 4 | code[2::4] << 2 | code[3::4]
    length = min(255, int(math.log(n) / math.log(LENGTH_BASE)) + 1) if n else 0
    ratio = [min(15, 16 * q // q3) if q3 else 0 for q in (q1, q2)]
    return f"{length:02x}{ratio[0]:x}{ratio[1]:x}" + packed.astype(np.uint8).tobytes().hex()


def difference(a: str, b: str) -> int:
    x, y = bytes.fromhex(a), bytes.fromhex(b)
    apart = min(LENGTH_MOST, LENGTH_WEIGHT * max(0, abs(x[0] - y[0]) - 1))
    for shift in (4, 0):
        apart += RATIO_WEIGHT * max(0, abs((x[1] >> shift & 15) - (y[1] >> shift & 15)) - 1)
    return apart + int(_APART[np.frombuffer(x, np.uint8)[2:], np.frombuffer(y, np.uint8)[2:]].sum())


def likeness(a: str, b: str) -> float:
    return max(0.0, 1.0 - difference(a, b) / BOUND)


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_TYPES = ("doc_id string, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _row(doc_id, text: str, own: str, following: str, its: str) -> tuple:
    changed = edited(text, following)
    mark = digest(changed)
    return (doc_id, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), own, mark,
            likeness(own, mark), likeness(own, its))


def _stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Finished rows; the partition's first and last document as they are."""
    part, held, first = TaskContext.get().partitionId(), None, True
    names = [*COLUMNS, "part", "place", "text"]
    for pdf in batches:
        out = []
        for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
            text = text or ""
            own = digest(text)
            if held:
                out.append((*_row(*held, text, own), part, "done", None))
            if first:
                out.append((doc_id, len(text), None, own, None, None, None, part, "first", text))
                first = False
            held = doc_id, text, own
        yield pd.DataFrame(out, columns=names)
    if held:
        doc_id, text, own = held
        yield pd.DataFrame([(doc_id, len(text), None, own, None, None, None, part, "last", text)], columns=names)


def _finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame([_row(*r) for r in zip(pdf["doc_id"], pdf["text"], pdf["fingerprint"], pdf["next_text"], pdf["its"])],
                           columns=COLUMNS)


def fingerprints(docs: DataFrame) -> DataFrame:
    """The columns of ``COLUMNS`` for each row of ``docs`` (doc_id, text).

    Null text: empty. Repeated ids: ordered by text. Null ids come last in
    the descending order. A single document is its own next one. Empty table:
    empty result.
    """
    scratch = Scratch(docs.sparkSession, "fingerprints")
    by_id = F.col("doc_id").cast("long").desc_nulls_last()
    rows = scratch.settle(
        with_ids(docs).repartitionByRange(by_id).sortWithinPartitions(by_id, F.col("text").desc_nulls_last())
        .mapInPandas(_stream, f"{_TYPES}, part int, place string, text string"))
    done = rows.where("place = 'done'").select(*COLUMNS)
    heads = rows.where("place = 'first'").select("part", F.col("text").alias("next_text"), F.col("fingerprint").alias("its"))
    # two rows a partition from here on; the window reads one number a partition
    parts = rows.where("place = 'first'").select("part").withColumn("all", F.lit(1))
    following = parts.select("part", F.coalesce(
        F.lead("part").over(Window.partitionBy("all").orderBy("part")),
        F.first("part").over(Window.partitionBy("all").orderBy("part"))).alias("next_part"))
    ends = (
        rows.where("place = 'last'").join(following, "part")
        .join(heads.withColumnRenamed("part", "next_part"), "next_part")
        .select("doc_id", "text", "fingerprint", "next_text", "its").mapInPandas(_finish, _TYPES)
    )
    return done.unionByName(ends).withColumn("doc_id", F.col("doc_id").cast("long"))
