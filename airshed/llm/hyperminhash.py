"""Near-duplicate documents by HyperMinHash.

A document's set is its distinct 5-word shingles (``shingles.py``). Its
sketch has 256 registers: a shingle's top 8 hash bits name the bucket, the
bucket keeps the smallest of the remaining 56 bits, stored as its count of
leading zeros and the 10 bits after the leading one. A bucket that no
shingle fell into copies the register of an occupied one by a fixed random
ranking (optimal densification), so that two documents agree in a register
with a probability of their Jaccard similarity, also for short texts.

Steps, each of which Spark partitions:

1. sketch every text once; equal sets (128-bit digest) form a class with one
   representative, so copies cost one row each;
2. band the registers, in bands as long as the threshold allows (36 of 7 at
   0.85, 42 of 6 at 0.8); a band's bucket links its members with its smallest
   one. At a similarity of 0.85 the chance that none of 36 bands agrees is
   1e-6, at 0.3 that one does is 0.8 %; of 42 at 0.8 it is 3e-6 and 3 %;
3. the collision-corrected Jaccard estimate drops hopeless pairs, the exact
   comparison of the full sets confirms the others; linked documents become
   components;
4. buckets that still hold several components are compared in full: their
   documents form clusters, a cluster is cut into blocks of ``BLOCK``
   documents, and every pair of blocks is one small group: first with the
   registers alone, which tells the documents that pass the estimate with
   one of another component there, then with the full sets of those, which are
   compared exactly. Only a spanning forest of the links leaves a group,
   never its pairs.

A hot group of copies is one class; a hot group of near copies is resolved
in step 3 by one pair per member; only documents that resemble a group
without being linked to its smallest member reach step 4.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import Scratch, components, in_slices, with_ids
from airshed.llm.shingles import shingle_hashes

REGISTERS = 256
MANTISSA = 10
MISSED = 5e-6                  # chance that a pair on the threshold shares no band, at most
THRESHOLD = (85, 100)          # intersection / union, as a fraction of integers
WIDTH = 5                      # words a shingle
MARGIN = 0.25                  # an estimate this far below the threshold is hopeless (over 5 sigma)
BLOCK = 64

_RANK = np.argsort(np.random.default_rng(7_919).random((REGISTERS, REGISTERS)), axis=1).astype(np.uint8)


def registers(hashes: np.ndarray) -> np.ndarray:
    """256 registers (uint16) of a sorted, non-empty set of 64-bit hashes."""
    bucket = (hashes >> np.uint64(56)).astype(np.intp)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    used = bucket[first]
    low = hashes[first] << np.uint64(8)                      # 56 bits, left-aligned
    # leading zeros from the exponent; exact because the top bit decides it
    high = (low >> np.uint64(11)).astype(np.float64)
    zeros = np.where(high > 0, 53 - np.frexp(high)[1], 53).astype(np.uint64)
    mantissa = (low << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    out = np.zeros(REGISTERS, dtype=np.uint16)
    out[used] = (zeros << np.uint64(MANTISSA) | mantissa).astype(np.uint16)
    if len(used) < REGISTERS:
        bare = np.ones(REGISTERS, dtype=bool)
        bare[used] = False
        out[bare] = out[used][_RANK[bare][:, used].argmin(axis=1)]
    return out


def chance_agreement(n: np.ndarray | float, m: np.ndarray | float) -> np.ndarray:
    """Expected share of registers in which two unrelated sets of n and m
    elements agree: the sum over register values of the product of both
    probabilities, by the survival function of a bucket's minimum."""
    n = np.maximum(np.asarray(n, dtype=float) / REGISTERS, 1.0)
    m = np.maximum(np.asarray(m, dtype=float) / REGISTERS, 1.0)
    total = np.zeros(np.broadcast(n, m).shape)
    for zeros in range(0, 40):
        top = 2.0 ** -zeros
        # within one power of two the mantissa cells are nearly uniform
        p = np.exp(-n * top / 2) - np.exp(-n * top)
        q = np.exp(-m * top / 2) - np.exp(-m * top)
        total += p * q / 2 ** MANTISSA
    return total


def estimate(left: np.ndarray, right: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Collision-corrected Jaccard estimate of register rows."""
    agree = (left == right).mean(axis=-1)
    c = chance_agreement(n, m)
    return np.clip((agree - c) / (1 - c), 0.0, 1.0)


def banding(threshold: tuple[int, int]) -> tuple[int, int]:
    """Bands and registers of a band: the longest bands that miss a pair on
    the threshold with a probability of at most ``MISSED``."""
    t = threshold[0] / threshold[1]
    return next(((REGISTERS // r, r) for r in range(REGISTERS, 1, -1) if (1 - t ** r) ** (REGISTERS // r) <= MISSED), (REGISTERS, 1))


def linked(left: np.ndarray, right: np.ndarray, threshold: tuple[int, int] = THRESHOLD) -> bool:
    """Exact test on two full sets (sorted, distinct)."""
    low, high = sorted((len(left), len(right)))
    a, b = threshold
    if low == 0 or b * low < a * high:
        return False
    both = np.concatenate([left, right])
    both.sort(kind="stable")
    same = int(np.count_nonzero(both[1:] == both[:-1]))
    return b * same >= a * (len(left) + len(right) - same)


def _sketches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        n, digest, regs = [], [], []
        for text in pdf["text"]:
            s = shingle_hashes(text, WIDTH)
            n.append(len(s))
            digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
            regs.append(registers(s).tobytes() if len(s) else None)
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_shingles": n, "set_id": digest, "regs": regs})


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in in_slices(batches):
        yield pd.DataFrame({"id": pdf["doc_id"].to_numpy(), "shingles": [shingle_hashes(t, WIDTH).tobytes() for t in pdf["text"]]})


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.uint16).reshape(len(column), REGISTERS)


def _floor(threshold: tuple[int, int]) -> float:
    return threshold[0] / threshold[1] - MARGIN


def _confirm(threshold: tuple[int, int]):
    """Pairs with both sides' registers and sets -> the linked ones."""
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            size = pdf["a_shingles"].str.len().to_numpy() // 8, pdf["b_shingles"].str.len().to_numpy() // 8
            good = estimate(_matrix(pdf["a_regs"]), _matrix(pdf["b_regs"]), *size) >= _floor(threshold)
            keep = [bool(ok) and linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), threshold)
                    for ok, x, y in zip(good, pdf["a_shingles"], pdf["b_shingles"])]
            yield pdf.loc[keep, ["a", "b"]]

    return work


def _find(parent: list[int], x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def _rivals(x: int, root: np.ndarray, side: np.ndarray, one: bool, regs: np.ndarray, size: np.ndarray,
            threshold: tuple[int, int]) -> np.ndarray:
    """The later documents of a pair of blocks that are of another component
    and pass the estimate with ``x`` (from the other block, unless it is one block)."""
    rest = np.arange(x + 1, len(root))
    rest = rest[(root[rest] != root[x]) & (one | (side[rest] != side[x]))]
    return rest[estimate(regs[x], regs[rest], size[x], size[rest]) >= _floor(threshold)] if len(rest) else rest


def _block_candidates(threshold: tuple[int, int]):
    """One pair of blocks by registers: the documents whose sets are needed there."""
    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable", ignore_index=True)
        regs, size, root, side = _matrix(pdf["regs"]), pdf["size"].to_numpy(), pdf["component"].to_numpy(), pdf["side"].to_numpy()
        one, wanted = bool(pdf["i"].iloc[0] == pdf["j"].iloc[0]), np.zeros(len(pdf), dtype=bool)
        for x in range(len(pdf) - 1):
            rest = _rivals(x, root, side, one, regs, size, threshold)
            wanted[rest] = True
            wanted[x] |= len(rest) > 0
        return pdf.loc[wanted, ["cluster", "i", "j", "side", "id", "component"]]

    return work


def _block_links(threshold: tuple[int, int]):
    """One pair of blocks: a spanning forest of the links between documents
    of different components."""
    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable")
        regs = _matrix(pdf["regs"])
        sets = [np.frombuffer(x, np.uint64) for x in pdf["shingles"]]
        size = np.array([len(s) for s in sets])
        label, root = np.unique(pdf["component"].to_numpy(), return_inverse=True)
        parent = list(range(len(label)))
        side, one = pdf["side"].to_numpy(), bool((pdf["i"].iloc[0] == pdf["j"].iloc[0]))
        out = []
        for x in range(len(sets) - 1):
            for y in _rivals(x, root, side, one, regs, size, threshold):
                p, q = _find(parent, int(root[x])), _find(parent, int(root[y]))
                if p != q and linked(sets[x], sets[y], threshold):
                    parent[max(p, q)] = min(p, q)
                    out.append((label[root[x]], label[root[y]]))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return work


def near_duplicates(docs: DataFrame, block: int = BLOCK, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored):
    doc_id, n_shingles, component_id, kept. Documents are linked from the
    similarity ``threshold`` (a fraction of integers) on.

    Null, empty or blank text: an empty set, linked with nothing (its own
    component). Repeated rows: equal sets, one component. Null doc_id: a row
    like the others, but without a component (null, kept false). An empty
    table gives an empty result. Ties cannot occur: ids order everything.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "hyperminhash")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = scratch.settle(
        with_ids(docs).mapInPandas(_sketches, "doc_id string, n_shingles long, set_id binary, regs binary")
        .withColumn("doc_id", F.col("doc_id").cast("long")))

    # 1. classes of equal sets
    classes = scratch.settle(sketch.where("set_id is not null and doc_id is not null").groupBy("set_id").agg(
        F.min("doc_id").alias("id"), F.first("regs").alias("regs")))

    # 2. bands
    bands, registers_each = banding(threshold)
    width = 2 * registers_each
    keys = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)),
                       lambda b: F.xxhash64(b, F.substr("regs", b * width + 1, F.lit(width))))
    banded = classes.select("id", F.explode(keys).alias("band"))
    heads = banded.groupBy("band").agg(F.min("id").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    members = scratch.settle(banded.join(heads, "band"))
    pairs = members.where("id <> head").select(F.col("head").alias("a"), F.col("id").alias("b")).distinct()

    # the full sets, of those documents only that share a bucket
    wanted = members.select("id").distinct()
    sets = scratch.settle(
        docs.join(wanted, docs["doc_id"] == wanted["id"], "left_semi").mapInPandas(_sets, "id long, shingles binary")
        .dropDuplicates(["id"]).join(classes.select("id", "regs"), "id")
        .withColumn("size", (F.octet_length("shingles") / 8).cast("int")))

    # 3. each bucket's smallest member against the others
    side = lambda c: sets.select(F.col("id").alias(c), F.col("regs").alias(f"{c}_regs"),
                                 F.col("shingles").alias(f"{c}_shingles"))
    links = scratch.settle(pairs.join(side("a"), "a").join(side("b"), "b").mapInPandas(_confirm(threshold), "a long, b long"))
    first = scratch.settle(components(scratch, links))

    # 4. buckets with several components
    seen = members.join(first, "id", "left").select(
        "band", "id", "head", F.coalesce("component", "id").alias("component"))
    open_bands = seen.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where(
        "low <> high").select("band")
    opened = scratch.settle(seen.join(open_bands, "band").select("head", "id", "component").distinct())
    clusters = scratch.settle(components(scratch, opened, "head", "id"))
    sized = clusters.join(
        clusters.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")), "component"
    ).select("id", F.col("component").alias("cluster"), "blocks")
    labelled = opened.select("id", "component").distinct()
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    rest = (
        sized.join(labelled, "id").join(sets.select("id", "regs", "size"), "id").withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("cluster", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                F.col("own").alias("side"), "id", "component", "regs", "size")
    )
    candidates = scratch.settle(rest.groupBy("cluster", "i", "j").applyInPandas(
        _block_candidates(threshold), "cluster long, i int, j int, side int, id long, component long"))
    more = candidates.join(sets.select("id", "regs", "shingles"), "id").groupBy("cluster", "i", "j").applyInPandas(
        _block_links(threshold), "a long, b long")
    merged = scratch.settle(components(scratch, more))
    scratch.drop(members, sets, links, opened, clusters, candidates)

    # from class to component, then to every document
    final = (
        classes.select("set_id", "id").join(first, "id", "left")
        .select("set_id", F.coalesce("component", "id").alias("component"))
        .join(merged.select(F.col("id").alias("component"), F.col("component").alias("lowest")), "component", "left")
        .select("set_id", F.coalesce("lowest", "component").alias("component_id"))
    )
    final = scratch.settle(final)
    scratch.drop(classes, first, merged)
    return sketch.select("doc_id", "n_shingles", "set_id").join(final, "set_id", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
        .alias("component_id")
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))

