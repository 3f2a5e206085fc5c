"""Shared helpers of the training-data operators: reading tables, cutting
lineage through the shared checkpoint folder, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.session import ensure_checkpoint_dir, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Scratch:
    """Tables written to the shared checkpoint folder (``spark.checkpoint.dir``).

    A written table survives the loss of executors, is computed once
    whatever reads it, and is dropped as soon as a later table replaces it.
    What a returned DataFrame still reads stays until ``drop_all``.
    """

    def __init__(self, spark: SparkSession, name: str):
        ensure_checkpoint_dir(spark)
        self.spark, self.base, self.n = spark, scratch_path(spark, name), 0
        self.paths: dict[int, str] = {}

    def settle(self, df: DataFrame, codec: str = "zstd") -> DataFrame:
        path = f"{self.base}/{self.n}"
        self.n += 1
        df.write.option("compression", codec).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        return out

    def _delete(self, path: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            if path := self.paths.pop(id(df), None):
                self._delete(path)

    def drop_all(self) -> None:
        self._delete(self.base)
        self.paths.clear()


def by_text(docs: DataFrame, fn: Callable[[pd.Series], pd.DataFrame], schema: str, name: str) -> DataFrame:
    """``docs`` with a struct column that ``fn`` makes of the texts, batch by
    batch, once a row."""
    udf = F.pandas_udf(fn, schema).asNondeterministic()  # else a filter on a field runs it once more
    return docs.withColumn(name, udf(F.col("text").cast("string")))


def in_slices(batches: Iterator[pd.DataFrame], rows: int = 1000) -> Iterator[pd.DataFrame]:
    """The batches cut to at most ``rows`` rows, for tasks whose output is as
    large as their texts."""
    for pdf in batches:
        for at in range(0, len(pdf), rows):
            yield pdf.iloc[at:at + rows]


def with_ids(docs: DataFrame) -> DataFrame:
    """(doc_id as text, text): pandas would turn a whole-number column that
    holds a null into floats, which cannot carry every 64-bit id."""
    return docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))


def components(scratch: Scratch, edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(id, component)`` for every id on an edge; component is the smallest
    id reachable.

    Alternating large-star and small-star steps (Kiveris et al., 2014): in
    each step a vertex learns the smallest of its neighbours by a partial
    aggregation and hangs its neighbours under it by a join, so a hub is
    neither collected nor multiplied, and the number of rounds grows with
    the logarithm of the longest path. Each round is a written table.
    Empty input: empty result. Loops and repeated edges are harmless.
    """
    def step(pairs: DataFrame, large: bool) -> DataFrame:
        # rows (u, v): v is a neighbour of u to be considered at u
        # joined on the id's complement: dealt anew on both sides, so that a
        # hub's rows can be split (an aggregate's own partitions cannot)
        least = pairs.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select(F.bitwise_not("u").alias("k"), F.col("u").alias("w"), F.least("u", "m").alias("m"))
        hung = pairs.join(least, F.bitwise_not(pairs["u"]) == least["k"])
        if large:
            out = hung.where("v > u").select(F.col("v").alias("x"), F.col("m").alias("y"))
        else:
            out = hung.select(F.col("v").alias("x"), F.col("m").alias("y")).unionByName(
                least.select(F.col("w").alias("x"), F.col("m").alias("y")))
        return out.where("x <> y").distinct()

    now = scratch.settle(edges.select(F.greatest(a, b).cast("long").alias("x"), F.least(a, b).cast("long").alias("y"))
                         .where("x <> y").distinct())
    mark = None
    while True:
        both = now.select(F.col("x").alias("u"), F.col("y").alias("v")).unionByName(
            now.select(F.col("y").alias("u"), F.col("x").alias("v")))
        big = step(both, True)
        # small star: at x, the neighbours below it
        nxt = scratch.settle(step(big.select(F.col("x").alias("u"), F.col("y").alias("v")), False))
        seen = nxt.agg(F.count(F.lit(1)), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)")),
                       F.count_distinct("x")).first()
        scratch.drop(now)
        now = nxt
        # a star forest (one parent each) that a round leaves unchanged is final
        if seen[0] == 0 or (seen[0] == seen[2] and mark == seen[1]):
            break
        mark = seen[1]
    root = now.select(F.col("y").alias("id"), F.col("y").alias("component")).distinct()
    return now.select(F.col("x").alias("id"), F.col("y").alias("component")).unionByName(root)

