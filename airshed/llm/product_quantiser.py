"""Near-duplicate embeddings by product quantisation.

Unit vectors are assigned to the coarse centroid nearest to them; the
residual is stored as one code per subspace. A vector y of list c' within
distance d of x lies on the far side of the plane between x's centroid c
and c', so c' need only be probed if x is no further than d from that plane.
In many dimensions a difference of length d reaches far less than d in any
one direction: a list is probed up to ``SPREAD`` standard deviations of that
reach, d * SPREAD / sqrt(dimensions), but never less than half of d, and a
pair counts when either of the two probes the other's list: one of them lies
within d / 2 of the plane, so no link is missed. In a probed list the distances to all codes
come from a lookup table of the query (asymmetric distance); whatever is
within d plus the code's own error is compared by exact cosine in double
precision, which loses nothing.

Equal vectors form a class and cost one row. Lists are cut into blocks, a
group is one block of queries and one block of a list, and what leaves it is
a count per query and a spanning forest: the rows grow with the vectors, not
with the links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import Scratch, components
from airshed.llm.sampling import bounded_sample

COSINE = 0.95
SAMPLE = 20_000                # vectors the index is fitted on, about
LISTS_MOST = 4096              # centroids sent to every task, at most
SUBSPACES, CODES = 8, 32
SPREAD = 4.0                   # infinite: every list that can hold a link is probed
ITERATIONS = 10
BLOCK = 512
_SLACK = 1e-5                  # for float32 in the table lookups


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    k = max(1, min(k, len(x)))
    centre = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(ITERATIONS):
        own = _nearest(x, centre)[0]
        count = np.bincount(own, minlength=k)
        total = np.zeros_like(centre)
        np.add.at(total, own, x)
        used = count > 0
        centre[used] = total[used] / count[used, None]
        if (~used).any():
            centre[~used] = x[rng.choice(len(x), int((~used).sum()))]
    return centre


def _nearest(x: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    gap = (x * x).sum(axis=1)[:, None] - 2 * x @ centre.T + (centre * centre).sum(axis=1)
    return gap.argmin(axis=1), gap


class Quantiser:
    """Coarse centroids and the codebooks of the residuals' subspaces."""

    def __init__(self, vectors: np.ndarray, lists: int):
        rng = np.random.default_rng(17)
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        self.centres = _kmeans(unit, lists, rng)
        self.parts = [p for p in np.array_split(np.arange(unit.shape[1]), min(SUBSPACES, unit.shape[1]))]
        rest = unit - self.centres[_nearest(unit, self.centres)[0]]
        self.books = [_kmeans(rest[:, p], CODES, rng) for p in self.parts]
        apart = (self.centres * self.centres).sum(axis=1)
        self.apart = np.sqrt(np.maximum(apart[:, None] + apart - 2 * self.centres @ self.centres.T, 0))

    def encode(self, vectors: np.ndarray, cosine: float):
        """Own list, codes, code error and the lists to probe, of each row."""
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        own, gap = _nearest(unit, self.centres)
        rest = unit - self.centres[own]
        codes = np.stack([_nearest(rest[:, p], b)[0] for p, b in zip(self.parts, self.books)], axis=1).astype(np.uint8)
        for m, (p, b) in enumerate(zip(self.parts, self.books)):
            rest[:, p] -= b[codes[:, m]]
        reach = math.sqrt(2 - 2 * cosine) * min(1.0, max(0.5, SPREAD / math.sqrt(unit.shape[1])))
        near = gap - gap[np.arange(len(own)), own][:, None] <= 2 * reach * self.apart[own] + _SLACK
        near[np.arange(len(own)), own] = True
        return own, codes, np.linalg.norm(rest, axis=1), near

    def distances(self, queries: np.ndarray, at: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric distances of unit queries to the codes of list ``at``."""
        rest = queries - self.centres[at]
        total = np.zeros((len(queries), len(codes)), dtype=np.float32)
        for m, (p, b) in enumerate(zip(self.parts, self.books)):
            total += _nearest(rest[:, p], b)[1].astype(np.float32)[:, codes[:, m]]
        return np.sqrt(np.maximum(total, 0))


def _block(model: Quantiser, cosine: float):
    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        at = int(pdf["list"].iloc[0])
        pdf = pdf.sort_values("id", kind="stable")
        asks, has = pdf[pdf["asks"]], pdf[~pdf["asks"]]
        if not len(asks) or not len(has):
            return pd.DataFrame({"id": [], "links": [], "head": []}).astype("int64")

        def vectors(rows):
            x = np.frombuffer(b"".join(rows["vector"]), dtype=np.float32).reshape(len(rows), -1).astype(np.float64)
            return x / np.linalg.norm(x, axis=1, keepdims=True)

        x, y = vectors(asks), vectors(has)
        codes = np.frombuffer(b"".join(has["codes"]), dtype=np.uint8).reshape(len(has), -1)
        home, sure = asks["own"].to_numpy(), np.zeros((len(has), len(model.centres)), dtype=bool)
        for r, lists in enumerate(has["probes"]):
            sure[r, lists] = True
        reach = math.sqrt(2 - 2 * cosine) + _SLACK
        close = model.distances(x, at, codes) <= reach + has["error"].to_numpy()
        left, right = asks["id"].to_numpy(), has["id"].to_numpy()
        close &= left[:, None] != right
        linked = np.zeros(close.shape, dtype=bool)
        i, j = np.nonzero(close)
        for k in range(0, len(i), 65_536):
            a, b = i[k:k + 65_536], j[k:k + 65_536]
            linked[a, b] = np.einsum("nd,nd->n", x[a], y[b]) >= cosine
        links = linked @ has["weight"].to_numpy()
        # a query whose own list the other one does not probe is counted for both here
        i, j = np.nonzero(linked)
        alone = ~sure[j, home[i]]
        back = np.bincount(j[alone], weights=asks["weight"].to_numpy()[i[alone]], minlength=len(has)).astype(np.int64)
        head, seen = left.copy(), np.zeros(len(left), dtype=bool)
        hung = np.full(len(right), -1, dtype=np.int64)
        for s in np.flatnonzero(linked.any(axis=1)):
            if seen[s]:
                continue
            rows, cols = np.zeros(len(left), dtype=bool), np.zeros(len(right), dtype=bool)
            edge = np.array([s])
            while len(edge):
                rows[edge] = True
                cols |= linked[edge].any(axis=0)
                edge = np.flatnonzero(linked[:, cols].any(axis=1) & ~rows)
            top = min(left[rows].min(), right[cols].min())
            seen |= rows
            head[rows], hung[cols] = top, top
        kept = linked.any(axis=0)
        out = [pd.DataFrame({"id": left, "links": links, "head": head})[linked.any(axis=1)],
               pd.DataFrame({"id": right[kept], "links": back[kept], "head": hung[kept]})]
        return pd.concat(out).astype("int64")

    return work


def _valid(column: str = "embedding"):
    finite = F.forall(column, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.col(column).isNotNull() & finite & F.exists(column, lambda v: v != 0)


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, lists: int | None = None, block: int = BLOCK,
                    sample: int = SAMPLE) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of ``vectors`` (vec_id,
    embedding). The other columns are ignored.

    Null and zero vectors and vectors with null or non-finite components have
    no links. Vectors of different lengths are not linked. Repeated rows
    count as different vectors of one id. A null id has no component and is
    not kept. Empty table: empty result.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "quantiser")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding"))
    classes = scratch.settle(rows.where(_valid() & F.col("vec_id").isNotNull()).groupBy("embedding").agg(
        F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("weight")).withColumn("size", F.size("embedding")))
    sizes = {r["size"]: r["n"] for r in classes.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    found = None
    for size, n in sorted(sizes.items()):
        own = classes.where(F.col("size") == size)
        drawn = bounded_sample(own, "id", sample).select("id", "embedding").toArrow().to_pandas().sort_values("id")
        if not len(drawn):
            drawn = own.select("id", "embedding").limit(1).toArrow().to_pandas()
        model = Quantiser(np.stack(drawn["embedding"].to_numpy()).astype(np.float64),
                          lists or max(1, min(LISTS_MOST, round(math.sqrt(n)))))
        here = _links(scratch, own, model, cosine, block)
        found = here if found is None else found.unionByName(here)
    if found is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.col("vec_id").isNotNull().alias("kept"))
    linked = components(scratch, found.where("id <> head"), "id", "head")
    per_class = scratch.settle(
        classes.select("embedding", "id", "weight")
        .join(found.groupBy("id").agg(F.sum("links").alias("links")), "id", "left")
        .join(linked, "id", "left")
        .select("embedding", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                F.coalesce("component", "id").alias("component_id")))
    scratch.drop(classes)
    out = rows.withColumn("key", F.when(_valid() & F.col("vec_id").isNotNull(), F.col("embedding"))).join(
        per_class.withColumnRenamed("embedding", "key"), "key", "left")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(False)).alias("kept"))


def _links(scratch: Scratch, classes: DataFrame, model: Quantiser, cosine: float, block: int) -> DataFrame:
    """(id, links, head): counts of linked vectors and a spanning forest, of
    classes of one length."""
    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                x = np.stack(pdf["embedding"].to_numpy()).astype(np.float32)
                own, codes, error, near = model.encode(x.astype(np.float64), cosine)
                yield pd.DataFrame({"id": pdf["id"], "weight": pdf["weight"], "vector": [v.tobytes() for v in x], "own": own,
                                    "codes": [c.tobytes() for c in codes], "error": error,
                                    "probes": [np.flatnonzero(p).astype(np.int32) for p in near]})

    placed = scratch.settle(classes.select("id", "weight", "embedding").mapInPandas(
        place, "id long, weight long, vector binary, own int, codes binary, error double, probes array<int>"))
    held = placed.groupBy("own").agg(F.count(F.lit(1)).alias("held")).withColumnRenamed("own", "list")
    asked = placed.select(F.explode("probes").alias("list")).groupBy("list").agg(F.count(F.lit(1)).alias("asked"))
    # a row for each centroid: bounded by LISTS_MOST
    plan = F.broadcast(held.join(asked, "list").select(
        "list", F.ceil(F.col("held") / block).cast("int").alias("blocks"),
        F.ceil(F.col("asked") / block).cast("int").alias("waves")))
    mark = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    asks = (
        placed.select("id", "weight", "vector", "own", F.explode("probes").alias("list")).join(plan, "list")
        .select("list", (mark % F.col("waves")).cast("int").alias("wave"),
                F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("part"), "id", "weight", "vector",
                F.lit(None).cast("binary").alias("codes"), F.lit(0.0).alias("error"), "own",
                F.lit(None).cast("array<int>").alias("probes"), F.lit(True).alias("asks"))
    )
    has = (
        placed.withColumnRenamed("own", "list").join(plan, "list")
        .select("list", F.explode(F.sequence(F.lit(0), F.col("waves") - 1)).alias("wave"),
                (mark % F.col("blocks")).cast("int").alias("part"), "id", "weight", "vector", "codes", "error",
                F.col("list").alias("own"), "probes", F.lit(False).alias("asks"))
    )
    return scratch.settle(asks.unionByName(has).groupBy("list", "wave", "part").applyInPandas(
        _block(model, cosine), "id long, links long, head long"))
