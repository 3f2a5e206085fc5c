"""Join operators.

Broadcast policy: a side is hinted for broadcast only when it is a fixed
rule or seed table. Every other join is a shuffle join, which AQE turns
into a broadcast after measuring the bytes of the real shuffle output
(``spark.sql.adaptive.autoBroadcastJoinThreshold``) and whose skewed
partitions it splits (``spark.sql.adaptive.skewJoin.enabled``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def join_dim(fact: DataFrame, dim: DataFrame, on: str | Sequence[str] | Column,
             how: str = "inner", broadcast: bool = False) -> DataFrame:
    """Fact x dimension join. With ``broadcast`` the caller vouches for a
    fixed small dimension (seed or rule table); else there is no hint and
    AQE plans the join from measured sizes."""
    if broadcast:
        dim = F.broadcast(dim)
    return fact.join(dim, on=on, how=how)


def full_join_coalesced(left: DataFrame, right: DataFrame, keys: Sequence[str],
                        right_keys: Sequence[str] | None = None,
                        left_cols: Sequence[str] | None = None,
                        right_cols: Sequence[str] | None = None) -> DataFrame:
    """FULL OUTER equi-join on ``keys`` whose output carries one coalesced
    column per key (left value, else right value).

    Columns other than the keys are taken as they are; name clashes must be
    resolved by the caller beforehand.
    """
    right_keys = list(right_keys or keys)
    lk = [f"__l_{k}" for k in keys]
    rk = [f"__r_{k}" for k in keys]
    l2 = left.withColumnsRenamed(dict(zip(keys, lk)))
    r2 = right.withColumnsRenamed(dict(zip(right_keys, rk)))
    cond = [l2[a] == r2[b] for a, b in zip(lk, rk)]
    joined = l2.join(r2, on=cond, how="full")
    lc = [c for c in (left_cols or left.columns) if c not in keys]
    rc = [c for c in (right_cols or right.columns) if c not in right_keys]
    return joined.select(
        *[F.coalesce(F.col(a), F.col(b)).alias(k) for k, a, b in zip(keys, lk, rk)],
        *lc, *rc)


def stack(*dfs: DataFrame, allow_missing: bool = False) -> DataFrame:
    """UNION ALL by column name (no shuffle, no dedup)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=allow_missing)
    return out
