"""Change rows -> latest state per key.

``max_by`` over a struct of the row is an aggregate with a partial form: each
map task keeps one candidate row per key, so a key holding a third of all
changes still ships one row per task to the final merge. Deletes are
dropped after the fold (a delete followed by a re-insert keeps the insert).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def apply_changes(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], op_col: str = "op",
                  delete_ops: Sequence[str] = ("d",), value_cols: Sequence[str] | None = None) -> DataFrame:
    """Latest row per key by ``order_cols`` (ties broken by later columns of
    the order list); keys whose latest change is a delete disappear."""
    values = list(value_cols or [c for c in df.columns if c not in keys])
    order = F.struct(*[F.col(c) for c in order_cols])
    payload = F.struct(*[F.col(c) for c in values])
    folded = df.groupBy(*keys).agg(F.max_by(payload, order).alias("_last"))
    out = folded.select(*keys, "_last.*")
    if op_col not in values or not delete_ops:
        return out  # no delete semantics requested: keep the op column (stream state)
    return out.filter(~F.col(op_col).isin(list(delete_ops))).drop(op_col)
