"""Snapshot fallback (S22): when a source's current batch is empty (or
failed), serve its latest earlier batch within a TTL instead.

Built from one small aggregate (per source: is the current batch there,
which earlier batch to serve) joined back to the batch rows on
(source, batch), so rows are never grouped by source.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_fallback(history: DataFrame, source_col: str, batch_col: str, as_of: Column | str,
                  ttl: str | None = None, current: DataFrame | None = None) -> DataFrame:
    """Rows of each source's batch ``as_of``; a source without rows there
    gets its latest batch before ``as_of`` (no older than ``as_of - ttl``
    when ``ttl`` is an interval string such as ``'6 hours'``), flagged
    ``is_fallback``. ``current`` defaults to the ``as_of`` batch of
    ``history``; when given, it is the freshly fetched batch and
    ``history`` holds the earlier ones.

    Plan: one aggregate picks each source's batch (partial before the
    shuffle, one row per source), one equi-join on (source, batch) fetches
    its rows; the flag is ``batch < as_of``.
    """
    ref = F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of
    rows = history if current is None else history.filter(F.col(batch_col) < ref).unionByName(current)
    b = F.col(batch_col)
    eligible = b <= ref
    if ttl:
        eligible = eligible & (b >= ref - F.expr(f"INTERVAL {ttl}"))
    serve = (rows.filter(eligible).groupBy(source_col).agg(F.max(b).alias("_batch"))
                 .withColumnRenamed(source_col, "_source"))
    found = rows.join(serve, (F.col(source_col) == F.col("_source")) & (b == F.col("_batch")))
    return found.select(*rows.columns).withColumn("is_fallback", b < ref)


def batches_to_serve(batches: Mapping[str, Sequence[datetime]], as_of: datetime,
                     ttl: timedelta | None = None) -> dict[str, datetime]:
    """The batch to read for each source, chosen from a manifest (the ordered
    batch times of each source, such as ``sinks.landed_runs``): the one of
    ``as_of``, else the latest before it within the TTL. A source without
    one is left out. Only the chosen batch is then read, whatever the
    length of the history."""
    found = {}
    for source, times in batches.items():
        at = bisect_right(times, as_of)
        if at and (ttl is None or times[at - 1] >= as_of - ttl):
            found[source] = times[at - 1]
    return found
