"""Grouped aggregates.

All aggregates used here are algebraic or have a partial form (avg, min,
max, count, sum, max_by, mode's value->count map, count-distinct through
Catalyst's distinct expand), so Spark combines map-side before the shuffle
and a hot key ships one partial row per map task instead of its raw rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from airshed.functions.exprs import col


def mode_value(c: str | Column) -> Column:
    """Most frequent value; ties go to the smallest value (deterministic)."""
    return F.mode(col(c), True)



def daily_stats(df: DataFrame, keys: Sequence[str], ts_col: str, value_col: str,
                date_col: str = "measurement_date", extras: Iterable[Column] = (),
                truncate: bool = True) -> DataFrame:
    """Per key x day: avg/min/max/count of a value plus extra aggregates.

    With ``truncate`` the day is ``date_trunc('day', ts)`` (a timestamp, as
    the reference keeps it); else ``to_date``.
    """
    day = F.date_trunc("day", F.col(ts_col)) if truncate else F.to_date(F.col(ts_col))
    return (df.withColumn(date_col, day)
              .groupBy(*keys, date_col)
              .agg(F.avg(value_col).alias("avg_value"),
                   F.min(value_col).alias("min_value"),
                   F.max(value_col).alias("max_value"),
                   F.count(F.lit(1)).alias("reading_count"),
                   *extras))


def distinct_dim(df: DataFrame, cols: Sequence[str], not_null: Sequence[str] = ()) -> DataFrame:
    """SELECT DISTINCT cols WHERE not_null cols are not null."""
    out = df.select(*cols)
    for c in not_null:
        out = out.filter(F.col(c).isNotNull())
    return out.distinct()


def observe_counts(df: DataFrame, name: str, **extra: Column) -> tuple[DataFrame, Observation]:
    """Attach a row counter (and extra metrics) that is filled by the next
    action on the returned DataFrame — no separate count job."""
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")] + [c.alias(k) for k, c in extra.items()]
    return df.observe(obs, *metrics), obs


def status_counts(df: DataFrame, status_col: str = "status", valid_value: str = "valid") -> DataFrame:
    """valid / invalid counts and pass rate in one aggregate row."""
    valid = F.sum(F.when(F.col(status_col) == valid_value, 1).otherwise(0))
    total = F.count(F.lit(1))
    return df.agg(valid.cast("long").alias("valid_count"),
                  (total - valid).cast("long").alias("invalid_count"),
                  total.alias("total_count"),
                  F.round(valid / total * 100, 1).alias("pass_rate_pct"))
