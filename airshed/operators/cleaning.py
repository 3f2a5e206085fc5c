"""Row-local cleaning operators (no shuffle; all fuse into one codegen stage)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed import rules
from airshed.functions.exprs import col


def trim_all(df: DataFrame, cols: Iterable[str] = rules.CLEANING_TEXT_COLUMNS) -> DataFrame:
    """Trim the listed text columns that exist; one projection."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: F.trim(F.col(c)) for c in present}) if present else df




def nan_to_null(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """NaN -> NULL for float/double columns (NaN sorts above every number)."""
    floating = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    targets = [c for c in (cols or floating) if c in floating]
    return df.withColumns({c: F.when(F.isnan(c), None).otherwise(F.col(c)) for c in targets})


def drop_all_null(df: DataFrame, keys: Iterable[str] = rules.CLEANING_KEY_COLUMNS) -> DataFrame:
    """Drop rows whose key columns are all NULL (one NULL key keeps the row)."""
    return df.dropna(how="all", subset=list(keys))


def null_out_of_range(df: DataFrame, code_col: str, value_col: str,
                      bounds: Mapping[str, tuple[float, float]] = rules.MEASUREMENT_BOUNDS,
                      cast_to: str | None = "double") -> DataFrame:
    """Per-code physical range: a value outside [lo, hi] of its code becomes
    NULL, the row is kept. Codes without bounds pass through.

    The bounds table is folded into two map literals, so the check is one
    expression (no join, no shuffle). NaN compares above every number and so
    falls out of range, like the reference.
    """
    v = F.col(value_col).try_cast(cast_to) if cast_to else F.col(value_col)
    lo_map = F.create_map(*[x for k, (lo, _) in bounds.items() for x in (F.lit(k), F.lit(float(lo)))])
    hi_map = F.create_map(*[x for k, (_, hi) in bounds.items() for x in (F.lit(k), F.lit(float(hi)))])
    lo = F.element_at(lo_map, F.col(code_col))
    hi = F.element_at(hi_map, F.col(code_col))
    out_of_range = lo.isNotNull() & ((v < lo) | (v > hi))
    return df.withColumn(value_col, F.when(out_of_range, F.lit(None)).otherwise(v))


def add_date_parts(df: DataFrame, ts_col: str, parts: Iterable[str] = ("year", "month", "day")) -> DataFrame:
    fns = {"year": F.year, "month": F.month, "day": F.dayofmonth, "hour": F.hour,
           "quarter": F.quarter, "date": F.to_date}
    return df.withColumns({p: fns[p](F.col(ts_col)) for p in parts})


def add_lineage(df: DataFrame, source: str, run_ts: str | Column | None = None,
                mode: str = "daily", stamp_col: str = "_extracted_at") -> DataFrame:
    """Lineage columns. ``run_ts`` is passed in (not read from the clock per
    row) so reruns of a batch stay deterministic."""
    ts = F.current_timestamp() if run_ts is None else (
        F.lit(run_ts).cast("timestamp") if isinstance(run_ts, str) else run_ts)
    return df.withColumns({"_source": F.lit(source), stamp_col: ts, "_run_mode": F.lit(mode)})


def all_text(df: DataFrame) -> DataFrame:
    """Every column as text, NaN -> NULL (the raw landing layout)."""
    out = nan_to_null(df)
    return out.select([F.col(c).cast("string").alias(c) for c in out.columns])



__all__ = [
    "trim_all", "nan_to_null", "drop_all_null",
    "null_out_of_range", "add_date_parts", "add_lineage", "all_text", "col",
]
