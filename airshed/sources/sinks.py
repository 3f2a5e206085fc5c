"""Sinks: text tables, date-partitioned append, partitioned replace, the
batch landing step with its run log, and the freshness check.

Writes are idempotent per target (overwrite of a path or of the partitions
written), so a retried task or stage after an executor loss rewrites the
same files instead of duplicating rows.
"""

from __future__ import annotations

import logging
import uuid
from datetime import datetime, timedelta, timezone

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from airshed import rules
from airshed.operators.cleaning import add_lineage, all_text
from airshed.sources.versions import commit, commits, file_system, restore, swap_in

RUN_FORMAT = "%Y%m%d%H%M%S"    # of a run's folder and marker
EMPTY_RUN = "-empty"            # ends the marker of a run without rows
RUN_LOG_SCHEMA = "source_name string, row_count long, object_path string, status string, logged_at timestamp"


def write_text_replace(df: DataFrame, target: str, fmt: str = "parquet", as_table: bool = False) -> None:
    """All-text full refresh: every column as text, NaN -> NULL, replace."""
    if as_table:
        all_text(df).write.mode("overwrite").format(fmt).saveAsTable(target)
    else:
        replace_table(all_text(df), target, [], fmt)


def write_partitioned(df: DataFrame, path: str, run_ts: datetime, mode: str = "append",
                      fmt: str = "parquet", run_partition: bool = True) -> str:
    """Add the batch under ``year=YYYY/month=MM/day=DD`` (zero padded) of
    the run time. Returns the partition path written.

    With ``run_partition`` each run gets its own ``run=`` folder, written
    with dynamic partition overwrite: earlier runs of the day are kept
    (append semantics) while a retried run replaces its own files instead
    of adding a second copy."""
    y, m, d = f"{run_ts.year:04d}", f"{run_ts.month:02d}", f"{run_ts.day:02d}"
    cols = {"year": F.lit(y), "month": F.lit(m), "day": F.lit(d)}
    parts = ["year", "month", "day"]
    target = f"{path.rstrip('/')}/year={y}/month={m}/day={d}"
    w_mode = mode
    if run_partition:
        run = run_ts.strftime(RUN_FORMAT)
        cols["run"] = F.lit(run)
        parts.append("run")
        target = f"{target}/run={run}"
        w_mode = "overwrite"
    writer = df.withColumns(cols).write.mode(w_mode).format(fmt).partitionBy(*parts)
    if run_partition:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.save(path)
    return target


def replace_table(df: DataFrame, target: str, partition_cols: list[str], fmt: str = "parquet",
                  catalog_table: bool = False) -> None:
    """Replace a partitioned table (a path or a table of the catalog). The
    rows are rebalanced by the partition columns first: a partition is
    written by one task, a large one by several of the advisory size, and
    no task writes a file for every partition.

    A path is written beside the table and moved into its place when it is
    complete: a write that fails leaves the old table as it was, and ``df``
    may read the table it replaces. Readers that must not meet the moment
    between the two moves, and stores where a move is a copy, take
    ``versions.publish_version``. A catalog table is replaced by its catalog."""
    rows = df.hint("rebalance", *partition_cols) if partition_cols else df
    writer = rows.write.mode("overwrite").format(fmt).partitionBy(*partition_cols)
    if catalog_table:
        writer.saveAsTable(target)
        return
    spark, target = df.sparkSession, target.rstrip("/")
    restore(spark, target)
    staged = f"{target}.staged-{uuid.uuid4().hex}"
    try:
        writer.save(staged)
        swap_in(spark, staged, target)
    finally:
        fs, left = file_system(spark, staged)
        fs.delete(left, True)


def materialize_view(df: DataFrame, name: str) -> DataFrame:
    """A model kept as a (lazy) view; readers inline its plan."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def materialize_table(df: DataFrame, name: str, fmt: str = "parquet",
                      partition_cols: list[str] | None = None) -> DataFrame:
    """A model written as a catalog table (replaced each run); readers
    start from the written files, which also cuts the lineage."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.saveAsTable(name)
    return df.sparkSession.table(name)


def run_log_row(spark: SparkSession, source: str, rows: int, path: str, status: str,
                logged_at: datetime) -> DataFrame:
    from airshed.sources.readers import inline_table
    return inline_table(spark, [(source, int(rows), path, status, logged_at)], RUN_LOG_SCHEMA)


def land(df: DataFrame, source: str, run_ts: datetime, mode: str, lake_path: str,
         log_path: str, text_path: str | None = None) -> DataFrame:
    """Land one batch: add lineage, write it to the date-partitioned lake
    (failure -> FAILED), optionally replace the text table from the files
    just written (failure only logged), and log the run. A batch without
    rows is EMPTY. Returns the log row.

    The batch is computed once, by the lake write, whose observed row count
    tells an empty batch; the text table reads the written run folder. The
    log row has a folder of its own, named by source and run time, so a
    retried run replaces its row.

    Last of all the run is committed by a marker in the source's lake folder
    that names the lake files, the text copy and the log row: a run that
    stops anywhere before is no landed run for ``landed_runs`` and
    ``read_landed``, and its retry writes the same places again. Empty
    runs are committed without files, failed ones not at all.
    """
    spark, log = df.sparkSession, logging.getLogger("airshed.land")
    rows = Observation(f"land_{source}")
    tagged = add_lineage(df, source, F.lit(run_ts).cast("timestamp"), mode).observe(rows, F.count(F.lit(1)).alias("rows"))
    status, n, path, copied = "SUCCESS", 0, "", ""
    try:
        path = write_partitioned(tagged, f"{lake_path.rstrip('/')}/{source}", run_ts)
        n = rows.get.get("rows", 0)
    except (PySparkException, Py4JError) as error:
        log.error("lake write failed for %s: %s", source, str(error).split("\n", 1)[0])
        status, path = "FAILED", ""
    if status == "SUCCESS" and not n:
        status, path = "EMPTY", ""
    if n and text_path:
        # the text copy is secondary: a failure is logged, the run stays SUCCESS
        try:
            write_text_replace(spark.read.schema(tagged.schema).parquet(path), f"{text_path.rstrip('/')}/{source}")
            copied = f"{text_path.rstrip('/')}/{source}"
        except (PySparkException, Py4JError) as error:
            log.error("text table load failed for %s: %s", source, str(error).split("\n", 1)[0])
    row = run_log_row(spark, source, n, path, status, run_ts)
    logged = f"{log_path.rstrip('/')}/run={source}-{run_ts:{RUN_FORMAT}}"
    row.write.mode("overwrite").parquet(logged)
    if status != "FAILED":
        commit(spark, f"{lake_path.rstrip('/')}/{source}", f"{run_ts:{RUN_FORMAT}}" + ("" if n else EMPTY_RUN),
               {"status": status, "rows": n, "lake": path, "text": copied, "log": logged}, replace=True)
    return row


def landed_runs(spark: SparkSession, lake_path: str, source: str) -> list[datetime]:
    """Times of the committed runs of a source that have rows, oldest first
    (from the names of the markers; no data is read)."""
    names = commits(spark, f"{lake_path.rstrip('/')}/{source}")
    return [datetime.strptime(n, RUN_FORMAT) for n in names if not n.endswith(EMPTY_RUN)]


def read_landed(spark: SparkSession, lake_path: str, source: str, runs: list[datetime] | None = None,
                schema: str | None = None) -> DataFrame:
    """Rows of committed runs of a source (all of them, or those given) with
    their partition columns; files of runs that never committed are not read."""
    base = f"{lake_path.rstrip('/')}/{source}"
    found = landed_runs(spark, lake_path, source) if runs is None else runs
    if not found:
        raise FileNotFoundError(f"no committed run under {base}")
    paths = [f"{base}/year={t:%Y}/month={t:%m}/day={t:%d}/run={t:{RUN_FORMAT}}" for t in found]
    reader = spark.read.option("basePath", base)
    return (reader.schema(schema) if schema else reader).parquet(*paths)


def recent_runs(log: DataFrame, as_of, hours: int = rules.FRESHNESS_HOURS) -> DataFrame:
    """Successful runs within ``hours`` before ``as_of`` (a timestamp
    literal or column)."""
    ref = F.lit(as_of).cast("timestamp") if not hasattr(as_of, "_jc") else as_of
    return log.filter((F.col("status") == "SUCCESS")
                      & (F.col("logged_at") >= ref - F.expr(f"INTERVAL {int(hours)} HOURS")))


def assert_fresh(log: DataFrame, as_of, hours: int = rules.FRESHNESS_HOURS) -> int:
    """Raise when no successful run landed in the window; return the count."""
    n = recent_runs(log, as_of, hours).count()
    if n == 0:
        raise RuntimeError(f"no successful ingestion in the last {hours} h before {as_of}")
    return n


def utc_now() -> datetime:
    return datetime.now(tz=timezone.utc).replace(tzinfo=None)


__all__ = ["write_text_replace", "write_partitioned", "replace_table", "land", "run_log_row", "landed_runs", "read_landed",
           "materialize_view", "materialize_table",
           "recent_runs", "assert_fresh", "utc_now", "timedelta"]
