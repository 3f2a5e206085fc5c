"""Check queries Q55-Q57: what is left when a write, a landing or a stream
stops halfway. Failures are injected into data that the queries write below
the scratch folder, never into an input."""

from __future__ import annotations

from datetime import datetime, timedelta

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airshed.operators.fallback import batches_to_serve
from airshed.plans.check_nested import MESSAGE_SQL, messages
from airshed.plans.check_staging import table
from airshed.session import scratch_path
from airshed.sources.sinks import land, landed_runs, read_landed, replace_table, write_partitioned
from airshed.sources.versions import publish_version, read_version
from airshed.streaming.progress import ProgressLog, read_progress
from airshed.streaming.validator import read_stream, route


def _fails(action) -> bool:
    try:
        action()
    except (PySparkException, Py4JError):
        return True
    return False


# ---------------------------------------------------------------------------
# Q55: a full refresh that fails leaves the table before it
# ---------------------------------------------------------------------------

def q55_atomic_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a partitioned table by both ways of replacing: refreshed,
    refreshed again by a write that stops at the last status, then by one
    without that status. A reader of a version keeps its version."""
    swapped, versioned = scratch_path(spark, "swapped"), scratch_path(spark, "versioned")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    stops = o.withColumn("o_orderkey", F.when(F.col("o_orderstatus") == "P", F.raise_error(F.lit("the source stopped")).cast("bigint"))
                         .otherwise(-F.col("o_orderkey")))
    parts = ["o_orderstatus"]
    ways = {"swap": (lambda df: replace_table(df, swapped, parts), lambda: spark.read.parquet(swapped)),
            "version": (lambda df: publish_version(df, versioned, parts), lambda: read_version(spark, versioned))}
    rows = []

    def seen(step: str, kind: str, df: DataFrame, failed: bool = False) -> None:
        # a summary is taken at once: the next step replaces the table
        for r in df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys")).collect():
            rows.append((step, kind, failed, r["o_orderstatus"], r["n"], r["keys"]))

    for kind, (write, read) in ways.items():
        write(o)
        failed = _fails(lambda: write(stops))
        seen("after a failed refresh", kind, read(), failed)
        before = read()
        write(o.where("o_orderstatus <> 'P'"))
        seen("after a refresh", kind, read())
        if kind == "version":
            seen("reader from before", kind, before)
    return spark.createDataFrame(rows, "step string, kind string, failed boolean, status string, n bigint, keys bigint")


Q55 = """
with g as (select o_orderstatus as status, count(*) as n, sum(o_orderkey)::bigint as keys from orders group by 1)
select step, kind, failed, status, n, keys from g, (values
  ('after a failed refresh', 'swap', true, 'F O P'), ('after a failed refresh', 'version', true, 'F O P'),
  ('after a refresh', 'swap', false, 'F O'), ('after a refresh', 'version', false, 'F O'),
  ('reader from before', 'version', false, 'F O P')) steps(step, kind, failed, kept)
where contains(kept, status)
"""


# ---------------------------------------------------------------------------
# Q56: landed runs by their markers; the last good batch without a scan
# ---------------------------------------------------------------------------

LAST = datetime(2024, 1, 30, 23)
TTL = timedelta(hours=6)
#: Hours before the last run at which a source landed; the second one of
#: ``view`` stops after its lake files, before anything else is written.
RUNS = {"click": (2, 0), "view": (4, 0), "signup": (9,)}
STOPPED = ("view", 0)


def q56_landed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, log, text = (scratch_path(spark, n) for n in ("lake", "runlog", "texts"))
    ev = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    for source, hours in RUNS.items():
        for h in hours:
            rows = ev.where((F.col("event_type") == source) & (F.col("event_id") % 2 == h % 4 // 2)).drop("event_type")
            if (source, h) == STOPPED:
                write_partitioned(rows, f"{lake}/{source}", LAST - timedelta(hours=h))
            else:
                land(rows, source, LAST - timedelta(hours=h), "hourly", lake, log, text)
    manifest = {s: landed_runs(spark, lake, s) for s in RUNS}
    out = None
    for source, run in batches_to_serve(manifest, LAST, TTL).items():
        found = read_landed(spark, lake, source, [run]).select(
            "event_id", F.lit(source).alias("source"), F.lit(run).cast("timestamp_ntz").alias("batch"), F.lit(run < LAST).alias("is_fallback"),
            F.lit(len(manifest[source])).alias("runs"))
        out = found if out is None else out.unionByName(found)
    return out


Q56 = f"""
with s as (select * from (values ('click', timestamp '{LAST}', false, 2, 0), ('view', timestamp '{LAST - timedelta(hours=4)}', true, 1, 0))
           v(source, batch, is_fallback, runs, half))
select event_id, source, batch, is_fallback, runs from events join s on event_type = source and event_id % 2 = half
"""


# ---------------------------------------------------------------------------
# Q57: a stream that stops in mid-batch and goes on; progress rows (ST3 ST5)
# ---------------------------------------------------------------------------

FILES = 6          # micro-batches: a file each
STOP_AT = 3        # the batch at whose end the first run stops, before it is committed


def write_parts(sent: DataFrame, path: str) -> None:
    """Text files, one for each ``part``. Every part is a task's own, which
    writes its rows as they come: a write by partition columns would sort them
    first, in memory that grows with the part."""
    parts = [r["part"] for r in sent.select("part").distinct().collect()]   # few, whatever the rows
    place = F.coalesce(*[F.when(F.col("part").eqNullSafe(F.lit(p)), i) for i, p in enumerate(parts)], F.lit(0))
    sent.repartitionById(max(len(parts), 1), place).select("value").write.text(path)


class _Stop(RuntimeError):
    pass


def q57_stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages routed in two runs over one checkpoint. The first run ends
    with both sinks of a batch written but the batch not committed, so
    the second replays it: every message is in one sink, once. The progress
    log has the rows of each finished batch and tells the runs apart."""
    src, valid, dlq, ckpt, progress = (scratch_path(spark, n) for n in ("msgs", "valid", "dlq", "ckpt", "progress"))
    write_parts(messages(spark, sf_dir).select("value", (F.col("event_id") % FILES).alias("part")), src)
    listener = ProgressLog(spark, progress)
    spark.streams.addListener(listener)

    def stop(batch_id: int, stats: dict) -> None:
        if batch_id == STOP_AT:
            raise _Stop(f"stopped in batch {batch_id}")

    runs, failed = [], []
    try:
        for on_batch in (stop, None):
            query = route(read_stream(spark, "text", src, maxFilesPerTrigger="1"), valid, dlq, ckpt, on_batch=on_batch)
            failed.append(_fails(query.awaitTermination))
            listener.wait(query)
            runs.append(str(query.runId))
    finally:
        spark.streams.removeListener(listener)
    good = spark.read.schema("location_id bigint").json(valid).agg(F.count(F.lit(1)).alias("n"))
    bad = spark.read.schema("error_reason string").json(dlq).groupBy("error_reason").agg(F.count(F.lit(1)).alias("n"))
    batches = read_progress(spark, progress).where("input_rows > 0").withColumn("n", F.col("observed")["route_input.rows"])
    by_size = Window.orderBy(F.desc("n"), "batch_id")   # a row per file
    by_run = batches.groupBy("run_id").agg(F.count_distinct("batch_id").alias("n"))
    return (
        good.select(F.lit("valid").alias("what"), F.lit("").alias("which"), "n")
        .unionByName(bad.select(F.lit("invalid").alias("what"), F.col("error_reason").alias("which"), "n"))
        .unionByName(batches.select(F.lit("batch").alias("what"), F.row_number().over(by_size).cast("string").alias("which"), "n"))
        .unionByName(by_run.select(F.lit("finished").alias("what"), F.when(F.col("run_id") == runs[0], f"run 1, failed {failed[0]}")
                                   .otherwise(f"run 2, failed {failed[1]}").alias("which"), "n")))


Q57 = f"""
with r as ({MESSAGE_SQL}),
f as (select count(*) as n from events group by event_id % {FILES})
select case when reason is null then 'valid' else 'invalid' end as what, coalesce(reason, '') as which, count(*) as n from r group by 1, 2
union all select 'batch', cast(row_number() over (order by n desc) as varchar), n from f
union all select 'finished', 'run 1, failed True', {STOP_AT}
union all select 'finished', 'run 2, failed False', (select count(*) from f) - {STOP_AT}
"""

QUERIES = {"q55_atomic_replace": q55_atomic_replace, "q56_landed_batches": q56_landed_batches, "q57_stream_resume": q57_stream_resume}
ORACLE = {"q55_atomic_replace": Q55, "q56_landed_batches": Q56, "q57_stream_resume": Q57}
