"""Replacing tables, landing and streams that stop halfway."""

import os
import re
from datetime import datetime, timedelta

import pytest
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from airshed.operators.fallback import batches_to_serve
from airshed.operators.quality import Rule, failing_rows, rows_by_rule
from airshed.plans import check_jobs, check_models
from airshed.sources import sinks, versions
from airshed.streaming.progress import ProgressLog, read_progress
from conftest import SF_SMALL, rows

T = datetime(2024, 5, 1, 12)


@pytest.fixture
def table(spark):
    return spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")


def stops(df):
    return df.withColumn("k", F.when(F.col("k") == 2, F.raise_error(F.lit("stopped")).cast("int")).otherwise(F.col("k")))


def test_failed_replace_leaves_the_table(spark, table, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace_table(table, path, ["v"])
    with pytest.raises((PySparkException, Py4JError)):
        sinks.replace_table(stops(table), path, ["v"])
    assert sorted(rows(spark.read.parquet(path), "k", "v")) == [(1, "a"), (2, "b")]
    assert os.listdir(tmp_path) == ["t"]                       # nothing is left beside it
    # a table may be replaced by what is read from it
    sinks.replace_table(spark.read.parquet(path).where("k = 2"), path, ["v"])
    assert rows(spark.read.parquet(path), "k", "v") == [(2, "b")]


def test_swap_stopped_between_its_moves_is_restored(spark, table, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace_table(table, path, [])
    os.rename(path, path + versions.ASIDE)
    assert versions.restore(spark, path) and not versions.restore(spark, path)
    assert spark.read.parquet(path).count() == 2


def test_versions(spark, table, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, path)
    assert versions.publish_version(table, path, ["v"]) == 0
    before = versions.read_version(spark, path)
    with pytest.raises((PySparkException, Py4JError)):
        versions.publish_version(stops(table), path, ["v"])
    assert versions.current_version(spark, path)[0] == 0
    assert versions.publish_version(table.where("k = 1"), path) == 1
    assert rows(versions.read_version(spark, path)) == [(1, "a")] and before.count() == 2
    assert versions.remove_old(spark, path, keep=1) >= 1
    assert versions.current_version(spark, path)[0] == 1 and versions.read_version(spark, path).count() == 1
    assert versions.publish_version(table, path) == 2


def test_of_two_writers_of_a_number_one_wins(spark, tmp_path):
    path = str(tmp_path / "t")
    assert versions.commit(spark, path, "1", {"a": 1}) and not versions.commit(spark, path, "1", {"a": 2})
    assert versions.facts_of(spark, path, "1") == {"a": 1} and versions.commits(spark, path) == ["1"]


def test_only_committed_runs_are_landed(spark, table, tmp_path):
    lake, log, text = (str(tmp_path / n) for n in ("lake", "log", "text"))
    sinks.land(table, "s", T, "hourly", lake, log, text)
    sinks.land(table.where("k > 5"), "s", T + timedelta(hours=1), "hourly", lake, log, text)          # empty
    sinks.write_partitioned(table, f"{lake}/s", T + timedelta(hours=2))                                # stops before its marker
    versions.put(spark, str(tmp_path / "file"), "x")
    sinks.land(table, "s", T, "hourly", str(tmp_path / "file"), log)                                   # fails
    assert sinks.landed_runs(spark, lake, "s") == [T] and sinks.landed_runs(spark, lake, "other") == []
    assert sinks.read_landed(spark, lake, "s").count() == 2
    facts = versions.facts_of(spark, f"{lake}/s", f"{T:{sinks.RUN_FORMAT}}")
    assert facts["rows"] == 2 and os.path.isdir(facts["lake"]) and os.path.isdir(facts["text"]) and os.path.isdir(facts["log"])
    with pytest.raises(FileNotFoundError):
        sinks.read_landed(spark, lake, "other")
    # the retry of the stopped run, and of a landed one
    for _ in range(2):
        sinks.land(table, "s", T + timedelta(hours=2), "hourly", lake, log, text)
    assert len(sinks.landed_runs(spark, lake, "s")) == 2 and sinks.read_landed(spark, lake, "s").count() == 4


def test_batch_to_serve_comes_from_the_manifest(spark, table, tmp_path):
    hour = timedelta(hours=1)
    manifest = {"now": [T - hour, T], "late": [T - 9 * hour, T - 2 * hour, T + hour], "old": [T - 9 * hour], "none": []}
    assert batches_to_serve(manifest, T, 6 * hour) == {"now": T, "late": T - 2 * hour}
    assert batches_to_serve(manifest, T) == {"now": T, "late": T - 2 * hour, "old": T - 9 * hour}
    lake, log = str(tmp_path / "lake"), str(tmp_path / "log")
    for h in range(3):
        sinks.land(table, "s", T + h * hour, "hourly", lake, log)
    served = sinks.read_landed(spark, lake, "s", [batches_to_serve({"s": sinks.landed_runs(spark, lake, "s")}, T + hour)["s"]])
    files = served.inputFiles()
    assert files and all("run=20240501130000" in f for f in files)       # no other batch is opened


def test_rows_by_rule_are_those_of_each_rule(spark):
    df = spark.createDataFrame([(1, 5, "a"), (2, 500, "b"), (3, None, "a"), (4, 5, None), (4, 7, "zz")], "id int, x int, s string")
    rules = {"r": Rule("accepted_range", "x", min_value=0, max_value=100), "n": Rule("not_null", "x"), "u": Rule("unique", "x"),
             "u2": Rule("unique", "id"), "v": Rule("accepted_values", "s", values=("a", "b")), "e": Rule("expression", "x", condition="x = 7")}
    got = sorted(map(str, rows(rows_by_rule(df, rules))))
    want = sorted(str((*r, n)) for n, rule in rules.items() for r in rows(failing_rows(df, rule), "id", "x", "s"))
    assert got == want
    assert rows(rows_by_rule(df.where("false"), rules)) == []


def test_failing_rows_take_two_scans(spark):
    plan = check_jobs.q50_failing_rows(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("FileScan parquet", plan)) == 2


def test_composite_risk_reads_each_feed_once(spark):
    plan = check_models.QUERIES["q11_environmental_risk"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window") >= 1 and "LeftAnti" not in plan
    for feed in ("lineitem",):
        assert len(re.findall(rf"FileScan parquet [^\n]*{feed}\.parquet", plan)) == 1


def test_progress_rows(spark, tmp_path):
    src, out, log, ckpt = (str(tmp_path / n) for n in ("src", "out", "log", "ckpt"))
    for i in range(3):
        spark.range(10 * (i + 1)).write.mode("append").parquet(src)
    listener = ProgressLog(spark, log)
    spark.streams.addListener(listener)
    try:
        stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 100).parquet(src).observe("seen", F.count(F.lit(1)).alias("rows"))
        query = stream.writeStream.queryName("counted").format("parquet").option("checkpointLocation", ckpt).trigger(availableNow=True).start(out)
        query.awaitTermination()
        assert listener.wait(query)
    finally:
        spark.streams.removeListener(listener)
    found = read_progress(spark, log).where("input_rows > 0").collect()
    assert sum(r.input_rows for r in found) == 60 and sum(r.observed["seen.rows"] for r in found) == 60
    assert {r.query_name for r in found} == {"counted"} and {r.run_id for r in found} == {str(query.runId)}


def test_each_part_is_a_file_of_its_own_task(spark, tmp_path):
    """Also for null and negative keys; no write by partition columns, which sorts a part in memory."""
    from airshed.plans.check_recovery import write_parts

    sent = spark.range(-7, 60_000).select(F.repeat(F.lit("x"), 200).alias("text"), "id").select(
        F.concat("text", F.col("id").cast("string")).alias("value"),
        F.when(F.col("id") != 11, F.col("id") % 6).alias("part"))
    path = str(tmp_path / "src")
    write_parts(sent, path)
    assert not [f for f in os.listdir(path) if os.path.isdir(f"{path}/{f}")]
    per_file = spark.read.text(path).groupBy(F.input_file_name()).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(F.expr("try_cast(substr(value, 201) as bigint) % 6")).alias("parts"))
    want = [r["count"] for r in sent.groupBy("part").count().collect()]
    found = rows(per_file)
    assert sorted(n for _, n, _ in found) == sorted(want) and len(want) == 12 and {p for *_, p in found} == {1}
